"""As-of lookup between two streams: each left row with the version in force at its time."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.ordered import micros
from tidemill.streaming.panes import BUCKETS, PaneWork, in_panes, key_text, packed, starts_of, unpacked

LEFT, RIGHT = 1, 0  # a version at a row's own time comes before the row


class _AsOf(PaneWork):
    """Held per key: the newest version of all closed panes, beside the panes still open."""

    name = "newest"

    def work(self, rows: pd.DataFrame, held: dict) -> Iterator[pd.DataFrame]:
        body, version = rows["body"].to_numpy(), rows["side"].to_numpy() == RIGHT
        starts = starts_of(rows["k"])
        sizes = np.diff(np.r_[starts, len(rows)])
        keys = rows["k"].to_numpy()[starts]
        newest = np.maximum.accumulate(np.where(version, np.arange(len(rows)), -1))
        known = newest >= np.repeat(starts, sizes)  # not a version of the key before
        before = np.array([held.get(k) for k in keys], dtype=object)
        found = np.where(known, body[newest], np.repeat(before, sizes))
        last = np.r_[starts[1:], len(rows)] - 1
        held.update(zip(keys[known[last]], found[last[known[last]]]))
        yield pd.DataFrame({"row": body[~version], "held": found[~version]}, dtype=object)


def asof_lookup_stream(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str, cols: Mapping[str, str], left_id: str, right_id: str,
                       delay: str, pane_seconds: int, right_key: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """For each row of the left stream, the newest version of its key on the right stream with ``rt <= lt``.

    Same rows as ``joins.asof_lookup`` on the whole of both sides, whatever the order in which they arrive, as long as none is
    later than ``delay``. A left row is answered when the watermark has passed its pane, as until then an older version
    may still come. Versions that a newer one has replaced before the watermark are dropped; each key keeps one.
    A NULL key meets nothing. Rows without a time are dropped as late. Columns pass through as JSON, so they must be of types that JSON
    gives back (no maps with other than text keys).
    """
    row_schema = left.schema
    held_schema = T.StructType([T.StructField(new, right.schema[src].dataType) for new, src in cols.items()])

    def side(df: DataFrame, who: str, at: str, id_: str, number: int, body) -> DataFrame:
        return df.select(key_text(df, who).alias("k"), F.col(at).cast("timestamp").alias("event_time"), micros(at).alias("at_us"), F.lit(number).alias("side"),
                         F.col(id_).cast("long").alias("tie"), body.alias("body"))
    versions = right.where(F.col(right_key or key).isNotNull())
    both = side(left, key, lt, left_id, LEFT, packed(left.columns)).unionByName(
        side(versions, right_key or key, rt, right_id, RIGHT, packed(F.struct(*[F.col(src).alias(new) for new, src in cols.items()]))))
    work = _AsOf(pane_seconds, ["at_us", "side", "tie"])
    out = in_panes(both.withWatermark("event_time", delay), work, "row string, held string", buckets)
    out = out.select(unpacked("row", row_schema).alias("l"), unpacked("held", held_schema).alias("h"))
    return out.select(*[F.col(f"l.{c}").alias(c) for c in left.columns], *[F.col(f"h.{c}").alias(c) for c in cols])
