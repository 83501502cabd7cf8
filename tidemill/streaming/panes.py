"""Keyed work on a stream in event-time order, a pane of time at a time.

A micro-batch hands out rows in any order and any number. ``PaneWork`` puts them away as they come, one Arrow batch
after the other, in state that belongs to (bucket of keys, pane); nothing is gathered in memory. When the watermark has passed
the end of a pane no row of it can come any more: a timer takes the pane's rows, in order, to ``work``, and its state is
dropped. What ``work`` sees therefore does not depend on how rows were dealt to micro-batches, nor on their disorder within the
watermark's delay, and a task holds one pane of one bucket, or several small ones. Results come a pane's width later than rows do.

Every use of state is a call from Python to the state store, whatever it moves. So keys share buckets, and calls follow the buckets, panes
and Arrow batches, not the keys or rows.

Rows behind the watermark are dropped by Spark before they get here. Rows need ``at_us``, their time in microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def packed(cols: Sequence[str] | Column) -> Column:
    """Columns (or a struct) as one text, so that whole numbers and nulls pass through Python as they are."""
    return F.to_json(cols if isinstance(cols, Column) else F.struct(*cols), {**JSON_TIMES, "ignoreNullFields": "false"})


def unpacked(text: str, schema: T.StructType) -> Column:
    return F.from_json(F.col(text), schema, JSON_TIMES)


BUCKETS = 128  # groups that keys are dealt to; part of a stream's checkpoint
AT_ONCE = 20_000  # closed panes of a bucket are worked on together while they have no more rows than this


def key_text(df: DataFrame, key: str) -> Column:
    """A key as a text of its own, the NULL key too; ``unpacked(.., key_schema(..))`` gives it back."""
    kind, value = df.schema[key].dataType, F.col(key)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = (value + F.lit(0.0)).cast(kind)  # -0.0 is the same key as 0.0
    return packed(F.struct(value.alias("k")))


def key_schema(df: DataFrame, key: str) -> T.StructType:
    return T.StructType([T.StructField("k", df.schema[key].dataType)])


def bucket_of(text: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(buckets).cast("long"))


def starts_of(keys: pd.Series) -> np.ndarray:
    """The places at which a new key begins, in rows sorted by key."""
    values = keys.to_numpy()
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, dtype="int64")


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(bytes(blob))) as reader:
        return reader.read_all()


def _together(tables: Sequence[pa.Table]) -> pd.DataFrame:
    rows = pa.concat_tables(tables, promote_options="default").to_pandas()  # a part without a text has no type for it
    texts = [c for c in rows if rows[c].dtype.kind not in "iufb"]
    return rows.assign(**{c: rows[c].astype(object).where(rows[c].notna(), None) for c in texts})


class PaneWork(StatefulProcessor):
    """``seconds`` is the width of a pane, ``order`` the columns that order a key's rows (``at_us`` first).

    What a key keeps beyond its panes is a value in ``held``, read once per timer and written once.
    """

    name = "held"

    def __init__(self, seconds: int, order: Sequence[str]):
        self.width, self.order = seconds * 1_000_000, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "pane long, number long", "rows binary")
        self.arrived = handle.getValueState("arrived", "n long")
        self.kept = handle.getListState(self.name, "k string, held string")

    def work(self, rows: pd.DataFrame, held: dict) -> Iterator[pd.DataFrame]:
        """The rows of a pane, or of panes that follow each other, sorted by key ``k`` and in order; ``held`` has what their keys keep, and takes what they are to keep."""
        raise NotImplementedError

    def evict(self, held: dict, passed: int) -> int | None:
        """Drop what is over, as no row before ``passed`` (microseconds) can come to ``work`` any more; the time when all that may go will be over."""

    def decode(self, text: str):
        return text

    def encode(self, value) -> str:
        return value

    def _timer(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number = self.arrived.get()[0] if self.arrived.exists() else 0
        first = None
        for batch in rows:
            pane = batch["at_us"].to_numpy() // self.width
            order = np.argsort(pane, kind="stable")
            parts = pa.Table.from_pandas(batch.drop(columns=["bucket", "event_time"]), preserve_index=False).take(order)
            pane = pane[order]
            starts = np.flatnonzero(np.r_[True, pane[1:] != pane[:-1]])
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(pane)]):
                self.waiting.updateValue((int(pane[lo]), number), (_pack(parts.slice(lo, hi - lo)),))
                number += 1
            first = int(pane[0]) if first is None else min(first, int(pane[0]))
        self.arrived.update((number,))
        if first is not None:  # the timer of a bucket's first open pane sets the next
            self._timer((first + 1) * self.width)
        return iter(())

    def _worked(self, tables: Sequence[pa.Table], held: dict) -> Iterator[pd.DataFrame]:
        return self.work(_together(tables).sort_values(["k", *self.order], ignore_index=True), held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        panes: dict[int, list[int]] = {}
        for pane, number in list(self.waiting.keys()):
            panes.setdefault(pane, []).append(number)
        held = {k: self.decode(text) for k, text in self.kept.get()}
        tables: list[pa.Table] = []
        for pane in sorted(p for p in panes if (p + 1) * self.width <= passed):
            for number in sorted(panes.pop(pane)):
                tables.append(_unpack(self.waiting.getValue((pane, number))[0]))
                self.waiting.removeKey((pane, number))
            if sum(len(t) for t in tables) >= AT_ONCE:
                yield from self._worked(tables, held)
                tables = []
        if tables:
            yield from self._worked(tables, held)
        over = self.evict(held, min([passed, *[pane * self.width for pane in panes]]))  # rows that still wait may be older than the watermark
        if held:
            self.kept.put([(k, self.encode(value)) for k, value in held.items()])
        else:
            self.kept.clear()
        if panes:
            self._timer((min(panes) + 1) * self.width)
        elif over is not None:
            self._timer(over)

    def close(self) -> None:
        pass


def in_panes(df: DataFrame, work: PaneWork, output: str | T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """Run pane work on a stream that has a watermark, rows with ``k`` (``key_text``). Start it in a session with RocksDB state, or in ``session.rocksdb_state``.

    The number of buckets stays with a checkpoint. A task holds what the keys of a bucket keep: many millions of keys want more.
    """
    return df.withColumn("bucket", bucket_of(F.col("k"), buckets)).groupBy("bucket").transformWithStateInPandas(work, output, "Append", "EventTime")
