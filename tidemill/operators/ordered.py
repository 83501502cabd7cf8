"""Running values along an ordered key, safe when one key holds much of the table.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts a key's whole history in one task.
Here the table is written once in sorted ranges of (key, order); a range is a chunk, so a key,
or even one time of a key, spreads over as many ranges as its rows fill. Every (key, chunk) folds
to one summary row; a short window over those gives each chunk the state carried in from the
chunks before it. That state joins the rows as one more row, sorted first, and a window
inside (key, chunk) does the rest. The same happens at every size of the table.

The written copy holds the columns of the table given, so give it only what is needed.
A lost executor costs a re-read of the copy. Order columns must make rows unique within a
key where the result depends on it.

``chunk`` is the number of ranges (the session's shuffle partitions if not given), or a column
that grows with the order and is taken as the chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import materialize

HOUR, DAY = 3600, 86400


def micros(c: Column | str) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL key meets the NULL key, as it does in a groupBy."""
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return a.join(b, on).drop(*[f"_r_{k}" for k in keys])


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: int | Column | None = None) -> DataFrame:
    """Add ``_chunk``, a number that grows along the order within each key.

    The table is written in sorted ranges of (key, order), which sampling makes about equal in rows.
    A column is taken as it is.
    """
    if isinstance(chunk, Column):
        return df.withColumn("_chunk", chunk)
    n = chunk or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *keys, *order)
    return materialize(ranges.withColumn("_chunk", F.spark_partition_id().cast("long")), "ranges")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, tuple[str, Column]],
            chunk: int | Column | None = None, inclusive: bool = True) -> DataFrame:
    """Add running columns: ``specs`` maps a new name to (kind, column).

    Kinds are sum, count, min, max and last (newest non-null value). With
    ``inclusive=False`` the current row is left out, so ``last`` gives the row before.
    """
    chunked = cut(df, keys, order, chunk)
    folds = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    value, total, carry, out = {}, [], [], {}
    within = Window.partitionBy(*keys, "_chunk").orderBy("_rowkind", *order)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    for name, (kind, c) in specs.items():
        v = f"_v_{name}"
        if kind == "last":
            value[v] = c
            total.append(F.max_by(c, F.when(c.isNotNull(), F.struct(*order))).alias(v))
            carry.append(F.last(v, ignorenulls=True).over(earlier).alias(v))
            out[name] = F.last(v, ignorenulls=True).over(within)
        elif kind in folds:
            value[v] = F.when(c.isNotNull(), F.lit(1).cast("long")) if kind == "count" else c
            fold = folds[kind]
            total.append((F.count(c) if kind == "count" else fold(c)).alias(v))
            carry.append(fold(v).over(earlier).alias(v))
            out[name] = fold(v).over(within)
            if kind == "count":
                out[name] = F.coalesce(out[name], F.lit(0).cast("long"))
        else:
            raise ValueError(f"unknown running kind {kind}")
    summary = chunked.groupBy(*keys, "_chunk").agg(*total)
    seeds = summary.select(*keys, "_chunk", F.lit(0).alias("_rowkind"), *carry).dropna("all", subset=list(value))
    rows = chunked.withColumns(value).withColumn("_rowkind", F.lit(1))
    both = rows.unionByName(seeds, allowMissingColumns=True)
    return both.withColumns(out).where("_rowkind = 1").select(*df.columns, *specs)


def running_sets(chunked: DataFrame, keys: Sequence[str], order: Sequence[str],
                 specs: Mapping[str, tuple[Sequence[str], str, Column]]) -> DataFrame:
    """Several running columns, each within keys of its own, from one read of a table that has been ``cut``.

    ``specs`` maps a new name to (more keys, kind, column): the column runs within ``keys`` and the further ones, which must not
    fall along the order (such as a time bucket). Kinds are sum, count, and before (the newest non-null value of the rows before).
    One pass folds (key, chunk) for all sets of keys together; the rows meet what is carried into their chunk in a
    single exchange by key and chunk, which serves every set.
    """
    sets = list(dict.fromkeys(tuple(extra) for extra, _, _ in specs.values()))
    extras = list(dict.fromkeys(e for extra in sets for e in extra))
    value, total = {}, []
    for name, (_, kind, c) in specs.items():
        v = f"_v_{name}"
        if kind == "before":
            value[v] = c
            total.append(F.max_by(c, F.when(c.isNotNull(), F.struct(*order))).alias(v))
        elif kind in ("sum", "count"):
            value[v] = F.when(c.isNotNull(), F.lit(1).cast("long")) if kind == "count" else c
            total.append(F.sum(value[v]).alias(v))
        else:
            raise ValueError(f"unknown running kind {kind}")
    of_set = {extra: F.lit(sum(2 ** (len(extras) - i) for i, e in enumerate(extras) if e not in extra)) for extra in sets}
    summary = chunked.groupingSets([[*keys, *extra, "_chunk"] for extra in sets], *keys, *extras, "_chunk").agg(
        F.grouping_id().alias("_set"), *total)
    earlier = Window.partitionBy("_set", *keys, *extras).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for name, (extra, kind, _) in specs.items():
        v = f"_v_{name}"
        carry = F.last(v, ignorenulls=True).over(earlier) if kind == "before" else F.sum(v).over(earlier)
        carried.append(F.when(F.col("_set") == of_set[tuple(extra)], carry).alias(v))
    seeds = summary.select(*keys, *extras, "_chunk", F.lit(0).alias("_rowkind"), *carried).dropna("all", subset=list(value))
    both = chunked.withColumns(value).withColumn("_rowkind", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    both = both.repartition(*keys, "_chunk")
    out = {}
    for name, (extra, kind, _) in specs.items():
        within = Window.partitionBy(*keys, "_chunk", *extra).orderBy("_rowkind", *order).rowsBetween(
            Window.unboundedPreceding, -1 if kind == "before" else Window.currentRow)
        v = F.col(f"_v_{name}")
        out[name] = F.last(v, ignorenulls=True).over(within) if kind == "before" else F.sum(v).over(within)
        if kind == "count":
            out[name] = F.coalesce(out[name], F.lit(0).cast("long"))
    return both.withColumns(out).where("_rowkind = 1").select(*chunked.columns, *specs)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Mapping[str, str],
             chunk: int | Column | None = None) -> DataFrame:
    """Add columns holding the row before's values (``cols``: new name -> source)."""
    held = F.struct(*[F.col(src).alias(new) for new, src in cols.items()])
    out = running(df, keys, order, {"_prev": ("last", held)}, chunk, inclusive=False)
    return out.select(*df.columns, *[F.col(f"_prev.{new}").alias(new) for new in cols])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
             chunk: int | Column | None = None) -> DataFrame:
    """1-based row number along the order."""
    return running(df, keys, order, {name: ("count", F.lit(1))}, chunk)


def trailing_range(df: DataFrame, keys: Sequence[str], ts: str, seconds: int, specs: Mapping[str, tuple[str, Column]],
                   chunk: int | Column | None = None) -> DataFrame:
    """Sums and counts over the trailing time range [ts - seconds, ts] of each key.

    ``specs`` maps a new name to (sum | count, column); sums should be of DECIMAL or whole
    numbers. A row's value is added at its time and taken away just after the range. The
    additions fold to one row per key and time, and the total at a time is their running
    sum: the cost does not grow with the rows of a range, or of one time.
    """
    for kind, _ in specs.values():
        if kind not in ("sum", "count"):
            raise ValueError(f"a trailing range has sums and counts, not {kind}")
    values = {}
    for n, (kind, c) in specs.items():
        values[f"_c_{n}"] = F.when(c.isNotNull(), F.lit(1).cast("long")).otherwise(0)
        if kind == "sum":
            values[f"_s_{n}"] = c
    per_time = df.groupBy(*keys, micros(ts).alias("_in")).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    moves = per_time.withColumn("_at", F.explode(F.array(F.col("_in"), F.col("_in") + (seconds * 1_000_000 + 1))))
    enters = F.col("_at") == F.col("_in")
    moves = moves.groupBy(*keys, "_at").agg(
        F.max(enters).alias("_enters"), *[F.sum(F.when(enters, F.col(n)).otherwise(-F.col(n))).alias(n) for n in values])
    totals = running(moves, keys, ["_at"], {f"_t{n}": ("sum", F.col(n)) for n in values}, chunk).where("_enters")
    out = [(F.when(F.col(f"_t_c_{n}") > 0, F.col(f"_t_s_{n}")) if kind == "sum" else F.col(f"_t_c_{n}")).alias(n)
           for n, (kind, _) in specs.items()]
    rows = df.select(*keys, micros(ts).alias("_at"), F.struct(*df.columns).alias("_row"))
    return null_safe_join(rows, totals, [*keys, "_at"]).select(*[F.col(f"_row.{c}").alias(c) for c in df.columns], *out)


def trailing_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, aggs: Mapping[str, Column],
                  block: int = 100_000, chunk: int | Column | None = None, name: str = "rn") -> DataFrame:
    """Aggregates over the ``rows`` rows before each row of a key (the row itself left out).

    Rows are numbered first and cut into blocks of equal length; the tail of a block is
    also given to the next one.
    """
    num = numbered(df, keys, order, name, chunk)
    own = F.floor((F.col(name) - 1) / block).cast("long")
    nxt = F.floor((F.col(name) - 1 + rows) / block).cast("long")
    spread = num.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, nxt)))
    w = Window.partitionBy(*keys, "_block").orderBy(name).rowsBetween(-rows, -1)
    out = spread.withColumns({n: c.over(w) for n, c in aggs.items()})
    return out.where(F.col("_block") == F.col("_own")).select(*df.columns, name, *aggs)


def _local_sessions(times: DataFrame, keys: Sequence[str], gap: int, chunk: int | Column | None) -> DataFrame:
    """Rows (one per key and ``_ts``) with ``_chunk`` and a session number that restarts in each chunk."""
    chunked = cut(times, keys, ["_ts"], chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_ts")
    step = micros("_ts") - F.lag(micros("_ts")).over(w)
    marked = chunked.withColumn("_new", (step.isNull() | (step > gap * 1_000_000)).cast("long"))
    return marked.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _numbered_partials(partial: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Add the session number of each partial session (``_first``, ``_last``).

    Sessions of a key lie more than ``gap`` apart, so a key has at most (time range / gap)
    of them plus one per chunk: this window is bounded by the calendar, not by the rows.
    """
    w = Window.partitionBy(*keys).orderBy("_first", "_last")
    step = micros("_first") - F.lag(micros("_last")).over(w)
    fresh = (step.isNull() | (step > gap * 1_000_000)).cast("long")
    return partial.withColumn("_fresh", fresh).withColumn("session_no", F.sum("_fresh").over(w)).drop("_fresh")


def session_ids(df: DataFrame, keys: Sequence[str], ts: str, gap: int, chunk: int | Column | None = None) -> DataFrame:
    """Rows with their session number per key (1, 2, ..)."""
    stamped = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    marked = _local_sessions(stamped.select(*keys, "_ts").distinct(), keys, gap, chunk)
    partial = marked.groupBy(*keys, "_chunk", "_sid").agg(F.min("_ts").alias("_first"), F.max("_ts").alias("_last"))
    numbers = null_safe_join(marked, _numbered_partials(partial, keys, gap).drop("_first", "_last"), [*keys, "_chunk", "_sid"])
    return null_safe_join(stamped, numbers.select(*keys, "_ts", "session_no"), [*keys, "_ts"]).select(*df.columns, "session_no")


def sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: int, aggs: Mapping[str, tuple[str, Column]],
             chunk: int | Column | None = None, end: str = "gap") -> DataFrame:
    """Activity sessions per key: a step strictly longer than ``gap`` seconds starts a new one.

    Rows fold to one per key and time, these to partial sessions inside (key, chunk), and only
    partial sessions are chained across chunk borders and folded again. ``aggs`` maps a
    name to (sum | count | min | max, column). ``end='gap'`` closes a session at its last
    event plus the gap, ``end='last_event'`` at its last event.
    """
    folds = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    stamped = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    per_time = stamped.groupBy(*keys, "_ts").agg(*[folds[k](c).alias(n) for n, (k, c) in aggs.items()])
    partial = _local_sessions(per_time, keys, gap, chunk).groupBy(*keys, "_chunk", "_sid").agg(
        F.min("_ts").alias("_first"), F.max("_ts").alias("_last"), *[again[k](n).alias(n) for n, (k, _) in aggs.items()])
    linked = _numbered_partials(partial, keys, gap)
    closing = F.max("_last")
    if end == "gap":
        closing = closing + F.expr(f"INTERVAL {gap} SECONDS")
    return linked.groupBy(*keys, "session_no").agg(
        F.min("_first").alias("session_start"), closing.alias("session_end"),
        *[again[k](n).alias(n) for n, (k, _) in aggs.items()])


def following(df: DataFrame, keys: Sequence[str], ts: str, tie: str | None, cols: Mapping[str, str],
              chunk: int | Column | None = None) -> DataFrame:
    """Add columns holding the next row's values: the row before, in falling order.

    ``tie`` is a numeric column that orders rows of the same time.
    """
    back = df.withColumn("_back", -micros(ts))
    order = ["_back"]
    if tie:
        back = back.withColumn("_tie", -F.col(tie))
        order.append("_tie")
    return previous(back, keys, order, cols, chunk).drop("_back", "_tie")
