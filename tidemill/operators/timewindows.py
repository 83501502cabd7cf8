"""Time windows over an event-time column, in batch and (where noted) on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import ordered as O
from tidemill.functions.exact import dec, mean


def _named(aggs: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def _bounds(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggs)


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (), **aggs: Column) -> DataFrame:
    """Fixed windows. Works on streams; there the caller sets the watermark."""
    return _bounds(df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*_named(aggs)), keys, aggs)


def hopping(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (), **aggs: Column) -> DataFrame:
    """Overlapping windows. Works on streams."""
    return _bounds(df.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(*_named(aggs)), keys, aggs)


def hopping_from_slides(df: DataFrame, ts: str, size: int, slide: int, keys: Sequence[str],
                        sums: Mapping[str, Column]) -> DataFrame:
    """Hopping sums by way of one tumbling fold per slide (seconds).

    A row meets size/slide windows; folding rows to slides first means that only the
    folded rows, not the raw ones, are copied into the overlapping windows.
    """
    if size % slide:
        raise ValueError("size must be a multiple of slide")
    panes = df.groupBy(F.window(ts, f"{slide} seconds").alias("w"), *keys).agg(*_named(sums))
    starts = F.transform(F.sequence(F.lit(0), F.lit(size // slide - 1)),
                         lambda i: F.col("w.start") - F.make_dt_interval(secs=i * slide))
    spread = panes.select(F.explode(starts).alias("window_start"), *keys, *sums)
    return spread.groupBy("window_start", *keys).agg(*[F.sum(n).alias(n) for n in sums])


def session(df: DataFrame, ts: str, gap: int, keys: Sequence[str], aggs: Mapping[str, tuple[str, Column]],
            end: str = "gap", chunk: int | Column | None = None) -> DataFrame:
    """Sessions with their duration in seconds; see ``ordered.sessions`` for how hot keys are cut.

    A streaming input goes through ``session_window`` (append or complete mode).
    """
    if df.isStreaming:
        folds = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
        grouped = df.groupBy(F.session_window(ts, f"{gap} seconds").alias("w"), *keys).agg(
            *[folds[k](c).alias(n) for n, (k, c) in aggs.items()], F.max(ts).alias("_last"))
        close = F.col("w.end") if end == "gap" else F.col("_last")
        out = grouped.select(*keys, F.col("w.start").alias("session_start"), close.alias("session_end"), *aggs)
    else:
        out = O.sessions(df, keys, ts, gap, aggs, chunk, end).drop("session_no")
    length = (O.micros("session_end") - O.micros("session_start")) / F.lit(1_000_000.0)
    return out.withColumn("duration_s", length)


def moving_average(df: DataFrame, ts: str, size: int, slide: int, keys: Sequence[str], value: str, scale: int | None = None) -> DataFrame:
    """Sum, count and mean over hopping windows; money is summed with its ``scale`` digits."""
    out = hopping_from_slides(df, ts, size, slide, keys, {"total": F.sum(value if scale is None else dec(value, scale)), "n": F.count(value)})
    return out.withColumn("total", F.col("total").cast("double")).withColumn("mean", F.col("total") / F.col("n"))


def window_lookup(mv: DataFrame, key: str, value, lo: Column, hi: Column) -> DataFrame:
    """Rows of a saved window table for one key and a range of window starts."""
    return mv.where((F.col(key) == value) & (F.col("window_start") >= lo) & (F.col("window_start") < hi))


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, complete_only: bool = True,
                 chunk: int | Column | None = None, **aggs: Column) -> DataFrame:
    """Windows of n records per key; a window fires when it is full."""
    num = O.numbered(df, keys, order, "_rn", chunk).withColumn("window_no", F.floor((F.col("_rn") - 1) / n).cast("long"))
    out = num.groupBy(*keys, "window_no").agg(F.count("*").alias("_size"), *_named(aggs))
    return (out.where(F.col("_size") == n) if complete_only else out).drop("_size")


def window_distinct(df: DataFrame, ts: str, size: str, keys: Sequence[str], member: str, name: str) -> DataFrame:
    """Exact distinct members per window, folded per (window, member) first."""
    once = df.select(F.window(ts, size).alias("w"), *keys, member).distinct()
    return (once.groupBy("w", *keys).agg(F.count(member).alias(name))
            .select(F.col("w.start").alias("window_start"), *keys, name))


def gap_fill(windows: DataFrame, start: str, step: str, zero: Mapping[str, object], keys: Sequence[str] = ()) -> DataFrame:
    """Every window between the first and the last, of each key if there are keys, empty ones with the given values."""
    span = windows.groupBy(*keys).agg(F.min(start).alias("_a"), F.max(start).alias("_b")).where("_a IS NOT NULL")
    spine = span.select(*keys, F.explode(F.expr(f"sequence(_a, _b, interval {step})")).alias(start))
    held = windows.withColumnsRenamed({c: f"_r_{c}" for c in (*keys, start)})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys] + [F.col(start) == F.col(f"_r_{start}")]
    return spine.join(held, on, "left").drop(*[f"_r_{c}" for c in (*keys, start)]).withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in zero.items()})


def multi_resolution(df: DataFrame, ts: str, sizes: Sequence[str], keys: Sequence[str],
                     aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """The same aggregate at several sizes, the coarse ones rolled up from the finest.

    ``sizes`` run from fine to coarse, each a multiple of the one before. The raw rows
    are read and shuffled once.
    """
    folds = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    again = {**folds, "count": F.sum}
    fine = df.groupBy(F.window(ts, sizes[0]).alias("w"), *keys).agg(
        *[folds[k](c).alias(n) for n, (k, c) in aggs.items()])
    fine = fine.select(F.col("w.start").alias("window_start"), *keys, *aggs)
    levels = []
    for s in sizes:
        w = F.window("window_start", s)
        level = fine.groupBy(w.alias("w"), *keys).agg(*[again[k](n).alias(n) for n, (k, _) in aggs.items()])
        levels.append(level.select(F.lit(s).alias("size"), F.col("w.start").alias("window_start"), *keys, *aggs))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def mean_duration_by_hour(df: DataFrame, event_ts: str, arrival_ts: str, value: str, scale: int | None = None) -> DataFrame:
    """Mean per hour under event time and under arrival time, side by side."""
    def hourly(ts, name):
        return df.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
            mean(value, scale).alias(name))
    return hourly(event_ts, "mean_event_time").join(hourly(arrival_ts, "mean_arrival_time"), "hour", "full")
