"""Joins: equi, star, interval, as-of and lookup.

Small sides are left to AQE, which broadcasts a side once its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions otherwise. Nothing is
hinted here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.ordered import micros, running


def inner_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "inner")


def left_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "left")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Column | str | list[str]]]) -> DataFrame:
    """Join a fact to its dimensions one after the other."""
    for dim, on in dims:
        fact = fact.join(dim, on, "inner")
    return fact


def join_cast_key(a: DataFrame, a_key: str, b: DataFrame, b_key: str, how: str = "inner") -> DataFrame:
    """Join a text key to a numeric one by casting the number to text."""
    return a.join(b, F.col(a_key) == F.col(b_key).cast("string"), how)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], lt: str, rt: str,
                  lower: int, upper: int) -> DataFrame:
    """Pairs with equal keys and ``rt`` in [lt + lower, lt + upper] (seconds).

    Batch: time is cut into buckets as wide as the range, and the bucket joins the equi
    key. The left row visits the at most two buckets its range touches, the right row has
    one, so each pair is met once and a hot key is spread over its buckets.
    """
    if left.isStreaming or right.isStreaming:
        return stream_interval_join(left, right, keys, lt, rt, lower, upper)
    width = max(upper - lower, 1) * 1_000_000
    lm, rm = micros(lt), micros(rt)
    a = left.withColumn("_b", F.explode(F.sequence(
        F.floor((lm + lower * 1_000_000) / width).cast("long"),
        F.floor((lm + upper * 1_000_000) / width).cast("long"))))
    b = right.withColumn("_c", F.floor(rm / width).cast("long"))
    on = [F.col(x) == F.col(y) for x, y in keys] + [
        F.col("_b") == F.col("_c"),
        (micros(rt) - micros(lt)).between(lower * 1_000_000, upper * 1_000_000)]
    return a.join(b, on, "inner").drop("_b", "_c")


def _watermarked(df: DataFrame) -> bool:
    return "EventTimeWatermark" in df._jdf.queryExecution().analyzed().toString()


def stream_interval_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], lt: str, rt: str,
                         lower: int, upper: int) -> DataFrame:
    """The same join on streams. Both sides need a watermark, or the state never shrinks."""
    for name, side in (("left", left), ("right", right)):
        if side.isStreaming and not _watermarked(side):
            raise ValueError(f"the {name} stream has no watermark: its join state would grow without bound")
    on = [F.col(x) == F.col(y) for x, y in keys]
    on += [F.col(rt) >= F.col(lt) + F.expr(f"INTERVAL {lower} SECONDS"),
           F.col(rt) <= F.col(lt) + F.expr(f"INTERVAL {upper} SECONDS")]
    return left.join(right, on, "inner")


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], lt: str, rt: str,
                within: int) -> DataFrame:
    """WITHIN n seconds on either side."""
    return interval_join(left, right, keys, lt, rt, -within, within)


def lookup_enrich(facts: DataFrame, dim: DataFrame, on: Column, defaults: Mapping[str, object]) -> DataFrame:
    """Left join to a table (also from a stream) with defaults where the row is missing."""
    joined = facts.join(dim, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def asof_lookup(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str, cols: Mapping[str, str],
                left_id: str, right_id: str, chunk: int | Column | None = None, right_key: str | None = None) -> DataFrame:
    """For each left row, the newest right row of its key with ``rt <= lt``.

    A NULL key meets nothing: such a left row stays without a match.     Both sides go into one ordered list and the last right row is carried forward, so the
    cost is a sort per (key, chunk) and never key-size squared.
    """
    held = F.struct(*[F.col(src).alias(new) for new, src in cols.items()])
    left_cols = left.columns
    a = left.select(F.col(key).alias("_k"), F.col(lt).alias("_t"), F.lit(1).alias("_side"),
                    F.col(left_id).cast("long").alias("_id"), F.struct(*left_cols).alias("_left"),
                    F.lit(None).cast(right.select(held).schema[0].dataType).alias("_held"))
    b = right.where(F.col(right_key or key).isNotNull()).select(F.col(right_key or key).alias("_k"), F.col(rt).alias("_t"), F.lit(0).alias("_side"),
                     F.col(right_id).cast("long").alias("_id"),
                     F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), held.alias("_held"))
    both = a.unionByName(b)
    seen = running(both, ["_k"], ["_t", "_side", "_id"], {"_last": ("last", F.col("_held"))}, chunk)
    return (seen.where(F.col("_side") == 1)
            .select(*[F.col(f"_left.{c}").alias(c) for c in left_cols],
                    *[F.col(f"_last.{c}").alias(c) for c in cols]))


def anti_join_new(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have yet."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def not_in_subquery(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """SQL ``NOT IN``: one NULL in the subquery leaves no rows; an empty subquery leaves all.

    A plain anti join, with counts of the subquery as scalar guards, so that no size forces a broadcast.
    """
    values = sub.select(F.col(sub_col).alias("_not_in"))
    kept = df.join(values, F.col(col) == F.col("_not_in"), "left_anti")
    return df.sparkSession.sql(
        f"SELECT * FROM {{kept}} WHERE (SELECT count(*) FROM {{sub}}) = 0"
        f" OR (`{col}` IS NOT NULL AND (SELECT count_if(`{sub_col}` IS NULL) FROM {{sub}}) = 0)", kept=kept, sub=sub)


def semi_join_exists(df: DataFrame, ref: DataFrame, on: Column) -> DataFrame:
    return df.join(ref, on, "left_semi")


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Date dimension, one row per day from start to end, both included."""
    days = spark.sql("SELECT explode(sequence(to_date(:a), to_date(:b), interval 1 day)) AS day",
                     args={"a": start, "b": end})
    return with_calendar_parts(days)


def calendar_over(df: DataFrame, ts: str) -> DataFrame:
    """Date dimension spanning a table's own first to last day."""
    span = df.agg(F.min(ts).cast("date").alias("a"), F.max(ts).cast("date").alias("b"))
    return with_calendar_parts(span.select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("day")))


def with_calendar_parts(days: DataFrame) -> DataFrame:
    d = F.col("day")
    return days.select(d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
                       F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day_of_month"),
                       F.weekday(d).alias("weekday"))
