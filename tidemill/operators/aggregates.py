"""Grouped aggregates. Every one has a partial step before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exact import dec
from tidemill.operators.relational import top_n_per_group


def group_agg(df: DataFrame, keys: Sequence[Column | str], **aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def global_agg(df: DataFrame, **aggs: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def min_max_by_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return group_agg(df, keys, max_value=F.max(value), min_value=F.min(value))


def conditional_sum(c: Column, when: Column) -> Column:
    return F.sum(F.when(when, c))


def rate_pct(part: Column, base: Column) -> Column:
    """part / base * 100, 0 when the base is 0."""
    return F.when(base > 0, part * 100.0 / base).otherwise(F.lit(0.0))


def share_pct(part: Column, whole: Column) -> Column:
    """NULL-safe share: a missing part counts 0, a zero whole gives NULL."""
    return F.coalesce(part, F.lit(0)) * 100.0 / F.nullif(whole, F.lit(0))


def topk(df: DataFrame, keys: Sequence[str], value: str, k: int, distinct: bool = False) -> DataFrame:
    """k largest values per group as a descending array.

    Only k rows per group and partition reach the shuffle, so the array stays k long
    and no task ever holds a whole group.
    """
    rows = df.select(*keys, value).where(F.col(value).isNotNull())
    if distinct:
        rows = rows.distinct()
    best = top_n_per_group(rows, keys, [F.col(value).desc()], k)
    return best.groupBy(*keys).agg(F.sort_array(F.collect_list(value), asc=False).alias("top"))


def latest_by_offset(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values carried by the newest record of each key."""
    newest = top_n_per_group(df.select(*keys, *order, *[c for c in cols if c not in order]), keys,
                             [F.col(o).desc() for o in order], 1)
    return newest.select(*keys, *cols)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """One pass over the table, then one row per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def count_distinct_twice_grouped(df: DataFrame, keys: Sequence[str], member: str, name: str) -> DataFrame:
    """Exact distinct members per group, aggregated by (group, member) first.

    The first step spreads a hot group over its members; the second only counts them.
    """
    return (df.select(*keys, member).distinct()
            .groupBy(*keys).agg(F.count(member).alias(name)))


def word_count(df: DataFrame, text: str, strip: str) -> DataFrame:
    """Lower-cased words with punctuation stripped at both ends, counted."""
    words = df.select(text).select(F.explode(F.split(F.lower(F.col(text)), "[ \t\n\r]+")).alias("raw"))
    return (words.select(F.btrim("raw", F.lit(strip)).alias("word"))
            .where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n")))


def last_n_reasons(df: DataFrame, key: str, order: Sequence[str], reason: str, risk: str, n: int = 5) -> DataFrame:
    """Alert count, total and mean risk, and the last n reasons of each user.

    Totals come from a partial aggregate; only the newest n rows per user are ordered.
    """
    totals = df.groupBy(key).agg(
        F.count("*").alias("alert_count"), F.sum(dec(risk, 6)).cast("double").alias("total_risk"),
        F.max(order[0]).alias("last_alert_at"))
    last = top_n_per_group(df.select(key, *order, *[c for c in [reason] if c not in order]), [key], [F.col(o).desc() for o in order], n)
    listed = last.groupBy(key).agg(
        F.concat_ws(" | ", F.transform(F.sort_array(F.collect_list(F.struct(*order, F.col(reason).alias("_why")))),
                                       lambda s: s["_why"])).alias("reasons"))
    return (totals.join(listed, key, "left")
            .withColumn("avg_risk", F.col("total_risk") / F.col("alert_count")))


def weighted_avg(value: Column, weight: Column, scale: int | None = None) -> Column:
    """Sum of value times weight over the sum of weights, of rows that have both.

    Numbers are taken as they are; ``scale`` sums them as DECIMALs of so many digits instead, which for money makes
    the result independent of the order of addition.
    """
    v, w = (value, weight) if scale is None else (dec(value, scale), dec(weight, scale))
    both = value.isNotNull() & weight.isNotNull()
    return F.sum(F.when(both, v * w)).cast("double") / F.sum(F.when(both, w)).cast("double")


def mode_by_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most common value per group; a tie goes to the smallest value."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return top_n_per_group(counts, keys, [F.col("n").desc(), F.col(value)], 1).drop("rn")


def experiment_split(df: DataFrame, key: str, variation: Mapping[str, Column], member: str) -> DataFrame:
    """Distinct members per variation, spread into one column each.

    Flags are folded per (key, member) first, so the second step is a plain sum.
    """
    flags = df.groupBy(key, member).agg(*[F.max(c.cast("int")).alias(n) for n, c in variation.items()])
    return flags.groupBy(key).agg(*[F.sum(n).alias(n) for n in variation])


def pivot_counts(df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(F.col(col) == v).alias(v) for v in values])


def running_global(df: DataFrame, period: Column, **aggs: Column) -> DataFrame:
    """Cumulative totals over periods.

    Rows fold to one row per period first (bounded by the calendar, not the data), so
    the unpartitioned running window only sees that short list.
    """
    daily = df.groupBy(period.alias("period")).agg(*[c.alias(n) for n, c in aggs.items()])
    w = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("period", *aggs, *[F.sum(n).over(w).alias(f"running_{n}") for n in aggs])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Median per group, the mean of the two middle values if the count is even.

    Rows fold to (group, value) counts first, and the position of each value comes from a
    running count that is cut into ranges of values, so no task holds a large group.
    """
    from tidemill.operators.ordered import null_safe_join, running
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = running(counts, keys, [value], {"_upto": ("sum", F.col("_n"))})
    totals = df.groupBy(*keys).agg(F.count(value).alias("_all"))
    lo, hi = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    start = F.col("_upto") - F.col("_n")
    held = null_safe_join(placed, totals, keys)
    low = F.when((start < lo) & (lo <= F.col("_upto")), F.col(value))
    high = F.when((start < hi) & (hi <= F.col("_upto")), F.col(value))
    return held.groupBy(*keys).agg(((F.max(low) + F.max(high)) / 2).alias(name))
