"""Aggregates kept as mergeable sketches: distinct members per window, and column profiles.

A sketch is saved per small unit (a minute, a partition); wider windows and whole tables are unions of saved sketches, so
that neither the rows nor what was saved before are read again. Distinct counts are HyperLogLog sketches with 2**lg registers: the
standard error is about 1.04 / sqrt(2**lg), 1.6 % for the default. Quantiles are KLL sketches: with ``k`` 200 a quantile's rank is off by
about 1.3 % at most, with high probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG = 12
KLL_K = 200


def distinct_sketches(df: DataFrame, ts: str, member: str, keys: Sequence[str] = (), size: str = "1 minute", lg: int = LG) -> DataFrame:
    """(window_start, keys, sketch) of the members seen in each window. Works on streams; there the caller sets the watermark.

    NULL members do not count. Members are whole numbers, text or binary.
    """
    folded = df.groupBy(F.window(ts, size).alias("w"), *keys).agg(F.hll_sketch_agg(member, F.lit(lg)).alias("sketch"))
    return folded.select(F.col("w.start").alias("window_start"), *keys, "sketch")


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One sketch per window and keys of saved ones that may hold several, as appended batches do."""
    return sketches.groupBy("window_start", *keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_over(sketches: DataFrame, size: str | None, keys: Sequence[str] = (), name: str = "members") -> DataFrame:
    """Distinct members per coarser window (None: over all time), from the saved sketches only."""
    if size is None:
        return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    folded = sketches.groupBy(F.window("window_start", size).alias("w"), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    return folded.select(F.col("w.start").alias("window_start"), *keys, name)


def profile_sketches(df: DataFrame, cols: Sequence[str] | None = None, keys: Sequence[str] = (), lg: int = LG, k: int = KLL_K) -> DataFrame:
    """(keys, column_name, counts, moments, extremes, sketches): one mergeable row per column (and key), from one pass.

    ``keys`` may name what the table is partitioned by, so that a new partition's rows are added to those saved. Moments, extremes and
    quantiles as numbers are kept of numeric columns, extremes as text of all others.
    """
    cols = [c for c in (cols or df.columns) if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def one(c: str) -> list[Column]:
        number = F.col(c).cast("double") if isinstance(kinds[c], T.NumericType) else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if isinstance(kinds[c], T.NumericType) else F.col(c).cast("string")
        return [F.count(F.lit(1)).alias(f"row_count|{c}"), F.count_if(F.col(c).isNull()).alias(f"null_count|{c}"), F.min(number).alias(f"low|{c}"),
                F.max(number).alias(f"high|{c}"), F.min(text).alias(f"low_text|{c}"), F.max(text).alias(f"high_text|{c}"),
                F.sum(number).alias(f"total|{c}"), F.sum(number * number).alias(f"squares|{c}"),
                F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg)).alias(f"members|{c}"), F.kll_sketch_agg_double(number, F.lit(k)).alias(f"ranks|{c}")]
    names = [x.split("|")[0] for x in ("row_count|", "null_count|", "low|", "high|", "low_text|", "high_text|", "total|", "squares|", "members|", "ranks|")]
    wide = df.groupBy(*keys).agg(*[x for c in cols for x in one(c)])
    rows = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{n}|{c}`").alias(n) for n in names]) for c in cols]
    return wide.select(*keys, F.explode(F.array(*rows)).alias("p")).select(*keys, "p.*")


def merge_profiles(profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per column (and key) of any number of saved ones."""
    return profiles.groupBy(*keys, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.hll_union_agg("members").alias("members"), F.kll_merge_agg_double("ranks").alias("ranks"))


def profile_report(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), keys: Sequence[str] = ()) -> DataFrame:
    """Counts, distinct estimate, extremes, mean, deviation and quantiles of merged profiles."""
    n = F.col("row_count") - F.col("null_count")
    numeric = F.col("total").isNotNull()
    spread = F.sqrt(F.greatest((F.col("squares") - F.col("total") * F.col("total") / n) / (n - 1), F.lit(0.0)))
    ranks = [F.when(numeric, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"p{round(q * 100):02d}") for q in quantiles]
    return profiles.select(
        *keys, "column_name", "row_count", "null_count", F.hll_sketch_estimate("members").alias("distinct_count"),
        F.coalesce(F.col("low").cast("string"), "low_text").alias("min_value"), F.coalesce(F.col("high").cast("string"), "high_text").alias("max_value"),
        (F.col("total") / n).alias("mean"), F.when(n > 1, spread).alias("stddev"), *ranks)
