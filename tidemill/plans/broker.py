"""Offsets and partitions of an event log: lag, skew and routing by place."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import hash_partition, map_lookup

# Country codes of the three regions, in partition order.
REGIONS = {
    "US": 0, "CA": 0, "BR": 0, "MX": 0, "AR": 0,
    "GB": 1, "DE": 1, "FR": 1, "ES": 1, "IT": 1,
    "JP": 2, "AU": 2, "IN": 2, "KR": 2, "SG": 2,
}


def lag_level(lag: Column, elevated: int = 1000, high: int = 10_000) -> Column:
    return F.when(lag > high, "high").when(lag > elevated, "elevated").otherwise("ok")


def consumer_lag(ends: DataFrame, commits: DataFrame, elevated: int = 1000, high: int = 10_000) -> DataFrame:
    """Lag by partition and topic of each group; a partition never committed lags by all of it.

    ``ends``: topic, part, end_offset. ``commits``: grp, topic, part, committed.
    """
    every = ends.join(commits.select("grp", "topic").distinct(), "topic")
    per = every.join(commits, ["grp", "topic", "part"], "left").withColumn(
        "lag", F.greatest(F.lit(0), F.col("end_offset") - F.coalesce("committed", F.lit(0))))
    by_topic = per.groupBy("grp", "topic").agg(F.sum("lag").alias("lag")).withColumn("part", F.lit(-1))
    rows = per.select("grp", "topic", F.col("part").cast("int").alias("part"), "lag").unionByName(by_topic)
    return rows.withColumn("level", lag_level(F.col("lag"), elevated, high))


def partition_skew(df: DataFrame, part: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages and keys per partition, keys in more than one partition, imbalance).

    Rows fold to (partition, key) counts once; everything else is taken from those.
    """
    pairs = df.groupBy(part, key).agg(F.count("*").alias("n"))
    per = pairs.groupBy(part).agg(F.sum("n").alias("messages"), F.count("*").alias("keys"))
    strays = pairs.groupBy(key).agg(F.count("*").alias("partitions"), F.sum("n").alias("messages")).where("partitions > 1")
    imbalance = per.agg(F.max("messages").alias("largest"), F.min("messages").alias("smallest"),
                        (F.max("messages") / (F.sum("messages") / F.count("*"))).alias("imbalance"))
    return per, strays, imbalance


def geo_partition(country: Column, partitions: int, table: Mapping[str, int] = REGIONS) -> Column:
    """Partition of a country's region; unknown countries go by the MD5 of their code."""
    return F.coalesce(map_lookup(country, table), hash_partition(country, partitions, "md5"))


def misrouted(df: DataFrame, country: str, actual: str, partitions: int) -> DataFrame:
    """Messages that are not in the partition their country maps to."""
    expected = geo_partition(F.col(country), partitions)
    return df.withColumn("expected_part", expected).where(F.col(actual) != F.col("expected_part"))
