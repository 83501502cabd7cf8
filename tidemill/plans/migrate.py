"""Moving a table with an added column, and selective reads of differently laid out copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.scalar import date_diff_days
from tidemill.operators.cdc import compare_replica
from tidemill.sinks.files import write_clustered, write_partitioned


def migrate_with_duration(source: DataFrame, ordered: str, shipped: str, write: Callable[[DataFrame], None],
                          read: Callable[[], DataFrame]) -> DataFrame:
    """Add the shipping duration, write, read back, and fail if the rows differ in number or value.

    Both sides fold to a row count and the sum of their rows' hashes, one pass each. ``write`` and ``read`` bind the
    target: files, or ``write_jdbc_parallel``/``read_jdbc``.
    """
    rows = source.withColumn("shipping_duration", date_diff_days(F.col(shipped), F.col(ordered)))
    write(rows)
    target = read()
    a, b = (_fingerprint(df.select(*rows.columns)) for df in (rows, target))
    if a != b:
        raise ValueError(f"target has {b[0]} rows, source {a[0]}" if a[0] != b[0] else "target and source differ in values")
    return target


def _fingerprint(df: DataFrame) -> tuple:
    sums = [F.sum(F.xxhash64(*[F.struct(F.lit(seed)), *df.columns]).cast("decimal(20,0)")) for seed in (1, 2)]
    return tuple(df.agg(F.count("*"), *sums).first())


def reconcile(source: DataFrame, target: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return compare_replica(source, target, key, fields)


def write_three_ways(df: DataFrame, path: str, ts: str, tag: str) -> None:
    """A plain copy, one partitioned by month, and one partitioned and sorted by the tag."""
    df.write.mode("overwrite").parquet(f"{path}/plain")
    month = F.date_format(ts, "yyyy-MM")
    write_partitioned(df.withColumn("month", month), f"{path}/partitioned", ["month"])
    write_clustered(df, f"{path}/clustered", month, "month", [tag])


def tag_search(spark: SparkSession, path: str, layout: str, ts: str, lo: Column, hi: Column, tag: str, value: str) -> DataFrame:
    """Rows of a time range with a tag. Where months are directories, the range also prunes them."""
    df = spark.read.parquet(f"{path}/{layout}").where(F.col(ts).between(lo, hi) & (F.col(tag) == value))
    if layout != "plain":
        df = df.where(F.col("month").between(F.date_format(lo, "yyyy-MM"), F.date_format(hi, "yyyy-MM"))).drop("month")
    return df
