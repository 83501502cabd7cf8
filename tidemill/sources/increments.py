"""Pulling only what is new: key and time high-water marks, and JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("bulk", "incrementing", "timestamp", "timestamp+incrementing")


def read_increment(df: DataFrame, mode: str, id_col: str | None = None, ts_col: str | None = None,
                   state: Mapping[str, object] | None = None) -> DataFrame:
    """Rows past the stored high-water mark. ``state`` holds ``max_id`` and ``max_ts``.

    The mark enters as a literal, so the filter reaches the scan.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    state = state or {}
    max_id, max_ts = state.get("max_id"), state.get("max_ts")
    if mode == "bulk":
        return df
    newer_id = F.lit(True) if max_id is None else F.col(id_col) > F.lit(max_id) if id_col else F.lit(True)
    if mode == "incrementing":
        return df.where(newer_id)
    if max_ts is None:
        return df
    mark = F.lit(max_ts).cast(df.schema[ts_col].dataType)
    if mode == "timestamp":
        return df.where(F.col(ts_col) > mark)
    return df.where((F.col(ts_col) > mark) | ((F.col(ts_col) == mark) & newer_id))


def high_water(df: DataFrame, id_col: str | None, ts_col: str | None) -> dict[str, object]:
    """The new marks of a pulled batch: the newest time, and the largest id at that time."""
    if ts_col and id_col:
        row = df.agg(F.max(F.struct(ts_col, id_col)).alias("m")).first()["m"]
        return {"max_ts": row[0], "max_id": row[1]} if row else {}
    col = ts_col or id_col
    value = df.agg(F.max(col)).first()[0]
    return {} if value is None else {"max_ts" if ts_col else "max_id": value}


def jdbc_options(url: str, table_or_query: str, partitioning: Mapping[str, object] | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; with partition bounds the pull runs as that many range queries."""
    source = table_or_query.strip()
    is_query = source.lower().startswith(("select", "with"))
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partitioning:
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(partitioning)
        if missing:
            raise ValueError(f"partitioned JDBC read needs {sorted(missing)}")
        options["dbtable"] = f"({source}) q" if is_query else source
        options.update({k: str(v) for k, v in partitioning.items()})
    else:
        options["query" if is_query else "dbtable"] = source
    return options


def read_jdbc(spark: SparkSession, url: str, table_or_query: str,
              partitioning: Mapping[str, object] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table_or_query, partitioning)).load()
