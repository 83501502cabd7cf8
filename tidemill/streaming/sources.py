"""Stream sources over files; with its package present, ``format("kafka")`` feeds the same code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


FILES_PER_BATCH = 1000  # a micro-batch is bounded unless the caller sets another bound


def decode_json(raw: DataFrame, ddl: str, value: str = "value", ignore_parse_errors: bool = True,
                missing_ok: bool = True) -> DataFrame:
    """Typed columns from JSON text.

    Malformed records are skipped (or fail the query); absent fields become NULL (or the
    record is skipped).
    """
    schema = T.StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    mode = "PERMISSIVE" if ignore_parse_errors else "FAILFAST"
    probe = schema if not ignore_parse_errors else T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": mode, **({"columnNameOfCorruptRecord": "_bad"} if ignore_parse_errors else {})}
    rows = raw.select(F.from_json(value, probe, options).alias("r")).where("r IS NOT NULL")
    if ignore_parse_errors:
        rows = rows.where("r._bad IS NULL")
    out = rows.select(*[F.col(f"r.{n}").alias(n) for n in names])
    return out if missing_ok else out.dropna(subset=names)


def stream_json_events(spark: SparkSession, path: str, ddl: str, ignore_parse_errors: bool = True,
                       missing_ok: bool = True, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return decode_json(reader.text(path), ddl, "value", ignore_parse_errors, missing_ok)


def auto_ingest(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """CSV files as they land; the query's checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(path)


def stream_text_lines(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch).text(path).withColumn("arrived_at", F.current_timestamp())


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Bounded disorder: rows more than ``delay`` behind the newest time may be dropped."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def load_shed(df: DataFrame, keep: Column, key: Column, one_in: int) -> DataFrame:
    """Under overload keep all important rows and one in n of the others, chosen by a hash.

    ``weight`` scales counts back.
    """
    from tidemill.functions.scalar import hash_partition
    chosen = hash_partition(key, one_in) == 0
    return df.where(keep | chosen).withColumn("weight", F.when(keep, 1).otherwise(one_in))


def threshold_route(df: DataFrame, value: str, limit: float, outputs: Sequence[str] = ("alert", "normal")) -> DataFrame:
    return df.withColumn("route", F.when(F.col(value) > limit, outputs[0]).otherwise(outputs[1]))
