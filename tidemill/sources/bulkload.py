"""Bulk loads of delimited files: file ledger, bad-row capture and load history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import hadoop_fs, materialize
from tidemill.sources.files import with_lineage

LEDGER_DDL = ("file string, modified timestamp, size bigint, parsed bigint, loaded bigint, errors bigint, "
              "status string, first_error string, load_id string, loaded_at timestamp")


class LoadAborted(ValueError):
    """Raised before anything is written when ON_ERROR = ABORT meets a bad row."""


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with time and size; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")))


def read_raw(spark: SparkSession, files: Sequence[str] | str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """All-text rows with their file and row number."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("sep", sep).csv(files if isinstance(files, str) else list(files))
    return with_lineage(raw, "raw").drop("file_modified_at", "loaded_at", "load_id")


def _checks(schema: T.StructType, null_if: Sequence[str]) -> tuple[list[Column], list[Column]]:
    typed, failed = [], []
    for f in schema.fields:
        raw = F.when(F.col(f.name).isin(*null_if), None).otherwise(F.col(f.name))
        value = raw.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        wrong = raw.isNotNull() & value.isNull()
        if not f.nullable:
            wrong = wrong | raw.isNull()
        failed.append(F.when(wrong, F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("value"),
                                             F.lit(f.dataType.simpleString()).alias("expected"))))
    return typed, failed


def parse(raw: DataFrame, schema: T.StructType, null_if: Sequence[str] = ("NULL", "null", "")) -> DataFrame:
    """Typed columns, lineage, and the list of values that did not fit."""
    typed, failed = _checks(schema, null_if)
    errors = F.filter(F.array(*failed), lambda e: e.isNotNull())
    return raw.select(*typed, "source_file", "row_number", errors.alias("_errors"))


def validate_load(spark: SparkSession, path: str, schema: T.StructType, mode: str = "errors", n: int = 10) -> DataFrame:
    """Dry run: the errors, or the first n rows of each file. Nothing is written."""
    parsed = parse(read_raw(spark, path, schema), schema)
    if mode == "errors":
        return rejected_rows(parsed)
    return parsed.where(F.col("row_number") <= n).drop("_errors")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """One row per bad value: file, row, column, value and expected type."""
    return (parsed.where(F.size("_errors") > 0)
            .select("source_file", "row_number", F.explode("_errors").alias("e"))
            .select("source_file", "row_number", "e.column_name", "e.value", "e.expected"))


def load_history(parsed: DataFrame) -> DataFrame:
    """Per file: rows parsed, loaded and in error, the first error and a status."""
    bad = F.size("_errors") > 0
    per = parsed.groupBy("source_file").agg(
        F.count("*").alias("parsed"), F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("errors"),
        F.min_by(F.try_element_at("_errors", F.lit(1)), F.when(bad, F.col("row_number"))).alias("_first"))
    status = (F.when(F.col("errors") == 0, "LOADED").when(F.col("loaded") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    return per.select("source_file", "parsed", "loaded", "errors", status.alias("status"),
                      F.concat(F.col("_first.column_name"), F.lit("="), F.col("_first.value")).alias("first_error"))


def copy_into(spark: SparkSession, path: str, table_path: str, ledger_path: str, schema: T.StructType,
              on_error: str = "ABORT", force: bool = False, load_id: str = "load") -> DataFrame:
    """Load the files not loaded before; returns this run's history.

    A file counts as loaded when the ledger has its path, time and size, unless ``force``.
    ABORT raises before anything is written if any row is bad; CONTINUE loads the good rows
    and sets the bad ones aside under ``<table>_rejects``.
    """
    if on_error not in ("ABORT", "CONTINUE"):
        raise ValueError("on_error must be ABORT or CONTINUE")
    files = list_files(spark, path).where(F.col("file").rlike("\\.(csv|txt)(\\.[a-z0-9]+)?$"))
    fs, ledger = hadoop_fs(spark, ledger_path)
    todo = files
    if fs.exists(ledger) and not force:
        done = spark.read.schema(LEDGER_DDL).parquet(ledger_path).where("status != 'LOAD_SKIPPED'")
        todo = files.join(done.select("file", "modified", "size"), ["file", "modified", "size"], "left_anti")
    names = [r["file"] for r in todo.select("file").collect()]  # file names only, as Spark's own listing holds
    stamp = [F.lit(load_id).alias("load_id"), F.current_timestamp().alias("loaded_at")]
    skipped = files.join(todo.select("file"), "file", "left_anti").select(
        "file", "modified", "size", *[F.lit(0).cast("bigint").alias(c) for c in ("parsed", "loaded", "errors")],
        F.lit("LOAD_SKIPPED").alias("status"), F.lit(None).cast("string").alias("first_error"), *stamp)
    history = skipped
    if names:
        parsed = materialize(parse(read_raw(spark, names, schema), schema), "parsed")
        per_file = load_history(parsed).withColumnRenamed("source_file", "file")
        history = skipped.unionByName(files.join(per_file, "file").select(
            "file", "modified", "size", "parsed", "loaded", "errors", "status", "first_error", *stamp))
        if on_error == "ABORT":
            bad = parsed.where(F.size("_errors") > 0).limit(1).collect()
            if bad:
                raise LoadAborted(f"bad value in {bad[0]['source_file']} row {bad[0]['row_number']}: {bad[0]['_errors'][0]}")
        good = parsed.where(F.size("_errors") == 0)
        good.select(*[f.name for f in schema.fields], "source_file", "row_number",
                    F.lit(load_id).alias("load_id")).write.mode("append").parquet(table_path)
        rejected_rows(parsed).withColumn("load_id", F.lit(load_id)).withColumn(
            "detected_at", F.current_timestamp()).write.mode("append").parquet(f"{table_path}_rejects")
    history.write.mode("append").parquet(ledger_path)  # last, so that a failed load is repeated
    return spark.read.schema(LEDGER_DDL).parquet(ledger_path).where(F.col("load_id") == load_id)


def bronze_to_silver(bronze: DataFrame, types: Mapping[str, str], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Typed, one row per key; lineage columns stay."""
    from tidemill.operators.incremental import dedup_by_key
    typed = bronze.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return dedup_by_key(typed, keys, order)
