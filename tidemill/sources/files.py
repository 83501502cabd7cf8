"""File scans with declared schemas, lineage columns and mixed record versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines under a fixed schema; the files are not read to infer one."""
    return spark.read.schema(schema).json(path)


def read_csv_typed(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header and types from the files themselves: a second pass, for small or unknown input."""
    return strip_bom(spark.read.option("header", True).option("inferSchema", True).csv(path))


def strip_bom(df: DataFrame) -> DataFrame:
    """Drop a byte-order mark glued to the first column's name."""
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def read_csv_format(spark: SparkSession, path: str, schema: T.StructType, null_if: Sequence[str] = ("NULL", "null", ""),
                    skip_header: bool = True, quote: str = '"', sep: str = ",") -> DataFrame:
    """A named file format: header skipped, optional quotes, several tokens read as NULL.

    All columns are read as text first, then NULL tokens are removed and types applied, so
    that a token such as 'null' in a number column is a NULL and not an error.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(text).option("header", skip_header).option("quote", quote).option("sep", sep)
           .option("enforceSchema", True).csv(path))
    return raw.select(*[
        F.when(F.col(f.name).isin(*null_if), None).otherwise(F.col(f.name)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields])


def inline_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Literal rows as a table, for short lookups."""
    return spark.createDataFrame(list(rows), ddl)


def read_parquet_cols(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*cols)


def read_partitioned(spark: SparkSession, path: str, predicate: Column) -> DataFrame:
    """Directory-partitioned data; a predicate on partition columns prunes directories."""
    return spark.read.parquet(path).where(predicate)


def load_seed(spark: SparkSession, path: str, ddl: str, grain: Sequence[str]) -> DataFrame:
    """Seed file to a typed table; repeated keys are an error."""
    seed = spark.read.schema(ddl).option("header", True).csv(path)
    repeated = seed.groupBy(*grain).count().where("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"seed {path} has more than one row for a value of {list(grain)}")
    return seed


def with_lineage(df: DataFrame, load_id: str, row_numbers: bool = True) -> DataFrame:
    """Add source file, row number in the file, file time, load time and load id.

    Row numbers follow the reading order inside a file split, offset by the rows of the
    earlier splits of that file, so a large file is not drawn into one task.
    """
    cols = df.columns
    out = df.select("*", F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_block_start").alias("_block"),
                    F.col("_metadata.file_modification_time").alias("file_modified_at"),
                    F.current_timestamp().alias("loaded_at"), F.lit(load_id).alias("load_id"))
    if not row_numbers:
        return out.drop("_block")
    out = out.withColumn("_seq", F.monotonically_increasing_id())
    sizes = out.groupBy("source_file", "_block").agg(F.count("*").alias("_rows"), F.min("_seq").alias("_start"))
    w = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(w), F.lit(0))).drop("_rows")
    numbered = out.join(offsets, ["source_file", "_block"])
    return numbered.select(*cols, "source_file",
                           (F.col("_seq") - F.col("_start") + F.col("_before") + 1).alias("row_number"),
                           "file_modified_at", "loaded_at", "load_id")


def flatten_api_json(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested record to flat columns (new name -> struct path); a missing parent gives NULL."""
    return df.select(*[F.col(p).alias(n) for n, p in paths.items()])


def read_evolved(versions: Sequence[DataFrame], target: T.StructType, defaults: Mapping[str, object]) -> DataFrame:
    """Records of several schema versions as the newest one.

    A field a version does not have takes its default, or NULL.
    """
    def upgrade(df: DataFrame) -> DataFrame:
        cols = []
        for f in target.fields:
            have = F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))
            cols.append(have.cast(f.dataType).alias(f.name))
        return df.select(*cols)
    return reduce(lambda a, b: a.unionByName(b), [upgrade(v) for v in versions])
