"""File and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet in one directory per value.

    Rows are rebalanced by the partition columns: a task does not open a file in every
    directory, small values share a task, and AQE splits a value that holds much of the
    table over several writers (by ``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    df.hint("rebalance", *[F.col(c) for c in cols]).write.mode(mode).partitionBy(*cols).parquet(path)


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("quoteAll", quote_all)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path))


def convert_format(spark: SparkSession, src: str, dst: str, schema, codec: str = "snappy") -> dict[str, int]:
    """CSV to Parquet; the row counts of both sides are compared."""
    source = spark.read.schema(schema).option("header", True).csv(src)
    source.write.mode("overwrite").option("compression", codec).parquet(dst)
    counts = {"source": source.count(), "target": spark.read.parquet(dst).count()}
    if counts["source"] != counts["target"]:
        raise ValueError(f"row counts differ after conversion: {counts}")
    return counts


def ctas(spark: SparkSession, name: str, query: str, path: str, **views: DataFrame) -> DataFrame:
    """Create a table from a query over the given views, replacing it if it exists."""
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {query}")
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_clustered(df: DataFrame, path: str, part_expr: Column, part_name: str, cluster: Sequence[str]) -> None:
    """Partitioned by one expression and sorted by the cluster columns inside each file.

    A selective read prunes directories by the partition, files by their range and row
    groups by the min/max statistics of the sorted columns. Files are cut by sampled
    ranges of (partition, cluster columns, row hash); the hash lets a range end inside a
    value that many rows share.
    """
    tagged = df.withColumn(part_name, part_expr)
    ranges = [F.col(part_name), *[F.col(c) for c in cluster], F.xxhash64(*df.columns)]
    (tagged.repartitionByRange(*ranges).sortWithinPartitions(part_name, *cluster).write.mode("overwrite")
     .partitionBy(part_name).parquet(path))


def z_order(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """A number whose order keeps rows together that are near in all of the columns: the bits of their ranks, interleaved.

    Ranks are places among 2**bits - 1 approximate quantiles of each column, so a skewed column is cut as finely as an even one. Columns are
    numbers or times; NULL has rank 0. The driver holds the quantiles only.
    """
    number = {c: (F.unix_micros(F.col(c).cast("timestamp")) if dict(df.dtypes)[c] in ("date", "timestamp", "timestamp_ntz") else F.col(c)).cast("double") for c in cols}
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    bounds = df.agg(*[F.percentile_approx(n, shares, 10 * 2 ** bits).alias(c) for c, n in number.items()]).first()

    def rank(c: str) -> Column:
        edges = F.array(*[F.lit(float(b)) for b in sorted(set(bounds[c] or []))]).cast("array<double>")
        return F.size(F.filter(edges, lambda edge: edge < number[c])).cast("long")

    def interleaved(ranks: Column) -> Column:
        out = F.lit(0).cast("long")
        for j in range(len(cols)):
            for i in range(bits):
                out = out + F.shiftleft(F.shiftright(ranks[j], i).bitwiseAND(F.lit(1).cast("long")), i * len(cols) + j)
        return out
    return F.transform(F.array(F.array(*[rank(c) for c in cols])), interleaved)[0]  # ranks are found once per row


def write_zordered(df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = 6) -> None:
    """Parquet clustered by several columns at once: a filter on any one of them reads a part of the files.

    Sorting by (a, b) lets a filter on ``a`` skip files and does nothing for ``b``. Here files are sampled ranges of the
    interleaved ranks, so with f files a narrow filter on one of m columns meets about f ** (1 - 1/m) of them by their min/max
    statistics. Equal places are told apart by a row hash, so a hot value spreads over files.
    """
    tagged = df.withColumn("_z", z_order(df, cols, bits))
    (tagged.repartitionByRange(files, F.col("_z"), F.xxhash64(*df.columns)).sortWithinPartitions("_z", *cols).drop("_z")
     .write.mode("overwrite").parquet(path))


def write_jdbc_parallel(df: DataFrame, url: str, table: str, workers: int = 6, batch: int = 10_000,
                        mode: str = "append") -> None:
    """Load a relational table from ``workers`` connections in chunks of ``batch`` rows."""
    (df.repartition(workers).write.format("jdbc").mode(mode)
     .options(url=url, dbtable=table, batchsize=str(batch), numPartitions=str(workers)).save())


def route_by_topic(df: DataFrame, route: Column, path: str) -> None:
    """Write each record under the output its rule names."""
    write_partitioned(df.withColumn("topic", route), path, ["topic"])


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register a table over files that are already there."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.table(name)
