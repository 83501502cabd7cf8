"""Named queries over the driver's tables, each with an SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to one scale factor's tables: ``t.orders``, ``t.events`` ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return session.scratch(self.spark, label)


def _plain_timestamps(df: DataFrame) -> DataFrame:
    """Zoned timestamps become zone-less ones (UTC wall clock), as the tables have them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain_timestamps(fn(Tables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
