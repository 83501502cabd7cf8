"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job assumes. AQE merges small shuffle partitions and splits skewed ones at
# run time; it starts from ``spark.sql.shuffle.partitions``, to be set for the largest input
# (about one per 128 MB shuffled).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    STATE_STORE: ROCKSDB,
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session is set to; the setting is put back.

    ``transformWithStateInPandas`` (panes, live sessions) has several states and timers per key, which Spark's default store
    refuses. A stream takes its store when it starts, and a checkpoint keeps the one it was made with.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would be lost
    with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-"))
    return sc.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "tidemill", spark.sparkContext.applicationId)


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return os.path.join(_own_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged. Call it last: results may still read from there."""
    fs, path = hadoop_fs(spark, _own_folder(spark))
    fs.delete(path, True)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path object) pair for a path on any Hadoop-compatible store."""
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def materialize(df, label: str):
    """Write a table to the shared folder and read it back.

    For a result that several later steps read: it is computed once, and a lost executor
    costs a re-read instead of the whole lineage.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
