"""Stream sinks that give the same result when a batch is run twice."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.cdc import signed_rows
from tidemill.operators.relational import top_n_per_group
from tidemill.operators.summaries import RetractableSummary
from tidemill.operators.versioned import VersionedTable
from tidemill.session import hadoop_fs


def _until_done(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append_stream(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append-only files; the sink's own log makes each batch count once."""
    _until_done(df.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", path))


def each_batch(df: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process, then commit: the offsets of a batch are recorded after ``work`` returns."""
    _until_done(df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(work))


def query_id(df: DataFrame, checkpoint: str) -> str:
    """The identity that a checkpoint gives its query: batch numbers are unique only together with it."""
    row = df.sparkSession.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()
    return row[0].replace("-", "")


def append_batches(df: DataFrame, path: str, checkpoint: str) -> None:
    """One directory per query and batch, overwritten if the batch is repeated."""
    each_batch(df, checkpoint, lambda batch, n: batch.write.mode("overwrite").parquet(
        f"{path}/query_id={query_id(batch, checkpoint)}/batch_id={n}"))


def _upsert_once(table: VersionedTable, batch: DataFrame, tag: str, compact_every: int) -> None:
    """Add a batch as a delta unless the table already has it; fold many deltas to a snapshot."""
    if table.has_tag(tag):
        return
    table.upsert(batch, tag)
    if table.deltas() >= compact_every:
        table.compact()


def upsert_stream(df: DataFrame, table: VersionedTable, checkpoint: str, mode: str = "update", compact_every: int = 20,
                  order: Sequence[str] | None = None) -> None:
    """Keyed upsert: the newest value per key wins.

    A batch writes only its own rows, as a delta; after ``compact_every`` of them the table
    is folded to a new snapshot. A batch that is already in the table is skipped. Within a batch
    the row that is last in ``order`` wins; a stream that sends a key more than once in a batch, as one in
    append mode does, needs it.
    """
    def work(batch: DataFrame, n: int) -> None:
        if order:
            batch = top_n_per_group(batch, table.keys, [F.col(o).desc() for o in order], 1, "_rn").drop("_rn")
        _upsert_once(table, batch, f"{query_id(batch, checkpoint)}b{n}", compact_every)

    if mode == "append" and not order:
        raise ValueError("an append-mode stream may send a key twice in a batch: name the order that decides")
    each_batch(df, checkpoint, work, mode)


def changelog_stream(parsed: DataFrame, table: VersionedTable, order: Sequence[str], row_fields: Sequence[str],
                     checkpoint: str, compact_every: int = 20) -> None:
    """Fold a stream of change records into a keyed table (read it with ``live_rows``).

    Each batch folds to its newest record per key and is upserted; a delete or tombstone
    leaves a row marked ``deleted``. A key's records must arrive in order over the batches,
    as a log partitioned by key gives them.
    """
    def work(batch: DataFrame, n: int) -> None:
        newest = top_n_per_group(batch, table.keys, [F.col(o).desc() for o in order], 1, "_rn")
        rows = newest.select(*table.keys, *[F.col(f"after.{f}").alias(f) for f in row_fields],
                             (F.col("tombstone") | F.coalesce(F.col("op") == "d", F.lit(False))).alias("deleted"))
        _upsert_once(table, rows, f"{query_id(batch, checkpoint)}b{n}", compact_every)
    each_batch(parsed, checkpoint, work)


def retract_stream(parsed: DataFrame, summary: RetractableSummary, row_fields: Sequence[str], checkpoint: str,
                   shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Aggregates that retract, kept from a stream of change records: each batch is taken in as signed rows, once.

    A change adds its new row and takes away its old one, so it may also move a row to another group. An update or delete
    must carry the old row; one without is an error, as nothing could be taken away. ``shape`` adds columns to group by.
    """
    image = F.assert_true(~F.coalesce(F.col("op").isin("u", "d"), F.lit(False)) | F.col("tombstone") | F.col("before").isNotNull(),
                          F.lit("an update or delete without its old row"))

    def work(batch: DataFrame, n: int) -> None:
        signed = signed_rows(batch.where(image.isNull()), row_fields)
        summary.apply(shape(signed) if shape else signed, f"{query_id(batch, checkpoint)}b{n}")
    each_batch(parsed, checkpoint, work)


def live_rows(table: VersionedTable) -> DataFrame:
    return table.read().where("NOT deleted").drop("deleted")


def replace_stream(df: DataFrame, table: VersionedTable, checkpoint: str) -> None:
    """Complete mode: every batch is the whole result."""
    def work(batch: DataFrame, n: int) -> None:
        tag = f"{query_id(batch, checkpoint)}b{n}"
        if not table.has_tag(tag):
            table.write(batch, tag)
    each_batch(df, checkpoint, work, "complete")


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str) -> None:
    """One source, several outputs in one query; the batch is read once.

    Each output keeps one directory per query and batch. Aggregates written here are partial and are
    folded again by their reader.
    """
    def work(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            for name, shape in sinks.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/{name}/query_id={query_id(batch, checkpoint)}/batch_id={n}")
        finally:
            batch.unpersist()
    each_batch(df, checkpoint, work)


def split_late_stream(df: DataFrame, ts: str, delay: int, path: str, checkpoint: str) -> None:
    """Rows behind the mark of the batches before go to ``late``, the others to ``on_time``.

    The mark (newest time seen minus the delay) is kept next to the output, one small row
    per batch, so a repeated batch meets the mark it met before.
    """
    spark = df.sparkSession
    marks = f"{path}/marks"

    def work(batch: DataFrame, n: int) -> None:
        own = f"query_id={query_id(batch, checkpoint)}"
        fs, p = hadoop_fs(spark, f"{marks}/{own}")
        mark = None
        if fs.exists(p):
            mark = (spark.read.schema("newest timestamp, batch_id int").parquet(f"{marks}/{own}")
                    .where(F.col("batch_id") < n).agg(F.max("newest")).first()[0])
        late = F.lit(False) if mark is None else F.col(ts) < F.lit(mark) - F.expr(f"INTERVAL {delay} SECONDS")
        batch.persist()
        try:
            batch.where(late).write.mode("overwrite").parquet(f"{path}/late/{own}/batch_id={n}")
            batch.where(~late).write.mode("overwrite").parquet(f"{path}/on_time/{own}/batch_id={n}")
            batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{marks}/{own}/batch_id={n}")
        finally:
            batch.unpersist()
    each_batch(df, checkpoint, work)
