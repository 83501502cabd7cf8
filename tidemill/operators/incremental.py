"""Merges, slowly changing dimensions, range reloads and high-water marks.

A merge is written so that the big side (the target) is joined to the small side (the
batch) only: with a batch below the broadcast threshold the target is never shuffled, and
with a large batch both sides meet in one sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import ordered as O
from tidemill.operators.joins import asof_lookup
from tidemill.operators.relational import top_n_per_group
from tidemill.operators.versioned import VersionedTable
from tidemill.session import hadoop_fs, materialize


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order; the rule is explicit, so re-runs agree."""
    return top_n_per_group(df, keys, order, 1, "_rn").drop("_rn")


def _fresh(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; the target is only probed for the source's keys."""
    matched = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    return source.join(matched, list(keys), "left_anti")


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """A batch with one row per key: the first in the given order, or an error when the job meets a second one."""
    if order:
        return dedup_by_key(source, keys, order)
    rows = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*source.columns)).alias("_row"))
    told = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])
    single = F.assert_true(F.col("_n") == 1, F.concat(F.lit("several source rows for one key: "), told))
    return rows.where(single.isNull()).select("_row.*")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: Mapping[str, Column] | None = None,
                 order: Sequence[Column] | None = None) -> DataFrame:
    """Matched rows are replaced, new ones added; ``stamp`` columns are set on both.

    Of several source rows for a key the first in ``order`` counts; without an order they are an error.
    """
    source = one_per_key(source, keys, order)
    incoming = source.withColumns(dict(stamp or {}))
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming.select(*target.columns))


def differs(cols: Sequence[str], a: str, b: str) -> Column:
    """True when any of the columns differs between two aliases, NULL being a value."""
    return reduce(Column.__or__, [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def merge_when_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str],
                       stamp: Mapping[str, Column], order: Sequence[Column] | None = None) -> DataFrame:
    """Upsert that touches a matched row only if a compared column differs.

    The extra column ``merge_action`` says keep, update or insert. Several source rows for a key: see ``merge_upsert``.
    """
    source = one_per_key(source, keys, order)
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = target.alias("t").join(source.alias("s"), on, "left")
    changed = F.col(f"s.{keys[0]}").isNotNull() & differs(compare, "t", "s")
    cols = []
    for c in target.columns:
        new = stamp.get(c, F.col(f"s.{c}") if c in source.columns else F.col(f"t.{c}"))
        cols.append(F.when(changed, new).otherwise(F.col(f"t.{c}")).alias(c))
    kept = joined.select(*cols, F.when(changed, "update").otherwise("keep").alias("merge_action"))
    new = _fresh(target, source, keys).withColumns(dict(stamp)).withColumn("merge_action", F.lit("insert"))
    return kept.unionByName(new, allowMissingColumns=True)


def merge_soft_delete(target: DataFrame, source: DataFrame, key: str, now: Column, order: Sequence[Column] | None = None) -> DataFrame:
    """Upsert from a full snapshot; target rows it lacks are flagged, returning keys cleared.

    Anti-join semantics: a NULL key in the snapshot does not stop deletions. Several source rows for a key: see ``merge_upsert``.
    """
    source = one_per_key(source, [key], order)
    attrs = [c for c in source.columns if c != key]
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    there = F.col(f"s.{key}").isNotNull()
    already = F.coalesce(F.col("t.is_deleted"), F.lit(False))
    return joined.select(
        F.coalesce(f"s.{key}", f"t.{key}").alias(key),
        *[F.when(there, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in attrs],
        (~there).alias("is_deleted"),
        F.when(there, None).when(already, F.col("t.deleted_ts")).otherwise(now).alias("deleted_ts"))


def insert_new_only(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Source rows whose key the target lacks are added, others left out. Several source rows for a key: see ``merge_upsert``."""
    source = one_per_key(source, keys, order)
    return target.unionByName(_fresh(target, source, keys).select(*target.columns))


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete every target row whose key is in the batch, then add the whole batch."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source.select(*target.columns))


STRATEGIES = {
    "append": lambda target, source, keys: target.unionByName(source.select(*target.columns)),
    "merge": merge_upsert,
    "delete+insert": delete_insert,
}


def apply_strategy(name: str, target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return STRATEGIES[name](target, source, keys)


def replace_time_range(df: DataFrame, path: str, ts: str, start: Column, end: Column, part: str, part_expr: Column) -> None:
    """Replace exactly the rows of [start, end]; running it again changes nothing.

    The partitions that hold such rows, in the table or in the batch, are rebuilt: rows outside the range stay,
    also in a partition at its edge, and a partition left without rows goes. The new content
    is staged first, since a path must not be overwritten while it is read.
    """
    spark = df.sparkSession
    inside = F.col(ts).between(start, end)
    rows = df.where(inside).withColumn(part, part_expr)
    fs, root = hadoop_fs(spark, path)
    if not fs.exists(root):
        rows.hint("rebalance", F.col(part)).write.partitionBy(part).parquet(path)
        return
    table = spark.read.schema(rows.schema).parquet(path)
    touched = table.where(inside).select(part).distinct()
    outside = table.where(~F.coalesce(inside, F.lit(False))).join(touched.unionByName(rows.select(part)).distinct(), part, "left_semi")
    staged = materialize(rows.unionByName(outside.select(*rows.columns)), "range")
    emptied = [r[0] for r in touched.join(staged.select(part).distinct(), part, "left_anti").collect()]  # partition names only
    (staged.hint("rebalance", F.col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in emptied:
        fs.delete(jpath(root, f"{part}={escape(str(value))}"), True)


def full_refresh(model: DataFrame, path: str) -> DataFrame:
    """Rebuild a whole model as a new snapshot."""
    table = VersionedTable(model.sparkSession, path)
    table.write(model)
    return table.read()


scd1 = merge_upsert


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], effective: Column,
               order: Sequence[Column] | None = None) -> DataFrame:
    """Close the open version of changed keys and open a new one; other rows stay.

    ``dim`` has the key, the tracked columns, valid_from, valid_to and is_current. Several snapshot rows for a key: see ``merge_upsert``.
    """
    snapshot = one_per_key(snapshot, [key], order)
    past = dim.where(~F.col("is_current"))
    joined = dim.where("is_current").alias("t").join(snapshot.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    changed = F.col(f"s.{key}").isNotNull() & differs(tracked, "t", "s")
    current = joined.select(
        *[F.col(f"t.{c}") for c in [key, *tracked, "valid_from"]],
        F.when(changed, effective).otherwise(F.col("t.valid_to")).alias("valid_to"), (~changed).alias("is_current"))
    opened = joined.where(changed).select(*[F.col(f"s.{c}") for c in [key, *tracked]])
    new = _fresh(dim.where("is_current"), snapshot, [key]).select(key, *tracked)
    versions = opened.unionByName(new).select(
        key, *tracked, effective.alias("valid_from"), F.lit(None).cast(dim.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"))
    return past.select(*dim.columns).unionByName(current.select(*dim.columns)).unionByName(versions.select(*dim.columns))


def scd2_history(log: DataFrame, key: str, tracked: Sequence[str], ts: str, tie: str, chunk: int | Column | None = None) -> DataFrame:
    """Versions with validity from a change log: equal neighbours fold into one version."""
    held = {f"_p_{c}": c for c in tracked}
    prev = O.previous(log.select(key, *tracked, ts, tie), [key], [ts, tie], {**held, "_p_ts": ts}, chunk)
    moved = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in tracked])
    starts = materialize(prev.where(F.col("_p_ts").isNull() | moved).select(key, *tracked, ts, tie), "versions")
    closed = O.following(starts, [key], ts, tie, {"valid_to": ts}, chunk)
    return closed.select(key, *tracked, F.col(ts).alias("valid_from"), "valid_to",
                         F.col("valid_to").isNull().alias("is_current"))


def scd2_lookup(facts: DataFrame, history: DataFrame, fact_key: str, fact_ts: str, fact_id: str, key: str,
                cols: Sequence[str], chunk: int | Column | None = None) -> DataFrame:
    """Facts with the dimension version in force at their time; ``cols`` are NULL where there is none.

    An as-of lookup on valid_from, then the end of validity is checked: a join on the key
    with a range condition would meet every fact of a key with every version of it.
    """
    held = {**{c: c for c in cols}, "_valid_to": "valid_to"}
    versions = history.select(key, *cols, "valid_from", "valid_to").withColumn("_id", F.lit(0))
    found = asof_lookup(facts, versions, fact_key, fact_ts, "valid_from", held, fact_id, "_id", chunk, key)
    open_ = F.col("_valid_to").isNull() | (F.col(fact_ts) < F.col("_valid_to"))
    return found.select(*facts.columns, *[F.when(open_, F.col(c)).alias(c) for c in cols])


def merge_partitions(path: str, source: DataFrame, keys: Sequence[str], part: str) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the batch falls in.

    A row's partition must follow from its key. The merged partitions are staged in the
    shared folder first, since a path must not be overwritten while it is read.
    """
    spark = source.sparkSession
    target = spark.read.schema(source.schema).parquet(path)
    touched = target.join(source.select(part).distinct(), part, "left_semi")  # prunes directories at run time
    staged = materialize(merge_upsert(touched.select(*source.columns), source, keys), "merged")
    (staged.hint("rebalance", F.col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))


class WatermarkLog:
    """Append-only control table: one row per pipeline run with its high-water marks."""

    DDL = ("pipeline_name string, last_id bigint, last_ts timestamp_ntz, pipeline_start timestamp, "
           "pipeline_end timestamp, source string, target string")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, pipeline: str, last_id, last_ts, started, ended, source: str, target: str) -> None:
        row = [(pipeline, last_id, last_ts, started, ended, source, target)]
        self.spark.createDataFrame(row, self.DDL).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.DDL).parquet(self.path)

    def latest(self, pipeline: str) -> dict[str, object]:
        """The newest mark: the latest time, and the largest id recorded with it."""
        fs, p = hadoop_fs(self.spark, self.path)
        if not fs.exists(p):
            return {}
        row = (self.read().where(F.col("pipeline_name") == pipeline)
               .agg(F.max(F.struct("last_ts", "last_id")).alias("m")).first()["m"])
        return {k: v for k, v in (("max_id", row["last_id"]), ("max_ts", row["last_ts"])) if v is not None} if row else {}


def run_incremental(source: DataFrame, table: VersionedTable, log: WatermarkLog, pipeline: str, id_col: str, ts_col: str,
                    compact_every: int = 20) -> int:
    """Read the mark, pull newer rows, merge them, then record the new mark.

    The first pull becomes a snapshot; later ones are written as deltas of the keyed table,
    so a run costs what it pulls. The mark is written last: a run that dies earlier is
    repeated in full, and since the merge is an upsert by key the repeat changes nothing.
    """
    import datetime as dt

    from tidemill.sources.increments import high_water, read_increment
    started = dt.datetime.now(dt.timezone.utc)
    state = log.latest(pipeline)
    batch = read_increment(source, "timestamp+incrementing", id_col, ts_col, state)
    marks = high_water(batch, id_col, ts_col)
    if not marks:
        return 0
    if table.exists():
        table.upsert(batch)
        if table.deltas() >= compact_every:
            table.compact()
    else:
        table.write(batch)
    log.append(pipeline, marks["max_id"], marks["max_ts"], started, dt.datetime.now(dt.timezone.utc), "source", table.path)
    return 1


def summary_delta(batch: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Partial sums of one batch."""
    return batch.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def summary_merge(saved: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Saved partial sums plus a batch's: only the summary is read again, not the history."""
    return saved.unionByName(delta).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums])
