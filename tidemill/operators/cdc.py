"""Change-data envelopes: parse, validate, route, fold and compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.relational import top_n_per_group

OPS = ("c", "u", "d", "r")
SOURCE_DDL = "struct<db:string,table:string,ts_ms:bigint,snapshot:string>"


def envelope_ddl(row_ddl: str) -> str:
    """Schema of an envelope whose rows look like ``row_ddl``, wrapped in payload or bare."""
    bare = f"before:struct<{row_ddl}>,after:struct<{row_ddl}>,source:{SOURCE_DDL},op:string,ts_ms:bigint"
    return f"struct<payload:struct<{bare}>,{bare}>"


def parse_envelope(df: DataFrame, row_ddl: str, value: str = "value") -> DataFrame:
    """Envelope JSON, with or without the payload wrapper, to columns; other columns stay.

    A NULL value is a tombstone.
    """
    parsed = df.withColumn("_e", F.from_json(value, envelope_ddl(row_ddl)))
    fields = ["before", "after", "source", "op", "ts_ms"]
    return parsed.select(*df.columns, F.col(value).isNull().alias("tombstone"),
                         *[F.coalesce(f"_e.payload.{f}", f"_e.{f}").alias(f) for f in fields])


def unwrap_new_record(parsed: DataFrame, row_fields: Sequence[str], deletes: str = "rewrite") -> DataFrame:
    """Flat new rows with op, table and time; deletes kept as their last row and flagged, or dropped."""
    rows = parsed.where(~F.col("tombstone"))
    if deletes == "drop":
        rows = rows.where("op != 'd'")
    return rows.select(*[F.coalesce(f"after.{f}", f"before.{f}").alias(f) for f in row_fields],
                       "op", F.col("source.table").alias("table"), "ts_ms", (F.col("op") == "d").alias("deleted"))


def filter_ops(parsed: DataFrame, ops: Sequence[str] | None = None, tables: Sequence[str] | None = None) -> DataFrame:
    out = parsed
    if ops:
        out = out.where(F.col("op").isin(*ops))
    if tables:
        out = out.where(F.col("source.table").isin(*tables))
    return out


def route_events(parsed: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str) -> DataFrame:
    """Add ``handler``: the name of the first rule (name, condition) that holds for a record, else ``otherwise``."""
    name = F.lit(otherwise)
    for handler, condition in reversed(rules):
        name = F.when(condition, F.lit(handler)).otherwise(name)
    return parsed.withColumn("handler", name)


def route_by_config(parsed: DataFrame, rules: Sequence[Mapping[str, str]], default: str = "default") -> DataFrame:
    """Routing rules as data: op, table and an SQL condition are all optional; first match wins."""
    handler = F.when(F.lit(False), F.lit(default))
    for rule in rules:
        test = F.lit(True)
        if "op" in rule:
            test = test & (F.col("op") == rule["op"])
        if "table" in rule:
            test = test & (F.col("source.table") == rule["table"])
        if "condition" in rule:
            test = test & F.coalesce(F.expr(rule["condition"]), F.lit(False))
        handler = handler.when(test, F.lit(rule["handler"]))
    return parsed.withColumn("handler", handler.otherwise(F.lit(default)))


def diff_before_after(parsed: DataFrame, fields: Sequence[str], exclude: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Changed (field, old, new) triples of every update, values as text."""
    def triple(f: str) -> Column:
        old, new = F.col(f"before.{f}"), F.col(f"after.{f}")
        return F.when(~old.eqNullSafe(new), F.struct(F.lit(f).alias("field"), old.cast("string").alias("old"),
                                                     new.cast("string").alias("new")))
    changes = F.filter(F.array(*[triple(f) for f in fields if f not in exclude]), lambda x: x.isNotNull())
    return parsed.where("op = 'u'").withColumn("changes", changes)


def apply_changelog(parsed: DataFrame, key: str, order: Sequence[str], row_fields: Sequence[str]) -> DataFrame:
    """Fold the log to current rows: the newest record of each key, unless it deletes.

    A tombstone sorts after its delete and removes the key as well. Partitions keep one
    record per key before the shuffle, so a key changed very often costs no more.
    """
    newest = top_n_per_group(parsed, [key], [F.col(o).desc() for o in order], 1, "_rn")
    return (newest.where(~F.col("tombstone") & (F.col("op") != "d"))
            .select(*[F.col(f"after.{f}").alias(f) for f in row_fields]))


def signed_rows(parsed: DataFrame, row_fields: Sequence[str]) -> DataFrame:
    """Every change as plus the new row and minus the old one.

    Sums over ``sign`` give aggregates that retract, with no fold per key.
    """
    live = parsed.where(~F.col("tombstone"))
    plus = F.when(F.col("op").isin("c", "r", "u") & F.col("after").isNotNull(),
                  F.struct(F.lit(1).alias("sign"), *[F.col(f"after.{f}").alias(f) for f in row_fields]))
    minus = F.when(F.col("op").isin("u", "d") & F.col("before").isNotNull(),
                   F.struct(F.lit(-1).alias("sign"), *[F.col(f"before.{f}").alias(f) for f in row_fields]))
    return live.select(F.explode(F.filter(F.array(plus, minus), lambda x: x.isNotNull())).alias("r")).select("r.*")


# Which row image an operation must carry: (operations, image, checked only when strict).
REQUIRED_IMAGES = ((("c", "r"), "after", False), (("d",), "before", False), (("u",), "after", True))


def validate_envelope(df: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Add ``error_reason``, a code: NULL for a valid record or a tombstone.

    ``not_json``; ``no_operation``; ``unknown_operation:<op>``; ``no_<image>_row:<op>`` where the operation must carry that
    image. ``strict`` also asks updates for their new row.
    """
    def at(name: str) -> Column:
        return F.coalesce(*[F.get_json_object(value, f"$.{prefix}{name}") for prefix in ("payload.", "")])

    op = at("op")
    tests = [("not_json", F.try_parse_json(value).isNull()), ("no_operation", op.isNull()),
             (F.concat(F.lit("unknown_operation:"), op), ~op.isin(*OPS))]
    tests += [(F.concat(F.lit(f"no_{image}_row:"), op), op.isin(*ops) & at(image).isNull())
              for ops, image, only_strict in REQUIRED_IMAGES if strict or not only_strict]
    found = F.coalesce(*[F.when(failed, code if isinstance(code, Column) else F.lit(code)) for code, failed in tests])
    return df.withColumn("error_reason", F.when(F.col(value).isNotNull(), found))


def dead_letters(checked: DataFrame, origin: Mapping[str, str]) -> DataFrame:
    """Rejected records with their reason and where they came from (header name -> column)."""
    return checked.where(F.col("error_reason").isNotNull()).select(
        "key", "value", "error_reason", *[F.col(c).alias(f"original_{h}") for h, c in origin.items()])


def event_stats(parsed: DataFrame) -> DataFrame:
    """Counts per table and operation, tombstones and total."""
    return parsed.groupBy(F.coalesce("source.table", F.lit("?")).alias("table")).agg(
        *[F.count_if((F.col("op") == o) & ~F.col("tombstone")).alias(f"n_{o}") for o in OPS],
        F.count_if("tombstone").alias("tombstones"), F.count("*").alias("total"))


def schema_changes(df: DataFrame, table: str, order: Sequence[str], row_json: str, chunk: int | Column | None = None) -> DataFrame:
    """Columns added and removed between a table's consecutive records."""
    from tidemill.operators.ordered import previous
    keyed = df.withColumn("_cols", F.array_sort(F.json_object_keys(row_json)))
    prev = previous(keyed, [table], order, {"_before": "_cols"}, chunk)
    out = prev.where(F.col("_before").isNotNull()).select(
        *df.columns, F.array_except("_cols", "_before").alias("added"), F.array_except("_before", "_cols").alias("removed"))
    return out.where((F.size("added") > 0) | (F.size("removed") > 0))


LABELS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}


def describe_change(parsed: DataFrame, fields: Sequence[str], id_field: str, title: Mapping[str, Column]) -> DataFrame:
    """A readable audit line per change; ``title`` says per table how a row is shown."""
    op, table = F.col("op"), F.col("source.table")
    label = reduce(lambda acc, kv: acc.when(op == kv[0], kv[1]), LABELS.items(), F.when(F.lit(False), "")).otherwise(
        F.concat(F.lit("UNKNOWN("), op, F.lit(")")))
    row_id = F.coalesce(f"after.{id_field}", f"before.{id_field}").cast("string")
    shown = reduce(lambda acc, kv: acc.when(table == kv[0], kv[1]), title.items(), F.when(F.lit(False), "")).otherwise("")
    parts = [F.when(~F.col(f"before.{f}").eqNullSafe(F.col(f"after.{f}")), F.concat(
        F.lit(f"{f}: "), F.coalesce(F.col(f"before.{f}").cast("string"), F.lit("NULL")), F.lit(" -> "),
        F.coalesce(F.col(f"after.{f}").cast("string"), F.lit("NULL")))) for f in fields]
    changes = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), ", ")
    line = (F.when(op.isin("c", "r"), F.concat(label, F.lit(" into "), table, F.lit(": #"), row_id, F.lit(" "), shown))
            .when(op == "u", F.concat(label, F.lit(" "), table, F.lit(" #"), row_id, F.lit(": "), changes))
            .when(op == "d", F.concat(label, F.lit(" from "), table, F.lit(": #"), row_id, F.lit(" "), shown))
            .otherwise(F.concat(label, F.lit(" "), table, F.lit(" #"), row_id)))
    return parsed.where(~F.col("tombstone")).withColumn("line", line)


def compare_replica(src: DataFrame, dst: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Rows missing from, extra in, or different in the replica, with the differing fields."""
    joined = src.alias("a").join(dst.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    wrong = F.filter(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]),
                     lambda x: x.isNotNull())
    state = (F.when(F.col(f"b.{key}").isNull(), "missing").when(F.col(f"a.{key}").isNull(), "extra")
             .when(F.size(wrong) > 0, "mismatch"))
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), state.alias("state"),
                         F.when(state == "mismatch", F.array_join(wrong, ",")).alias("fields")).where("state IS NOT NULL")


def snapshot_vs_stream(parsed: DataFrame) -> DataFrame:
    """Records of the initial snapshot and live changes, counted per table."""
    initial = (F.col("op") == "r") | F.coalesce(F.col("source.snapshot").isin("true", "first", "last"), F.lit(False))
    kind = F.when(initial, "snapshot").otherwise("stream")
    return (parsed.where(~F.col("tombstone")).groupBy(F.col("source.table").alias("table"), kind.alias("phase"))
            .agg(F.count("*").alias("n")))


# The order states that may follow each other.
TRANSITIONS = (
    ("pending", "confirmed"), ("pending", "cancelled"), ("confirmed", "shipped"), ("confirmed", "cancelled"),
    ("shipped", "delivered"), ("delivered", "returned"),
)


def status_history(df: DataFrame, key: str, order: Sequence[str], status: str,
                   allowed: Sequence[tuple[str, str]] = TRANSITIONS, chunk: int | Column | None = None) -> DataFrame:
    """Status changes in order, with the seconds spent in the state before and a legality flag."""
    from tidemill.operators.ordered import micros, previous
    prev = previous(df, [key], order, {"from_status": status, "_since": order[0]}, chunk)
    moves = prev.where(F.col("from_status").isNotNull() & (F.col("from_status") != F.col(status)))
    legal = F.concat("from_status", F.lit(">"), status).isin(*[f"{a}>{b}" for a, b in allowed])
    dwell = (micros(order[0]) - micros("_since")) / F.lit(1_000_000.0)
    return moves.withColumn("dwell_s", dwell).withColumn("legal", legal).drop("_since")


def merge_replicas_lww(copies: Sequence[tuple[str, DataFrame]], key: str, ts: str, fields: Sequence[str],
                       field_level: bool = False) -> DataFrame:
    """One row per key from several regions, the last writer winning.

    Row level takes the newest whole row; field level takes, per field, the newest copy in
    which that field is set, by its own time column ``<field>_ts``. A tie goes to the
    region that sorts last. ``lost`` counts the copies or field writes that were overruled
    by a different value.
    """
    rows = reduce(lambda a, b: a.unionByName(b), [df.withColumn("_region", F.lit(name)) for name, df in copies])
    if field_level:
        def pick(f):
            return F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(f"{f}_ts", "_region"))).alias(f)
        lost = reduce(Column.__add__, [(F.countDistinct(f) - 1) * F.when(F.count(f) > 0, 1).otherwise(0) for f in fields])
        return rows.groupBy(key).agg(*[pick(f) for f in fields], lost.alias("lost"))
    won = F.max_by(F.struct("_region", *fields), F.struct(ts, "_region")).alias("w")
    out = rows.groupBy(key).agg(won, F.countDistinct(F.struct(*fields)).alias("_variants"))
    return out.select(key, F.col("w._region").alias("region"), *[F.col(f"w.{f}").alias(f) for f in fields],
                      (F.col("_variants") - 1).alias("lost"))


# Event type prefixes and where their events may go.
GLOBAL_PREFIXES = ("account.", "billing.", "subscription.", "product.", "pricing.")
LOCAL_PREFIXES = ("clickstream.", "session.", "search.", "log.", "eu_user.")


def classify_replication(df: DataFrame, event_type: str, global_: Sequence[str] = GLOBAL_PREFIXES,
                         local: Sequence[str] = LOCAL_PREFIXES) -> DataFrame:
    """``global`` events go to every region, ``local`` ones stay; unknown types stay too."""
    def starts(prefixes):
        return reduce(Column.__or__, [F.col(event_type).startswith(p) for p in prefixes])
    return df.withColumn("scope", F.when(starts(local), "local").when(starts(global_), "global").otherwise("local"))


def regional_rollup(df: DataFrame, region: str, **sums: Column) -> DataFrame:
    """Per-region sums and one row for all regions, from a single pass over the events."""
    per = df.groupBy(region).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    whole = per.agg(*[F.sum(n).alias(n) for n in sums]).withColumn(region, F.lit("ALL"))
    return per.unionByName(whole)
