"""Data-quality checks: row checks with quarantine, table metrics, column tests, history.

A row check is a name, a criticality and a failure column (true = the row fails). Unless
the check is about NULL itself, NULL passes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.exact import exact_avg, exact_stddev


@dataclass(frozen=True)
class Check:
    name: str
    fails: Column
    criticality: str = "error"


def _quiet(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


# Each check function gives the condition under which a row fails the check of its name.

def is_not_null(col: str) -> Column:
    """Fails where the value is NULL."""
    return F.col(col).isNull()


def is_not_null_and_not_empty(col: str) -> Column:
    return F.col(col).isNull() | _quiet(F.btrim(F.col(col).cast("string")) == "")


def is_in_range(col: str, lo, hi) -> Column:
    return _quiet(~F.col(col).between(F.lit(lo), F.lit(hi)))


def is_valid_date(col: str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.col(col).isNotNull() & F.try_to_timestamp(F.col(col), F.lit(fmt)).isNull()


def is_in_list(col: str, allowed: Sequence) -> Column:
    return _quiet(~F.col(col).isin(*allowed))


def sql_expression(expr: str) -> Column:
    """Fails where the expression, which should hold, is false."""
    return _quiet(~F.expr(expr))


def matches(col: str, pattern: str) -> Column:
    return _quiet(~F.col(col).rlike(pattern))


FUNCTIONS: dict[str, Callable[..., Column]] = {
    f.__name__: f for f in (is_not_null, is_not_null_and_not_empty, is_in_range, is_valid_date, is_in_list,
                            sql_expression, matches)}


def register_check(name: str, fn: Callable[..., Column]) -> None:
    """Add a user's own check to those that metadata can name."""
    FUNCTIONS[name] = fn


def checks_from_metadata(items: Sequence[Mapping]) -> list[Check]:
    """Checks from plain data: name, criticality, function and its arguments."""
    return [Check(i["name"], FUNCTIONS[i["function"]](**i.get("arguments", {})), i.get("criticality", "error"))
            for i in items]


def _failed(checks: Sequence[Check], level: str) -> Column:
    hits = [F.when(c.fails, F.lit(c.name)) for c in checks if c.criticality == level]
    if not hits:
        return F.array().cast("array<string>")
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def apply_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add ``_errors`` and ``_warnings``: names of the checks a row fails. One pass, no shuffle."""
    return df.withColumns({"_errors": _failed(checks, "error"), "_warnings": _failed(checks, "warn")})


def get_valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_errors") == 0).drop("_errors", "_warnings")


def get_invalid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_errors") > 0)


def split(df: DataFrame, checks: Sequence[Check] | Sequence[Mapping]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their failures)."""
    if checks and not isinstance(checks[0], Check):
        checks = checks_from_metadata(checks)
    checked = apply_checks(df, checks)
    return get_valid(checked), get_invalid(checked)


def failure_summary(checked: DataFrame) -> DataFrame:
    failed = checked.select(F.explode(F.concat("_errors", "_warnings")).alias("check_name"))
    return failed.groupBy("check_name").agg(F.count("*").alias("failed_rows"))


class QualityError(ValueError):
    pass


def validate_or_raise(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows themselves, or an error that says how many rows fail each check.

    One aggregate over the table; its result is a single row.
    """
    row = df.agg(*[F.count_if(c.fails).alias(c.name) for c in checks]).first()
    bad = {c.name: row[c.name] for c in checks if row[c.name] and c.criticality == "error"}
    if bad:
        raise QualityError(f"rows failing checks: {bad}")
    return df


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True, scale: int | None = None) -> DataFrame:
    """Per column: count, nulls, distinct values, min, max, mean and deviation.

    Counts and sums of all columns come from one pass. Exact distinct values are counted
    from one unpivoted (column, value) list, which shuffles every different value; with
    ``exact=False`` a sketch counts them in the one pass. Numbers are taken as they are; ``scale`` sums
    them as DECIMALs of so many digits, which suits money.
    """
    cols = list(cols or df.columns)
    numeric = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, T.NumericType)]
    def mean(c):
        return F.avg(c) if scale is None else exact_avg(c, scale)

    def spread(c):
        return F.stddev_samp(c) if scale is None else exact_stddev(c, scale)
    stats = [x for c in cols for x in (
        F.count("*").alias(f"n|{c}"), F.count_if(F.col(c).isNull()).alias(f"z|{c}"),
        F.min(c).cast("string").alias(f"lo|{c}"), F.max(c).cast("string").alias(f"hi|{c}"),
        (mean(c) if c in numeric else F.lit(None)).cast("double").alias(f"s|{c}"),
        (spread(c) if c in numeric else F.lit(None)).cast("double").alias(f"q|{c}"),
        (F.lit(None).cast("long") if exact else F.approx_count_distinct(c)).alias(f"d|{c}"))]
    wide = df.agg(*stats)
    per = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), *[F.col(f"`{k}|{c}`").alias(k) for k in ("n", "z", "lo", "hi", "s", "q", "d")])
        for c in cols])).alias("p")
    rows = wide.select(per).select("p.*")
    if exact:
        rows = rows.drop("d").join(F.broadcast(_distinct_values(df, cols)), "column_name", "left")  # one row per column
    return rows.select(
        "column_name", F.col("n").alias("row_count"), F.col("z").alias("null_count"),
        F.coalesce("d", F.lit(0)).alias("distinct_count"), F.col("lo").alias("min_value"),
        F.col("hi").alias("max_value"), F.col("s").alias("mean"), F.col("q").alias("stddev"))


def _distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _text(c).alias("v")) for c in cols])
                                ).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
    return pairs.groupBy("column_name").agg(F.count("*").alias("d"))


def suggest_rules(profiled: DataFrame, few: int = 10) -> DataFrame:
    """Candidate checks from a profile: never null, few values, numeric range."""
    rules = F.filter(F.array(
        F.when(F.col("null_count") == 0, F.struct(F.lit("is_not_null").alias("function"), F.lit("").alias("arguments"))),
        F.when(F.col("distinct_count") <= few, F.struct(F.lit("is_in_list").alias("function"),
                                                       F.col("distinct_count").cast("string").alias("arguments"))),
        F.when(F.col("mean").isNotNull(), F.struct(F.lit("is_in_range").alias("function"), F.concat(
            "min_value", F.lit(".."), "max_value").alias("arguments")))), lambda r: r.isNotNull())
    return profiled.select("column_name", F.explode(rules).alias("r")).select("column_name", "r.function", "r.arguments")


OPS = {"=": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def duplicate_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def metric_checks(df: DataFrame, checks: Sequence[tuple[str, str, str | None, str, float]]) -> DataFrame:
    """Table metrics against thresholds: (name, metric, column, operator, threshold) per check.

    Metrics are row_count, missing_count and duplicate_count. The first two share one pass.
    """
    simple = {n: (F.count("*") if m == "row_count" else F.count_if(F.col(c).isNull()))
              for n, m, c, _, _ in checks if m != "duplicate_count"}
    values = df.agg(*[c.alias(n) for n, c in simple.items()], F.lit(0).alias("_one"))
    for n, m, c, _, _ in checks:
        if m == "duplicate_count":
            repeated = duplicate_groups(df.where(F.col(c).isNotNull()), [c]).agg(F.count("*").alias("n"))
            values = values.withColumn(n, repeated.scalar())
    rows = [F.struct(F.lit(n).alias("check_name"), F.lit(m).alias("metric"), F.col(n).cast("bigint").alias("value"),
                     F.lit(float(limit)).alias("threshold"),
                     F.when(OPS[op](F.col(n), F.lit(limit)), "pass").otherwise("fail").alias("status"))
            for n, m, c, op, limit in checks]
    return values.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def custom_metric(spark: SparkSession, name: str, sql: str, op: str, threshold: float, **views: DataFrame) -> DataFrame:
    """A user's SQL that gives one number, compared with a threshold."""
    value = spark.sql(sql, **views).toDF("value").select(F.col("value").cast("bigint").alias("value"))
    return value.select(F.lit(name).alias("check_name"), "value",
                        F.when(OPS[op](F.col("value"), F.lit(threshold)), "pass").otherwise("fail").alias("status"))


def references(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose non-null value does not exist in the other table."""
    return df.where(F.col(col).isNotNull()).join(ref.select(F.col(ref_col).alias("_r")), F.col(col) == F.col("_r"), "left_anti")


def schema_check(df: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """Required columns and types against a table, with the non-null rows of each.

    The schema is compared before any row is read; the counts come from one pass.
    """
    have = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in required if c in have], F.lit(0).alias("_none"))
    rows = []
    for c, want in required.items():
        state = "missing" if c not in have else "ok" if have[c] == want else "wrong_type"
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(want).alias("expected"),
                             F.lit(have.get(c)).cast("string").alias("actual"), F.lit(state).alias("state"),
                             (F.col(c) if c in have else F.lit(None)).cast("bigint").alias("non_null")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def failed_row_sample(df: DataFrame, check: Check, order: Sequence[Column], n: int) -> DataFrame:
    """The n first failing rows in a stated order."""
    return df.where(check.fails).orderBy(*order).limit(n)


def test_unique(df: DataFrame, col: str) -> DataFrame:
    return duplicate_groups(df.where(F.col(col).isNotNull()), [col])


def test_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def test_accepted_values(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Values outside the accepted ones, with their count."""
    return df.groupBy(col).agg(F.count("*").alias("n")).where(~F.col(col).isin(*allowed))


for _t in (test_unique, test_not_null, test_accepted_values):
    _t.__test__ = False  # column tests, not pytest ones


def singular_test(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """SQL that returns bad rows; an empty result is a pass."""
    return spark.sql(sql, **views)


def audit(spark: SparkSession, sql: str, **views: DataFrame) -> None:
    """Raise if the audit SQL returns any row."""
    if spark.sql(sql, **views).limit(1).count():
        raise QualityError(f"audit returned rows: {sql}")


def record_results(results: DataFrame, path: str, run: str) -> None:
    """Append check results (check_name, status, value) of one run to the history."""
    results.select("check_name", "status", F.col("value").cast("bigint").alias("value"), F.lit(run).alias("run"),
                   F.current_timestamp().alias("recorded_at")).write.mode("append").parquet(path)


def latest_results(history: DataFrame) -> DataFrame:
    """Newest status per check, with the number of runs and failures."""
    return history.groupBy("check_name").agg(
        F.max_by(F.struct("status", "value", "run"), F.col("run")).alias("l"), F.count("*").alias("runs"),
        F.count_if(F.col("status") == "fail").alias("failures")
    ).select("check_name", "l.status", "l.value", "l.run", "runs", "failures")


def required_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Add ``reason``: the first required field that is absent or empty."""
    reason = F
    for f in fields:
        reason = reason.when(F.col(f).isNull(), F.lit(f"missing field: {f}"))
        reason = reason.when(F.btrim(F.col(f).cast("string")) == "", F.lit(f"empty field: {f}"))
    return df.withColumn("reason", reason.otherwise(F.lit(None).cast("string")))


def dead_letters(checked: DataFrame, keep: Sequence[str], retries: int = 0) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select(*keep, "reason", F.lit(retries).alias("retry_count"))


# The text formats a schema rule may name.
FORMATS = {
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "date-time": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$",
}


def json_schema_rules(rules: Mapping) -> list[Check]:
    """Row checks from a JSON-schema-like rule set over parsed (struct) columns.

    Understands required, enum, minimum, format and nested properties.
    """
    def walk(node: Mapping, path: str):
        for name in node.get("required", ()):
            p = f"{path}{name}"
            yield Check(f"required:{p}", F.col(p).isNull())
        for name, rule in node.get("properties", {}).items():
            p = f"{path}{name}"
            if "enum" in rule:
                yield Check(f"enum:{p}", is_in_list(p, rule["enum"]))
            if "minimum" in rule:
                yield Check(f"minimum:{p}", _quiet(F.col(p) < F.lit(rule["minimum"])))
            if "format" in rule:
                yield Check(f"format:{p}", matches(p, FORMATS[rule["format"]]))
            if rule.get("type") == "object":
                yield from walk(rule, f"{p}.")
    return list(walk(rules, ""))


def schema_drift(old: T.StructType, new: T.StructType, mode: str) -> list[tuple[str, str, bool]]:
    """(column, change, allowed) per difference.

    backward: the new schema reads old data, so an added column must be nullable.
    forward: the old schema reads new data, so a removed column must have been nullable.
    full: both. A changed type is never allowed, except widening where old data is read.
    """
    if mode not in ("backward", "forward", "full"):
        raise ValueError("mode must be backward, forward or full")
    a, b = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    wider = {("int", "bigint"), ("float", "double"), ("int", "double")}
    out = []
    for name in sorted({*a, *b}):
        if name not in a:
            out.append((name, "added", mode == "forward" or b[name].nullable))
        elif name not in b:
            out.append((name, "removed", mode == "backward" or a[name].nullable))
        elif a[name].dataType != b[name].dataType:
            pair = (a[name].dataType.simpleString(), b[name].dataType.simpleString())
            out.append((name, f"type {pair[0]}->{pair[1]}", mode == "backward" and pair in wider))
    return out


def schema_drift_gate(df: DataFrame, expected: T.StructType, mode: str = "backward") -> DataFrame:
    """Differences of a batch's schema from the expected one, whether each may load, and the
    number of rows that carry the column."""
    changes = schema_drift(expected, df.schema, mode)
    have = set(df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(n).alias(n) for n, _, _ in changes if n in have])
    rows = [F.struct(F.lit(n).alias("column_name"), F.lit(c).alias("change"), F.lit(ok).alias("allowed"),
                     (F.col(n) if n in have else F.lit(0)).cast("bigint").alias("rows_with_value")) for n, c, ok in changes]
    if not rows:
        return counts.select(F.lit("").alias("column_name"), F.lit("none").alias("change"), F.lit(True).alias("allowed"),
                             F.col("_rows").alias("rows_with_value"))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
