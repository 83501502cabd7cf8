"""Data-quality checks on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.bindings.registry import query
from tidemill.operators import sketches as SK
from tidemill.operators import quality as Q

c = F.col


def dirty_events(t):
    """Events with holes: no user for signups of low value, text dates, odd types."""
    v, kind = c("value"), c("event_type")
    return t.events.select(
        "event_id", F.when((kind == "signup") & (v < 20), None).otherwise(c("user_id")).alias("user_id"),
        F.when(kind == "view", F.when(v < 10, " ").otherwise(c("props"))).otherwise(c("props")).alias("props"),
        F.when(v < 5, None).otherwise(v).alias("value"),
        F.when(kind == "error", F.concat(F.lit("2024-14-"), F.date_format("ts", "dd"))).otherwise(
            F.date_format("ts", "yyyy-MM-dd")).alias("on_day"), "event_type")


DIRTY = """d AS (SELECT event_id, event_type, CASE WHEN event_type = 'signup' AND value < 20 THEN NULL ELSE user_id END AS user_id,
 CASE WHEN event_type = 'view' AND value < 10 THEN ' ' ELSE props END AS props, CASE WHEN value < 5 THEN NULL ELSE value END AS value,
 event_type = 'error' AS bad_day FROM events)"""


@query("dq_01_is_not_null", f"""
WITH {DIRTY} SELECT event_id, user_id IS NULL AS no_user, trim(props) = '' AS no_props FROM d""")
def _(t):
    return dirty_events(t).select("event_id", Q.is_not_null("user_id").alias("no_user"), Q.is_not_null_and_not_empty("props").alias("no_props"))


@query("dq_02_is_in_range", f"WITH {DIRTY} SELECT event_id FROM d WHERE value < 10 OR value > 100")
def _(t):
    return dirty_events(t).where(Q.is_in_range("value", 10, 100)).select("event_id")


@query("dq_03_is_valid_date", f"WITH {DIRTY} SELECT event_id FROM d WHERE bad_day")
def _(t):
    return dirty_events(t).where(Q.is_valid_date("on_day")).select("event_id")


@query("dq_04_is_in_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(t):
    return t.orders.where(Q.is_in_list("o_orderstatus", ["F", "O"])).select("o_orderkey", "o_orderstatus")


@query("dq_05_sql_expression", """
SELECT o_orderkey, l_partkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT (l_shipdate > o_orderdate)""")
def _(t):
    joined = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return joined.where(Q.sql_expression("l_shipdate > o_orderdate")).select("o_orderkey", "l_partkey", "l_linenumber")


CHECKS = [
    {"name": "user_set", "function": "is_not_null", "arguments": {"col": "user_id"}},
    {"name": "value_range", "function": "is_in_range", "arguments": {"col": "value", "lo": 0, "hi": 150}},
    {"name": "day_valid", "function": "is_valid_date", "arguments": {"col": "on_day"}},
    {"name": "type_known", "function": "is_in_list", "arguments": {"col": "event_type", "allowed": ["view", "click", "purchase", "signup"]}, "criticality": "warn"},
    {"name": "props_set", "function": "is_not_null_and_not_empty", "arguments": {"col": "props"}, "criticality": "warn"},
]
CHECKED = f"""{DIRTY}, k AS (SELECT *, concat_ws(',', CASE WHEN user_id IS NULL THEN 'user_set' END, CASE WHEN value > 150 THEN 'value_range' END,
 CASE WHEN bad_day THEN 'day_valid' END) AS errors, concat_ws(',', CASE WHEN event_type = 'error' THEN 'type_known' END,
 CASE WHEN trim(props) = '' THEN 'props_set' END) AS warnings FROM d)"""


@query("dq_06_apply_checks", f"WITH {CHECKED} SELECT event_id, errors, warnings FROM k")
def _(t):
    out = Q.apply_checks(dirty_events(t), Q.checks_from_metadata(CHECKS))
    return out.select("event_id", F.array_join("_errors", ",").alias("errors"), F.array_join("_warnings", ",").alias("warnings"))


@query("dq_07_split", f"WITH {CHECKED} SELECT CASE WHEN errors = '' THEN 'valid' ELSE 'quarantined' END AS side, event_id FROM k")
def _(t):
    valid, bad = Q.split(dirty_events(t), CHECKS)
    return valid.select(F.lit("valid").alias("side"), "event_id").unionByName(bad.select(F.lit("quarantined").alias("side"), "event_id"))


@query("dq_08_failure_summary", f"""
WITH {CHECKED}, f AS (SELECT unnest(string_split(concat_ws(',', NULLIF(errors, ''), NULLIF(warnings, '')), ',')) AS check_name FROM k)
SELECT check_name, COUNT(*) AS failed_rows FROM f WHERE check_name != '' GROUP BY 1""")
def _(t):
    return Q.failure_summary(Q.apply_checks(dirty_events(t), Q.checks_from_metadata(CHECKS)))


@query("dq_09_validate_or_raise", "SELECT event_id, value FROM events")
def _(t):
    checks = [Q.Check("user_set", Q.is_not_null("user_id")), Q.Check("value_range", Q.is_in_range("value", 0, 1e9))]
    return Q.validate_or_raise(t.events, checks).select("event_id", "value")


PROFILE_COLS = {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderpriority": False}


def _profile_sql():
    parts = []
    for col, numeric in PROFILE_COLS.items():
        d = f"CAST({col} AS DECIMAL(18,2))"
        s, q = f"CAST(SUM({d}) AS DOUBLE)", f"CAST(SUM({d} * {d}) AS DOUBLE)"
        mean = f"{s} / COUNT({col})" if numeric else "NULL::DOUBLE"
        dev = f"sqrt(({q} - {s} * {s} / COUNT({col})) / (COUNT({col}) - 1))" if numeric else "NULL::DOUBLE"
        text = f"CAST(MIN({col}) AS VARCHAR) AS min_value, CAST(MAX({col}) AS VARCHAR) AS max_value"
        parts.append(f"SELECT '{col}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({col}) AS null_count, "
                     f"COUNT(DISTINCT {col}) AS distinct_count, {text}, {mean} AS mean, {dev} AS stddev FROM orders")
    return " UNION ALL ".join(parts)


@query("dq_10_profile", f"SELECT column_name, row_count, null_count, distinct_count, min_value, max_value, round(mean, 6) AS mean, round(stddev, 3) AS stddev FROM ({_profile_sql()})")
def _(t):
    out = Q.profile(t.orders, list(PROFILE_COLS), scale=2)
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 3))


@query("dq_11_suggest_rules", f"""
WITH p AS ({_profile_sql()}) SELECT column_name, 'is_not_null' AS function, '' AS arguments FROM p WHERE null_count = 0
UNION ALL SELECT column_name, 'is_in_list', CAST(distinct_count AS VARCHAR) FROM p WHERE distinct_count <= 10
UNION ALL SELECT column_name, 'is_in_range', min_value || '..' || max_value FROM p WHERE mean IS NOT NULL""")
def _(t):
    return Q.suggest_rules(Q.profile(t.orders, list(PROFILE_COLS), scale=2))


@query("dq_12_metric_checks", """
WITH m AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(l_partkey) AS z, (SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1)) AS d FROM lineitem)
SELECT 'has_rows' AS check_name, 'row_count' AS metric, n AS value, 0::DOUBLE AS threshold, 'pass' AS status FROM m
UNION ALL SELECT 'no_missing', 'missing_count', z, 0::DOUBLE, 'pass' FROM m
UNION ALL SELECT 'few_repeats', 'duplicate_count', d, 0::DOUBLE, CASE WHEN d = 0 THEN 'pass' ELSE 'fail' END FROM m""")
def _(t):
    return Q.metric_checks(t.lineitem, [("has_rows", "row_count", None, ">", 0), ("no_missing", "missing_count", "l_partkey", "=", 0),
                                        ("few_repeats", "duplicate_count", "l_orderkey", "=", 0)])


@query("dq_13_custom_metric", """
SELECT 'shipped_before_ordered' AS check_name, COUNT(*) AS value, CASE WHEN COUNT(*) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate""")
def _(t):
    return Q.custom_metric(t.spark, "shipped_before_ordered", "SELECT count(*) FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey "
                           "WHERE o.o_orderdate > l.l_shipdate", "=", 0, lineitem=t.lineitem, orders=t.orders)


@query("dq_14_references", """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus != 'P')""")
def _(t):
    return Q.references(t.lineitem, "l_orderkey", t.orders.where("o_orderstatus != 'P'"), "o_orderkey").select("l_orderkey", "l_partkey", "l_linenumber")


@query("dq_15_schema_check", """
SELECT 'o_orderkey' AS column_name, 'bigint' AS expected, 'bigint' AS actual, 'ok' AS state, COUNT(o_orderkey) AS non_null FROM orders
UNION ALL SELECT 'o_totalprice', 'decimal(12,2)', 'double', 'wrong_type', COUNT(o_totalprice) FROM orders
UNION ALL SELECT 'row_id', 'int', NULL, 'missing', NULL""")
def _(t):
    return Q.schema_check(t.orders, {"o_orderkey": "bigint", "o_totalprice": "decimal(12,2)", "row_id": "int"})


@query("dq_16_failed_row_sample", f"WITH {DIRTY} SELECT event_id, event_type FROM d WHERE user_id IS NULL ORDER BY event_id LIMIT 25")
def _(t):
    return Q.failed_row_sample(dirty_events(t), Q.Check("user_set", Q.is_not_null("user_id")), [c("event_id")], 25).select("event_id", "event_type")


@query("dq_17_column_tests", f"""
WITH {DIRTY} SELECT 'unique' AS test, CAST(l_orderkey AS VARCHAR) AS value, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1
UNION ALL SELECT 'accepted_values', o_orderstatus, COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
UNION ALL SELECT 'not_null', event_type, COUNT(*) FROM d WHERE user_id IS NULL GROUP BY 2""")
def _(t):
    unique = Q.test_unique(t.lineitem, "l_orderkey").select(F.lit("unique").alias("test"), c("l_orderkey").cast("string").alias("value"), "n")
    accepted = Q.test_accepted_values(t.orders, "o_orderstatus", ["F", "O"]).select(F.lit("accepted_values").alias("test"), c("o_orderstatus").alias("value"), "n")
    missing = Q.test_not_null(dirty_events(t), "user_id").groupBy(c("event_type").alias("value")).agg(F.count("*").alias("n")).withColumn("test", F.lit("not_null"))
    return unique.unionByName(accepted).unionByName(missing)


@query("dq_18_unique_combination", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return Q.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_19_singular_test", """
SELECT c_custkey, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM customer GROUP BY 1 HAVING SUM(CAST(c_acctbal AS DECIMAL(18,2))) < 0""")
def _(t):
    return Q.singular_test(t.spark, "SELECT c_custkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {customer} "
                           "GROUP BY c_custkey HAVING sum(CAST(c_acctbal AS DECIMAL(18,2))) < 0", customer=t.customer)


@query("dq_20_record_results", """
WITH a AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), b AS (SELECT COUNT(*) AS n FROM orders)
SELECT 'has_rows' AS check_name, 'pass' AS status, b.n AS value, 'run-2' AS run, CAST(2 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS failures FROM a, b
UNION ALL SELECT 'one_per_customer', 'fail', (SELECT COUNT(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)), 'run-2', 2, 2""")
def _(t):
    path = t.scratch("dq_history")
    checks = [("has_rows", "row_count", None, ">", 0), ("one_per_customer", "duplicate_count", "o_custkey", "=", 0)]
    Q.record_results(Q.metric_checks(t.orders.where("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'"), checks), path, "run-1")
    Q.record_results(Q.metric_checks(t.orders, checks), path, "run-2")
    return Q.latest_results(t.spark.read.parquet(path))


@query("dq_21_required_fields", f"""
WITH {DIRTY} SELECT event_id, CASE WHEN user_id IS NULL THEN 'missing field: user_id' WHEN value IS NULL THEN 'missing field: value'
 WHEN trim(props) = '' THEN 'empty field: props' END AS reason, 3::INTEGER AS retry_count FROM d
WHERE user_id IS NULL OR value IS NULL OR trim(props) = ''""")
def _(t):
    return Q.dead_letters(Q.required_fields(dirty_events(t), ["user_id", "value", "props"]), ["event_id"], retries=3)


RULES = {
    "required": ["order_id", "status", "address"],
    "properties": {
        "status": {"enum": ["F", "O"]}, "total": {"minimum": 5000}, "email": {"format": "email"}, "created_at": {"format": "date-time"},
        "address": {"type": "object", "required": ["city"]}}}


@query("dq_22_json_schema_rules", """
SELECT o_orderkey AS order_id, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'enum:status' END, CASE WHEN o_totalprice < 5000 THEN 'minimum:total' END,
 CASE WHEN o_orderpriority = '5-LOW' THEN 'format:email' END, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'required:address.city' END) AS failed FROM orders""")
def _(t):
    doc = F.to_json(F.struct(
        c("o_orderkey").alias("order_id"), c("o_orderstatus").alias("status"), c("o_totalprice").alias("total"),
        F.when(c("o_orderpriority") == "5-LOW", "nobody").otherwise(F.concat(F.lit("c"), "o_custkey", F.lit("@shop.example"))).alias("email"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(F.when(c("o_orderpriority") != "3-MEDIUM", "Springfield").alias("city"), F.lit("US").alias("country")).alias("address")))
    ddl = "order_id bigint, status string, total double, email string, created_at string, address struct<city:string,country:string>"
    rows = t.orders.select(F.from_json(doc, ddl).alias("d")).select("d.*")
    checked = Q.apply_checks(rows, Q.json_schema_rules(RULES))
    order = ["enum:status", "minimum:total", "format:email", "required:address.city"]
    return checked.select("order_id", F.concat_ws(",", *[F.when(F.array_contains("_errors", n), n) for n in order]).alias("failed"))


@query("dq_23_schema_drift_gate", """
SELECT 'device' AS column_name, 'added' AS change, true AS allowed, COUNT(*) AS rows_with_value FROM events
UNION ALL SELECT 'props', 'removed', true, 0
UNION ALL SELECT 'user_id', 'type int->bigint', true, COUNT(user_id) FROM events""")
def _(t):
    expected = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, user_id int, event_type string, value double, props string")
    batch = t.events.drop("props").withColumn("device", F.when(c("event_id") >= 0, "web"))
    return Q.schema_drift_gate(batch, expected, "backward")


@query("dq_10_profile_sketches", " UNION ALL ".join(f"""
SELECT '{col}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({col}) AS null_count, true AS distinct_near, true AS median_near, true AS extremes FROM orders"""
 for col in ("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")))
def _(t):
    """Profiles saved per year of orders and merged, held against the table itself."""
    cols = ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    path = t.scratch("profiles")
    yearly = t.orders.withColumn("year", F.year("o_orderdate"))
    SK.profile_sketches(yearly, cols, ["year"]).write.parquet(path)
    report = SK.profile_report(SK.merge_profiles(t.spark.read.parquet(path)))
    rank = lambda x: (F.count_if(c(x) < c(f"m_{x}")) / F.count(x), F.count_if(c(x) <= c(f"m_{x}")) / F.count(x))
    asked = t.orders.withColumns({f"m_{x}": report.where(c("column_name") == x).select("p50").scalar() for x in ("o_custkey", "o_totalprice")})
    below = lambda x: (rank(x)[0] <= 0.52) & (rank(x)[1] >= 0.48)
    exact = asked.agg(*[F.countDistinct(x).alias(f"d_{x}") for x in cols], *[F.min(x).cast("string").alias(f"lo_{x}") for x in cols],
                      *[F.max(x).cast("string").alias(f"hi_{x}") for x in cols], *[below(x).alias(f"r_{x}") for x in ("o_custkey", "o_totalprice")])
    truth = exact.select(F.explode(F.array(*[F.struct(F.lit(x).alias("column_name"), c(f"d_{x}").alias("d"), c(f"lo_{x}").alias("lo"), c(f"hi_{x}").alias("hi"),
                                                      (c(f"r_{x}") if x in ("o_custkey", "o_totalprice") else F.lit(True)).alias("r")) for x in cols])).alias("t")).select("t.*")
    same = lambda a, b: F.coalesce(F.col(a).try_cast("double") == F.col(b).try_cast("double"), F.col(a) == F.col(b))
    return report.join(truth, "column_name").select(
        "column_name", "row_count", "null_count", (F.abs(c("distinct_count") - c("d")) <= F.greatest(F.lit(1.0), 0.05 * c("d"))).alias("distinct_near"),
        c("r").alias("median_near"), (same("min_value", "lo") & same("max_value", "hi")).alias("extremes"))
