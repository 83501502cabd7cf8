"""Change data built from orders and customers, and the operators on it.

Every order gives a snapshot record; status P gives an update to 'shipped' a day later;
priority 5-LOW gives a delete after two days and a tombstone behind it. Every customer
gives a create. Snapshots come wrapped in ``payload``, live changes come bare.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import dsum
from tidemill.functions.exact import exact_sum
from tidemill.operators import cdc as C
from tidemill.operators import ordered as O
from tidemill.operators.summaries import RetractableSummary
from tidemill.operators.versioned import VersionedTable
from tidemill.streaming import sinks as K

c = F.col
ROW_DDL = "id:bigint,customer:bigint,name:string,status:string,total:double,updated_at:bigint"
FIELDS = ["id", "customer", "name", "status", "total", "updated_at"]
DAY_MS = 86_400_000


def envelopes(t):
    """key, value (JSON or NULL), position."""
    o = t.orders.withColumn("ms", F.unix_millis(c("o_orderdate").cast("timestamp")))

    def row(status, shift):
        return F.struct(c("o_orderkey").alias("id"), c("o_custkey").alias("customer"), F.lit(None).cast("string").alias("name"),
                        status.alias("status"), c("o_totalprice").alias("total"), (c("ms") + shift).alias("updated_at"))

    def source(table, shift, snapshot):
        return F.struct(F.lit("shop").alias("db"), F.lit(table).alias("table"), (c("ms") + shift).alias("ts_ms"),
                        F.lit(snapshot).alias("snapshot"))

    st = c("o_orderstatus")
    shipped = st == "P"
    first, second = row(st, 0), row(F.lit("shipped"), DAY_MS)
    last = F.when(shipped, second).otherwise(first)

    def env(op, before, after, shift, snapshot="false", table="orders"):
        parts = [x for x in (before.alias("before") if before is not None else None,
                             after.alias("after") if after is not None else None) if x is not None]
        return F.struct(*parts, source(table, shift, snapshot).alias("source"), F.lit(op).alias("op"),
                        (c("ms") + shift).alias("ts_ms"))

    r = F.to_json(F.struct(env("r", None, first, 0, "true").alias("payload")))
    u = F.to_json(env("u", first, second, DAY_MS))
    d = F.to_json(env("d", last, None, 2 * DAY_MS))
    low = c("o_orderpriority") == "5-LOW"

    def rec(step, value, when=None):
        out = F.struct(F.lit(step).alias("step"), value.alias("value"))
        return out if when is None else F.when(when, out)

    recs = F.filter(F.array(rec(0, r), rec(1, u, shipped), rec(2, d, low), rec(3, F.lit(None).cast("string"), low)),
                    lambda x: x.isNotNull())
    from_orders = o.select(F.concat(F.lit("orders:"), "o_orderkey").alias("key"), F.explode(recs).alias("e")).select(
        "key", "e.value", c("e.step").cast("long").alias("position"))
    cust = t.customer.withColumn("ms", F.lit(0).cast("long"))
    made = F.struct(c("c_custkey").alias("id"), c("c_custkey").alias("customer"), c("c_name").alias("name"),
                    c("c_mktsegment").alias("status"), c("c_acctbal").alias("total"), c("ms").alias("updated_at"))
    from_customers = cust.select(F.concat(F.lit("customers:"), "c_custkey").alias("key"),
                                 F.to_json(env("c", None, made, 0, "false", "customers")).alias("value"),
                                 F.lit(0).cast("long").alias("position"))
    return from_orders.unionByName(from_customers)


def parsed(t):
    return C.parse_envelope(envelopes(t), ROW_DDL)


# One row per record, with the same rules as above.
LOG = """WITH log AS (
 SELECT 'orders' AS tbl, o_orderkey AS id, 'r' AS op, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total,
   epoch_ms(o_orderdate) AS ts_ms, NULL AS old_status FROM orders
 UNION ALL SELECT 'orders', o_orderkey, 'u', o_custkey, 'shipped', o_totalprice, epoch_ms(o_orderdate) + 86400000, o_orderstatus
   FROM orders WHERE o_orderstatus = 'P'
 UNION ALL SELECT 'orders', o_orderkey, 'd', o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE o_orderstatus END,
   o_totalprice, epoch_ms(o_orderdate) + 2 * 86400000, NULL FROM orders WHERE o_orderpriority = '5-LOW'
 UNION ALL SELECT 'orders', o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderpriority = '5-LOW'
 UNION ALL SELECT 'customers', c_custkey, 'c', c_custkey, c_mktsegment, c_acctbal, 0, NULL FROM customer),
live AS (SELECT o_orderkey AS id, o_custkey AS customer, CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE o_orderstatus END AS status,
  o_totalprice AS total, epoch_ms(o_orderdate) + CASE WHEN o_orderstatus = 'P' THEN 86400000 ELSE 0 END AS updated_at
  FROM orders WHERE o_orderpriority != '5-LOW')
"""


@query("cdc_01_parse_envelope", LOG + """
SELECT tbl || ':' || id AS key, op, tbl AS "table", op IS NULL AS tombstone, total, ts_ms FROM
(SELECT tbl, id, op, total, ts_ms FROM log WHERE op IS NOT NULL)
UNION ALL SELECT 'orders:' || id, NULL, NULL, true, NULL, NULL FROM log WHERE op IS NULL""")
def _(t):
    return parsed(t).select("key", "op", c("source.table").alias("table"), "tombstone",
                            F.coalesce("after.total", "before.total").alias("total"), "ts_ms")


@query("cdc_02_unwrap_new_record", LOG + """
SELECT id, customer, status, total, op, tbl AS "table", ts_ms, op = 'd' AS deleted FROM log WHERE op IS NOT NULL""")
def _(t):
    return C.unwrap_new_record(parsed(t), ["id", "customer", "status", "total"])


@query("cdc_03_filter_ops", LOG + "SELECT id, op, status FROM log WHERE op IN ('u', 'd') AND tbl = 'orders'")
def _(t):
    return C.filter_ops(parsed(t), ["u", "d"], ["orders"]).select(
        F.coalesce("after.id", "before.id").alias("id"), "op", F.coalesce("after.status", "before.status").alias("status"))


HANDLERS = LOG + """SELECT CASE WHEN op IS NULL THEN 'purge' WHEN op = 'c' AND tbl = 'customers' THEN 'greet'
 WHEN op = 'u' AND tbl = 'orders' AND status = 'shipped' THEN 'announce' WHEN op = 'd' THEN 'review'
 ELSE 'rest' END AS handler, COUNT(*) AS n FROM log GROUP BY 1"""


@query("cdc_04_route_events", HANDLERS)
def _(t):
    op, table = c("op"), c("source.table")
    rules = [("purge", c("tombstone")), ("greet", (op == "c") & (table == "customers")),
             ("announce", (op == "u") & (table == "orders") & (c("after.status") == "shipped")), ("review", op == "d")]
    return C.route_events(parsed(t), rules, "rest").groupBy("handler").agg(F.count("*").alias("n"))


@query("cdc_05_diff_before_after", LOG + """
SELECT id, 'status' AS field, old_status AS old, status AS new FROM log WHERE op = 'u'""")
def _(t):
    diff = C.diff_before_after(parsed(t), FIELDS)
    return diff.select(c("after.id").alias("id"), F.explode("changes").alias("x")).select("id", "x.field", "x.old", "x.new")


@query("cdc_06_apply_changelog", LOG + "SELECT id, customer, status, total, updated_at FROM live")
def _(t):
    orders = parsed(t).where(c("key").startswith("orders:"))
    return C.apply_changelog(orders, "key", ["position"], ["id", "customer", "status", "total", "updated_at"])


@query("cdc_06_apply_changelog_stream", LOG + "SELECT id, customer, status, total, updated_at FROM live")
def _(t):
    """The log arrives in two parts: snapshots first, then all that came after them."""
    table = VersionedTable(t.spark, t.scratch("current"), ["key"])
    folder, ckpt = t.scratch("changes"), t.scratch("ckpt")
    orders = envelopes(t).where(c("key").startswith("orders:"))
    for step in (orders.where("position = 0"), orders.where("position > 0")):
        step.write.mode("append").parquet(folder)
        stream = t.spark.readStream.schema(orders.schema).parquet(folder)
        K.changelog_stream(C.parse_envelope(stream, ROW_DDL), table, ["position"],
                           ["id", "customer", "status", "total", "updated_at"], ckpt)
    return K.live_rows(table).drop("key")


BY_STATUS = LOG + f"SELECT status, COUNT(*) AS n, {dsum('total')} AS revenue FROM live GROUP BY 1"


@query("cdc_07_cdc_aggregate", BY_STATUS)
def _(t):
    orders = parsed(t).where(c("key").startswith("orders:"))
    live = C.apply_changelog(orders, "key", ["position"], ["status", "total"])
    return live.groupBy("status").agg(F.count("*").alias("n"), exact_sum("total", 2).alias("revenue"))


@query("cdc_07_cdc_aggregate_deltas", BY_STATUS)
def _(t):
    orders = parsed(t).where(c("key").startswith("orders:"))
    signed = C.signed_rows(orders, ["status", "total"])
    return signed.groupBy("status").agg(F.sum("sign").alias("n"), F.sum(
        c("total").cast("decimal(18,2)") * c("sign")).cast("double").alias("revenue")).where("n > 0")


@query("cdc_07_cdc_aggregate_stream", BY_STATUS.replace("COUNT(*) AS n,", "COUNT(*) AS n, MIN(total) AS min_total, MAX(total) AS max_total,"))
def _(t):
    """The log arrives in three parts; each is taken in once, updates that change the status included."""
    folder, ckpt = t.scratch("log"), t.scratch("ckpt")
    log = parsed(t).where(c("key").startswith("orders:"))
    summary = RetractableSummary(t.spark, t.scratch("by_status"), ["status"], {"revenue": c("total").cast("decimal(18,2)")}, ["total"], 2)
    for low, high in ((0, 0), (1, 1), (2, 3)):
        log.where(c("position").between(low, high)).write.mode("append").parquet(folder)
        K.retract_stream(t.spark.readStream.schema(log.schema).parquet(folder), summary, ["status", "total"], ckpt)
    return summary.read().select("status", "n", "min_total", "max_total", c("revenue").cast("double").alias("revenue"))


@query("cdc_08_validate_dead_letter", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'no_operation' WHEN 'signup' THEN 'unknown_operation:x'
  WHEN 'error' THEN CASE WHEN value < 30 THEN 'not_json' ELSE 'no_before_row:d' END
  WHEN 'purchase' THEN 'no_after_row:c' END AS error_reason FROM events
WHERE event_type != 'view' AND value <= 100""")
def _(t):
    kind, body = c("event_type"), F.to_json(F.struct("event_id", "user_id", "value"))
    value = (F.when(c("value") > 100, None)
             .when(kind == "view", F.format_string('{"payload": {"op": "c", "after": %s}}', body))
             .when(kind == "click", F.lit('{"garbage": "this is not a change event"}'))
             .when(kind == "signup", F.format_string('{"op": "x", "after": %s}', body))
             .when((kind == "error") & (c("value") < 30), F.lit("{not json"))
             .when(kind == "error", F.lit('{"op": "d", "before": null}'))
             .otherwise(F.lit('{"payload": {"op": "c", "after": null}}')))
    msgs = t.events.select(c("event_id").cast("string").alias("key"), value.alias("value"), c("user_id").alias("part"),
                           c("event_id").alias("pos"))
    bad = C.dead_letters(C.validate_envelope(msgs), {"partition": "part", "offset": "pos"})
    return bad.select(c("original_offset").alias("event_id"), "error_reason")


@query("cdc_09_event_stats", LOG + """
SELECT CASE WHEN op IS NULL THEN '?' ELSE tbl END AS "table", COUNT(*) FILTER (op = 'c') AS n_c, COUNT(*) FILTER (op = 'u') AS n_u,
 COUNT(*) FILTER (op = 'd') AS n_d, COUNT(*) FILTER (op = 'r') AS n_r, COUNT(*) FILTER (op IS NULL) AS tombstones, COUNT(*) AS total
FROM log GROUP BY 1""")
def _(t):
    return C.event_stats(parsed(t))


@query("cdc_10_schema_changes", """
WITH r AS (SELECT event_id, user_id, ts, event_type = 'purchase' AS a, value > 50 AS v FROM events),
l AS (SELECT *, LAG(a) OVER w AS pa, LAG(v) OVER w AS pv FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, concat_ws(',', CASE WHEN a AND NOT pa THEN 'amount' END, CASE WHEN v AND NOT pv THEN 'value' END) AS added,
 concat_ws(',', CASE WHEN pa AND NOT a THEN 'amount' END, CASE WHEN pv AND NOT v THEN 'value' END) AS removed
FROM l WHERE pa IS NOT NULL AND (a != pa OR v != pv)""")
def _(t):
    row = F.to_json(F.struct("event_id", F.when(c("event_type") == "purchase", c("value")).alias("amount"),
                             F.when(c("value") > 50, c("value")).alias("value")))
    rows = t.events.select("event_id", "user_id", "ts", row.alias("row_json"))
    out = C.schema_changes(rows, "user_id", ["ts", "event_id"], "row_json")
    return out.select("event_id", F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed"))


@query("cdc_11_describe_change", LOG + """
SELECT CASE op WHEN 'c' THEN 'INSERT into customers: #' || id || ' ' || c_name
 WHEN 'r' THEN 'SNAPSHOT into orders: #' || id || ' status=' || status
 WHEN 'u' THEN 'UPDATE orders #' || id || ': status: ' || old_status || ' -> ' || status
 WHEN 'd' THEN 'DELETE from orders: #' || id || ' status=' || status END AS line
FROM log LEFT JOIN customer ON tbl = 'customers' AND id = c_custkey WHERE op IS NOT NULL""")
def _(t):
    shown = {"customers": F.coalesce("after.name", "before.name"),
             "orders": F.concat(F.lit("status="), F.coalesce("after.status", "before.status"))}
    return C.describe_change(parsed(t), ["customer", "name", "status", "total"], "id", shown).select("line")


@query("cdc_12_compare_replica", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'missing' WHEN o_totalprice > 400000 THEN 'mismatch' END AS state,
  CASE WHEN o_orderstatus != 'P' THEN 'o_totalprice' || CASE WHEN o_orderpriority = '5-LOW' THEN ',o_orderpriority' ELSE '' END END AS fields
FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 400000
UNION ALL SELECT -1 - o_orderkey, 'extra', NULL FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    src = t.orders.select(*cols)
    big = c("o_totalprice") > 400000
    dst = t.orders.where("o_orderstatus != 'P'").select(
        "o_orderkey", "o_custkey", F.when(big, c("o_totalprice") + 1).otherwise(c("o_totalprice")).alias("o_totalprice"),
        F.when(big & (c("o_orderpriority") == "5-LOW"), None).otherwise(c("o_orderpriority")).alias("o_orderpriority"))
    extra = t.orders.where("o_orderpriority = '1-URGENT'").select((-1 - c("o_orderkey")).alias("o_orderkey"), *cols[1:])
    return C.compare_replica(src, dst.unionByName(extra), "o_orderkey", cols[1:])


@query("cdc_13_snapshot_vs_stream", LOG + """
SELECT tbl AS "table", CASE WHEN op = 'r' THEN 'snapshot' ELSE 'stream' END AS phase, COUNT(*) AS n FROM log WHERE op IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return C.snapshot_vs_stream(parsed(t))


STATES = {"view": "pending", "click": "confirmed", "signup": "shipped", "purchase": "delivered", "error": "cancelled"}


@query("cdc_14_status_history", """
WITH s AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'confirmed' WHEN 'signup' THEN 'shipped'
  WHEN 'purchase' THEN 'delivered' ELSE 'cancelled' END AS status FROM events),
l AS (SELECT *, LAG(status) OVER w AS from_status, LAG(ts) OVER w AS since FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, from_status, status, (epoch_us(ts) - epoch_us(since)) / CAST(1000000 AS DOUBLE) AS dwell_s,
 (from_status || '>' || status) IN ('pending>confirmed', 'pending>cancelled', 'confirmed>shipped', 'confirmed>cancelled',
 'shipped>delivered', 'delivered>returned') AS legal FROM l WHERE from_status != status""")
def _(t):
    from tidemill.functions.scalar import map_lookup
    rows = t.events.select("event_id", "user_id", "ts", map_lookup(c("event_type"), STATES).alias("status"))
    return C.status_history(rows, "user_id", ["ts", "event_id"], "status").select(
        "event_id", "from_status", "status", "dwell_s", "legal")


@query("cdc_15_route_by_config", HANDLERS)
def _(t):
    rules = [{"condition": "tombstone", "handler": "purge"}, {"op": "c", "table": "customers", "handler": "greet"},
             {"op": "u", "table": "orders", "condition": "after.status = 'shipped'", "handler": "announce"},
             {"op": "d", "handler": "review"}]
    return C.route_by_config(parsed(t), rules, "rest").groupBy("handler").agg(F.count("*").alias("n"))


@query("cdc_16_merge_replicas_lww", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'us' ELSE 'eu' END AS region,
  CASE WHEN o_orderstatus = 'P' THEN 'hold' ELSE o_orderpriority END AS o_orderpriority, o_totalprice,
  CAST((o_orderstatus = 'P')::INT AS BIGINT) AS lost FROM orders""")
def _(t):
    cols = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    eu = t.orders.select(*cols, c("o_orderdate").alias("at"))
    us = t.orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("hold").alias("o_orderpriority"), "o_totalprice",
        (c("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("at"))
    return C.merge_replicas_lww([("eu", eu), ("us", us)], "o_orderkey", "at", cols[1:])


@query("cdc_16_merge_replicas_lww_fields", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'hold' ELSE o_orderpriority END AS prio, o_totalprice AS price,
  CAST((o_orderstatus = 'P')::INT + (o_orderstatus = 'P')::INT AS BIGINT) AS lost FROM orders""")
def _(t):
    day = F.expr("INTERVAL 1 DAY")
    eu = t.orders.select("o_orderkey", c("o_orderpriority").alias("prio"), c("o_orderdate").alias("prio_ts"),
                         c("o_totalprice").alias("price"), (c("o_orderdate") + day).alias("price_ts"))
    us = t.orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("hold").alias("prio"), (c("o_orderdate") + day).alias("prio_ts"),
        (c("o_totalprice") + 1).alias("price"), c("o_orderdate").alias("price_ts"))
    return C.merge_replicas_lww([("eu", eu), ("us", us)], "o_orderkey", "", ["prio", "price"], field_level=True)


@query("cdc_17_classify_replication", f"""
WITH k AS (SELECT CASE event_type WHEN 'view' THEN 'clickstream.view' WHEN 'click' THEN 'session.click' WHEN 'signup' THEN 'account.created'
  WHEN 'purchase' THEN 'billing.charged' ELSE 'log.error' END AS kind, c_mktsegment AS region, value FROM events JOIN customer ON user_id = c_custkey),
g AS (SELECT CASE WHEN kind LIKE 'account.%' OR kind LIKE 'billing.%' THEN 'global' ELSE 'local' END AS scope, region, value FROM k)
SELECT region, CAST(SUM((scope = 'global')::INT) AS BIGINT) AS global_events, CAST(SUM((scope = 'local')::INT) AS BIGINT) AS local_events, {dsum('value')} AS amount FROM g GROUP BY 1
UNION ALL SELECT 'ALL', CAST(SUM((scope = 'global')::INT) AS BIGINT), CAST(SUM((scope = 'local')::INT) AS BIGINT), {dsum('value')} FROM g""")
def _(t):
    from tidemill.functions.scalar import map_lookup
    kinds = {"view": "clickstream.view", "click": "session.click", "signup": "account.created",
             "purchase": "billing.charged", "error": "log.error"}
    rows = t.events.join(t.customer, c("user_id") == c("c_custkey")).select(
        map_lookup(c("event_type"), kinds).alias("kind"), c("c_mktsegment").alias("region"), "value")
    tagged = C.classify_replication(rows, "kind")
    out = C.regional_rollup(tagged, "region", global_events=(c("scope") == "global").cast("int"),
                            local_events=(c("scope") == "local").cast("int"), amount=c("value").cast("decimal(18,2)"))
    return out.withColumn("amount", c("amount").cast("double"))
