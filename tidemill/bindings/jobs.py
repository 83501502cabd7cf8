"""Domain jobs on the driver's tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemill.bindings.functions import hex_mod_sql
from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import DEC2, davg, dsum
from tidemill.functions import scalar as S
from tidemill.functions.exact import exact_sum
from tidemill.operators import aggregates as A
from tidemill.plans import broker as B
from tidemill.plans import experiment as E
from tidemill.plans import fraud as FR
from tidemill.plans import migrate as M
from tidemill.plans import reports as R
from tidemill.plans import semantic as SM
from tidemill.plans import sensors as N
from tidemill.plans import shop as P
from tidemill.sinks.files import write_partitioned
from tidemill.sources.files import inline_table

c = F.col


@query("dom_01_experiment_scores", """
WITH l AS (SELECT c_nationkey AS exp_id, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS metric_id, l_extendedprice AS value
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 WHERE epoch(l_shipdate) - epoch(o_orderdate) <= 1440 * 3600)
SELECT exp_id, n_name AS exp_name, metric_id, CASE metric_id WHEN 0 THEN 'Loss' ELSE 'Accuracy' END AS metric_name,
 MIN(value) AS min_value, MAX(value) AS max_value FROM l JOIN nation ON exp_id = n_nationkey GROUP BY 1, 2, 3, 4""")
def _(t):
    logs = (t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).join(t.customer, c("o_custkey") == c("c_custkey"))
            .select(c("c_nationkey").alias("exp_id"), F.when(c("l_linestatus") == "F", 0).otherwise(1).alias("metric_id"),
                    c("o_orderdate").alias("created_at"), c("l_shipdate").alias("ingested_at"), c("l_extendedprice").alias("value")))
    experiments = t.nation.select(c("n_nationkey").alias("exp_id"), c("n_name").alias("exp_name"))
    metrics = inline_table(t.spark, [(0, "Loss"), (1, "Accuracy")], "metric_id int, metric_name string")
    return E.save_scores(E.experiment_scores(logs, experiments, metrics, 60 * 24), t.scratch("scores"))


# ---- reports

CALLS = "(SELECT event_type AS call, value AS delay, CAST(json_extract(props, '$.k') AS INTEGER) AS zip, user_id AS hood, c_mktsegment AS city, ts FROM events JOIN customer ON user_id = c_custkey)"


@query("dom_02_fire_calls_report", f"""
WITH f AS {CALLS}, m AS (SELECT call, zip, COUNT(*) AS n FROM f GROUP BY 1, 2 ORDER BY n DESC, call, zip LIMIT 1),
w AS (SELECT weekofyear(ts) AS week, COUNT(*) AS n FROM f WHERE year(ts) = 2024 GROUP BY 1 ORDER BY n DESC, week LIMIT 1),
d AS (SELECT hood, {davg('delay')} AS mean FROM f WHERE city = 'BUILDING' GROUP BY 1 ORDER BY mean DESC, hood LIMIT 1)
SELECT 'call_types' AS question, call AS label, 1::DOUBLE AS value FROM (SELECT DISTINCT call FROM f)
UNION ALL SELECT 'slow_calls', 'over 100', COUNT(*) FROM f WHERE delay > 100
UNION ALL SELECT 'commonest', call || '/' || zip, n FROM m
UNION ALL SELECT 'neighbourhoods', hood::VARCHAR, 1 FROM (SELECT DISTINCT hood FROM f WHERE zip IN (7, 42))
UNION ALL SELECT 'totals', 'calls', COUNT(*) FROM f UNION ALL SELECT 'totals', 'total', {dsum('delay')} FROM f
UNION ALL SELECT 'totals', 'mean', {davg('delay')} FROM f UNION ALL SELECT 'totals', 'low', MIN(delay) FROM f
UNION ALL SELECT 'totals', 'high', MAX(delay) FROM f UNION ALL SELECT 'busiest_week', week::VARCHAR, n FROM w
UNION ALL SELECT 'worst_delay', hood::VARCHAR, mean FROM d""")
def _(t):
    calls = t.events.join(t.customer, c("user_id") == c("c_custkey")).select(
        c("event_type").alias("call"), c("value").alias("delay"), F.get_json_object("props", "$.k").cast("int").alias("zip"),
        c("user_id").alias("hood"), c("c_mktsegment").alias("city"), "ts")
    return R.fire_calls_report(calls, "call", "delay", "zip", "hood", "city", "ts", slow=100, zips=[7, 42], year=2024, in_city="BUILDING", scale=2)


@query("dom_03_location_summary", """
WITH j AS (SELECT n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT * FROM (SELECT 'highest' AS question, n_name AS label, MAX(c_acctbal) AS value FROM j GROUP BY 2 ORDER BY value DESC, label LIMIT 20)
UNION ALL SELECT 'coverage', 'rows', COUNT(*) FROM j UNION ALL SELECT 'coverage', 'locations', COUNT(DISTINCT n_name) FROM j""")
def _(t):
    joined = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select("n_name", "c_acctbal")
    return R.location_summary(joined, "n_name", "c_acctbal", 20)


TURBINE = f"""WITH r AS (SELECT user_id, ts, CASE WHEN value < 2 THEN NULL ELSE value END AS v FROM events),
k AS (SELECT * FROM r WHERE v IS NULL OR v BETWEEN 0 AND 300), m AS (SELECT user_id, median(v) AS md FROM k GROUP BY 1),
x AS (SELECT user_id, ts, v IS NULL AS imputed, COALESCE(v, md) AS v FROM k JOIN m USING (user_id))"""


def _readings(t):
    return t.events.select("user_id", "ts", "event_id", F.when(c("value") < 2, None).otherwise(c("value")).alias("power"))


@query("dom_04_turbine_pipeline", TURBINE + f""", s AS (SELECT date_trunc('day', ts) AS day, user_id, MIN(v) AS lowest, MAX(v) AS highest,
 {davg('v', 3)} AS mean FROM x GROUP BY 1, 2),
f AS (SELECT date_trunc('day', ts) AS day, {davg('v', 3)} AS fm, sqrt((CAST(SUM(CAST(v AS DECIMAL(18,3)) * CAST(v AS DECIMAL(18,3))) AS DOUBLE)
 - {dsum('v', 3)} * {dsum('v', 3)} / COUNT(v)) / (COUNT(v) - 1)) AS sd FROM x GROUP BY 1)
SELECT day, user_id, lowest, highest, mean, abs(mean - fm) > 2 * sd AS anomaly FROM s JOIN f USING (day)""")
def _(t):
    _, stats = N.turbine_pipeline(_readings(t), "user_id", "ts", "power", 0, 300, scale=3)
    return stats.drop("fleet_mean", "fleet_sd")


@query("dom_04_turbine_clean", TURBINE + "SELECT user_id, ts, v AS power, imputed FROM x")
def _(t):
    return N.clean_readings(_readings(t), "user_id", "power", 0, 300).select("user_id", "ts", "power", "imputed")


@query("dom_05_taxi_summary", f"""
SELECT {davg('l_extendedprice')} AS mean_fare, {davg('l_quantity')} AS mean_distance, {davg('l_tax')} AS mean_tip, CAST(SUM(l_linenumber) AS BIGINT) AS passengers,
 CAST(SUM(CAST(date_diff('day', o_orderdate, l_shipdate) * 1440 AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS mean_duration,
 COUNT(*) FILTER (l_quantity > 45) AS long_trips, COUNT(*) FILTER (l_tax / NULLIF(l_extendedprice, 0) * 100 > 0.0005) AS high_tips
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    trips = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return R.taxi_summary(trips, "l_extendedprice", "l_quantity", "l_tax", "l_linenumber",
                          S.duration_minutes(c("o_orderdate"), c("l_shipdate")), long_trip=45, high_tip_pct=0.0005, scale=2)


@query("dom_06_zone_stats", f"""
SELECT l_partkey, {davg('l_quantity')} AS mean_distance, {davg('l_extendedprice')} AS mean_fare, COUNT(*) AS trips FROM lineitem
WHERE l_quantity > 10 AND l_extendedprice > 50000 GROUP BY 1""")
def _(t):
    return R.zone_stats(t.lineitem, "l_partkey", "l_quantity", "l_extendedprice", min_distance=10, min_fare=50000, scale=2)


# ---- fraud

LIMITS = FR.Limits(count=3, count_window=86400, value=200.0, total=150.0, total_window=172800, merchants=3, full_value=400.0, total_span=2500.0)


def _txns(t):
    return t.events.select(c("event_id").alias("id"), c("user_id").alias("user"), "ts", c("value").alias("amount"),
                           c("event_type").alias("country"), F.get_json_object("props", "$.k").alias("merchant"))


FRAUD = f"""WITH e AS (SELECT event_id AS id, user_id AS "user", ts, value AS amount, event_type AS country, json_extract_string(props, '$.k') AS merchant,
 date_trunc('day', ts) AS b1, epoch_us(ts) // 172800000000 AS b2 FROM events),
f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "user", b1, merchant ORDER BY ts, id) = 1 AS fresh FROM e),
w AS (SELECT *, LAG(country) OVER u AS was, COUNT(*) OVER d AS n, CAST(SUM(fresh::INT) OVER d AS BIGINT) AS merchants,
 CAST(SUM({DEC2('amount')}) OVER (PARTITION BY "user", b2 ORDER BY ts, id) AS DOUBLE) AS total FROM f
 WINDOW u AS (PARTITION BY "user" ORDER BY ts, id), d AS (PARTITION BY "user", b1 ORDER BY ts, id)),
a AS (SELECT id, "user", ts, 'country_hop' AS rule, was || ' -> ' || country AS detail, 0.7::DOUBLE AS risk FROM w WHERE was != country
UNION ALL SELECT id, "user", ts, 'high_value', format('{{:,.2f}}', amount), LEAST(amount / 400.0::DOUBLE, 1.0::DOUBLE) FROM w WHERE amount > 200
UNION ALL SELECT id, "user", ts, 'spending_velocity', format('{{:,.2f}}', total), LEAST(0.6::DOUBLE + (total - 150.0::DOUBLE) / 2500.0::DOUBLE, 1.0::DOUBLE) FROM w WHERE total > 150
UNION ALL SELECT id, "user", ts, 'high_frequency', n::VARCHAR, LEAST(0.5::DOUBLE + (n - 5) * 0.1::DOUBLE, 1.0::DOUBLE) FROM w WHERE n > 3
UNION ALL SELECT id, "user", ts, 'merchant_diversity', merchants::VARCHAR, 0.5::DOUBLE FROM w WHERE merchants > 3)"""


@query("dom_07_fraud_rules", FRAUD + 'SELECT id, "user", ts, rule, detail, risk FROM a')
def _(t):
    return FR.fraud_rules(_txns(t), LIMITS)


# The same rules in windows that trail a row: a day of four parts, two days of four parts.
TRAILING_LIMITS = replace(LIMITS, parts=4)
TRAILING = f"""WITH e AS (SELECT event_id AS id, user_id AS "user", ts, value AS amount, event_type AS country, json_extract_string(props, '$.k') AS merchant,
 epoch_us(ts) // 21600000000 AS b1, epoch_us(ts) // 43200000000 AS b2 FROM events),
w AS (SELECT *, LAG(country) OVER u AS was,
 COUNT(*) OVER (PARTITION BY "user" ORDER BY b1 RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) - COUNT(*) OVER (PARTITION BY "user", b1)
  + ROW_NUMBER() OVER (PARTITION BY "user", b1 ORDER BY ts, id) AS n,
 CAST(SUM({DEC2('amount')}) OVER (PARTITION BY "user" ORDER BY b2 RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) - SUM({DEC2('amount')}) OVER (PARTITION BY "user", b2)
  + SUM({DEC2('amount')}) OVER (PARTITION BY "user", b2 ORDER BY ts, id) AS DOUBLE) AS total FROM e WINDOW u AS (PARTITION BY "user" ORDER BY ts, id)),
m AS (SELECT a.id, CAST(COUNT(DISTINCT coalesce(b.merchant, '')) AS BIGINT) AS merchants FROM e a JOIN e b ON a."user" = b."user"
 AND b.b1 BETWEEN a.b1 - 3 AND a.b1 AND (b.ts, b.id) <= (a.ts, a.id) GROUP BY a.id),
x AS (SELECT * FROM w JOIN m USING (id)),
a AS (SELECT id, "user", ts, 'country_hop' AS rule, was || ' -> ' || country AS detail, 0.7::DOUBLE AS risk FROM x WHERE was != country
UNION ALL SELECT id, "user", ts, 'high_value', format('{{:,.2f}}', amount), LEAST(amount / 400.0::DOUBLE, 1.0::DOUBLE) FROM x WHERE amount > 200
UNION ALL SELECT id, "user", ts, 'spending_velocity', format('{{:,.2f}}', total), LEAST(0.6::DOUBLE + (total - 150.0::DOUBLE) / 2500.0::DOUBLE, 1.0::DOUBLE) FROM x WHERE total > 150
UNION ALL SELECT id, "user", ts, 'high_frequency', n::VARCHAR, LEAST(0.5::DOUBLE + (n - 5) * 0.1::DOUBLE, 1.0::DOUBLE) FROM x WHERE n > 3
UNION ALL SELECT id, "user", ts, 'merchant_diversity', merchants::VARCHAR, 0.5::DOUBLE FROM x WHERE merchants > 3)
SELECT id, "user", ts, rule, detail, risk FROM a"""


@query("dom_07_fraud_rules_trailing", TRAILING)
def _(t):
    return FR.fraud_rules(_txns(t), TRAILING_LIMITS)


@query("dom_24_fraud_summary", FRAUD + """, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "user" ORDER BY ts DESC, id DESC, rule DESC) AS rn,
 CAST(risk AS DECIMAL(18,6)) AS d FROM a)
SELECT "user", COUNT(*) AS alert_count, CAST(SUM(d) AS DOUBLE) AS total_risk, CAST(SUM(d) AS DOUBLE) / COUNT(*) AS avg_risk, MAX(ts) AS last_alert_at,
 string_agg(CASE WHEN rn <= 5 THEN rule END, ' | ' ORDER BY ts, id, rule) AS reasons FROM r GROUP BY 1""")
def _(t):
    return FR.fraud_summary(FR.fraud_rules(_txns(t), LIMITS))


# ---- dashboard, alerts

SHOP = """s AS (SELECT ts, event_id AS id, user_id AS customer, c_mktsegment AS category, CASE WHEN value < 10 THEN 'cancelled' ELSE 'paid' END AS status,
 value AS amount FROM events JOIN customer ON user_id = c_custkey)"""


def _shop(t):
    """Every event of a known customer is an order: the tables have no other shop orders with a time of day."""
    return t.events.join(t.customer, c("user_id") == c("c_custkey")).select(
        "ts", c("event_id").alias("id"), c("user_id").alias("customer"), c("c_mktsegment").alias("category"),
        F.when(c("value") < 10, "cancelled").otherwise("paid").alias("status"), c("value").alias("amount"))


@query("dom_08_revenue_dashboard", f"""
WITH {SHOP}, r AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM s WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-20')
SELECT 'orders_per_minute' AS question, minute AS label, COUNT(*)::DOUBLE AS value FROM r GROUP BY 2
UNION ALL SELECT 'revenue_per_minute', minute, {dsum('amount')} FROM r GROUP BY 2
UNION ALL SELECT 'total', 'orders', COUNT(*) FROM r UNION ALL SELECT 'total', 'revenue', {dsum('amount')} FROM r
UNION ALL SELECT 'total', 'mean_order', {dsum('amount')} / COUNT(*) FROM r
UNION ALL SELECT 'category', category, {dsum('amount')} FROM r GROUP BY 2 UNION ALL SELECT 'status', status, COUNT(*) FROM r GROUP BY 2
UNION ALL (SELECT 'top_customers', customer::VARCHAR, {dsum('amount')} AS v FROM r GROUP BY customer ORDER BY v DESC, customer LIMIT 10)
UNION ALL (SELECT 'latest_orders', id::VARCHAR, amount FROM r ORDER BY ts DESC, id DESC LIMIT 20)""")
def _(t):
    path = t.scratch("dashboard")
    P.save_dashboard_tables(_shop(t), path)
    return P.revenue_dashboard(_shop(t), path, "2024-01-20 00:00:00", 7 * 86400)


@query("dom_09_alerts", f"""
WITH {SHOP}, p AS (SELECT date_trunc('hour', ts) AS h, COUNT(*) AS n, SUM({DEC2('amount')}) AS rev, COUNT(*) FILTER (status = 'cancelled') AS bad FROM s GROUP BY 1),
g AS (SELECT h, COALESCE(n, 0) AS n, COALESCE(rev, 0) AS rev, COALESCE(bad, 0) AS bad FROM (SELECT unnest(generate_series((SELECT MIN(h) FROM p),
 (SELECT MAX(h) FROM p), INTERVAL 1 HOUR)) AS h) LEFT JOIN p USING (h)),
x AS (SELECT a.t, r.rule, r.need, g.h, CASE r.rule WHEN 'low_revenue' THEN rev < 250 WHEN 'cancellations' THEN bad * 100.0 / NULLIF(n, 0) > 20 ELSE n < 5 END AS hit
 FROM g, (VALUES ('low_revenue', 3), ('cancellations', 1), ('few_orders', 2)) r(rule, need),
 (VALUES (TIMESTAMP '2024-01-11 00:00:00'), (TIMESTAMP '2024-01-20 05:00:00'), (TIMESTAMP '2024-01-28 13:00:00')) a(t) WHERE g.h < a.t),
o AS (SELECT t, rule, MAX(CASE WHEN NOT COALESCE(hit, false) THEN h END) AS ok FROM x GROUP BY 1, 2),
k AS (SELECT t, rule, need, COUNT(*) FILTER (ok IS NULL OR h > ok) AS periods FROM x JOIN o USING (t, rule) GROUP BY 1, 2, 3)
SELECT t AS as_of, rule, periods, CASE WHEN periods = 0 THEN 'normal' WHEN periods < need THEN 'pending' ELSE 'firing' END AS state FROM k""")
def _(t):
    periods = P.period_metrics(_shop(t), "1 hour")
    rules = {"low_revenue": (c("revenue") < 250, 3), "few_orders": (c("orders") < 5, 2),
             "cancellations": (c("cancelled") * 100.0 / F.nullif("orders", F.lit(0)) > 20, 1)}
    times = ("2024-01-11 00:00:00", "2024-01-20 05:00:00", "2024-01-28 13:00:00")
    return P.alert_states(periods, rules, [F.lit(at).cast("timestamp_ntz") for at in times])


@query("dom_09_low_stock", f"SELECT l_partkey, {dsum('l_quantity')} AS stock FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING SUM({DEC2('l_quantity')}) < 100")
def _(t):
    stock = t.lineitem.where("l_returnflag = 'R'").groupBy("l_partkey").agg(exact_sum("l_quantity", 2).alias("stock"))
    return P.low_stock(stock, "l_partkey", "stock", 100)


STEPS = ["view", "click", "signup", "purchase"]


@query("dom_10_funnel", """
WITH l AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM l),
f AS (SELECT user_id, s, MIN(CASE WHEN event_type = 'view' THEN ts END) AS t0, MIN(CASE WHEN event_type = 'click' THEN ts END) AS t1,
 MIN(CASE WHEN event_type = 'signup' THEN ts END) AS t2, MIN(CASE WHEN event_type = 'purchase' THEN ts END) AS t3 FROM g GROUP BY 1, 2),
n AS (SELECT COUNT(t0) AS n0, COUNT(*) FILTER (t1 > t0) AS n1, COUNT(*) FILTER (t1 > t0 AND t2 > t1) AS n2, COUNT(*) FILTER (t1 > t0 AND t2 > t1 AND t3 > t2) AS n3 FROM f)
SELECT 1 AS step_no, 'view' AS step, n0 AS sessions, n0 * 100::DOUBLE / n0 AS step_pct, n0 * 100::DOUBLE / n0 AS total_pct FROM n
UNION ALL SELECT 2, 'click', n1, n1 * 100::DOUBLE / n0, n1 * 100::DOUBLE / n0 FROM n
UNION ALL SELECT 3, 'signup', n2, n2 * 100::DOUBLE / n1, n2 * 100::DOUBLE / n0 FROM n
UNION ALL SELECT 4, 'purchase', n3, n3 * 100::DOUBLE / n2, n3 * 100::DOUBLE / n0 FROM n""")
def _(t):
    return P.funnel(t.events, "user_id", "ts", "event_type", STEPS, 12 * 3600)


@query("dom_10_transition_matrix", """
WITH l AS (SELECT *, LAG(ts) OVER w AS p, LAG(event_type) OVER w AS from_step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT from_step, event_type AS to_step, COUNT(*) AS n FROM l WHERE ts - p <= INTERVAL 12 HOUR GROUP BY 1, 2""")
def _(t):
    return P.transition_matrix(t.events, "user_id", ["ts", "event_id"], "event_type", 12 * 3600)


@query("dom_11_page_and_referrer_counts", """
WITH j AS (SELECT date_trunc('day', ts) AS window_start, event_type, c_mktsegment FROM events JOIN customer ON user_id = c_custkey)
SELECT window_start, 'page' AS kind, event_type AS name, COUNT(*) AS n FROM j GROUP BY 1, 3
UNION ALL SELECT window_start, 'referrer', c_mktsegment, COUNT(*) FROM j GROUP BY 1, 3""")
def _(t):
    joined = t.events.join(t.customer, c("user_id") == c("c_custkey"))
    return P.page_and_referrer_counts(joined, "ts", "1 day", "event_type", "c_mktsegment")


@query("dom_12_sensor_anomalies", f"""
WITH r AS (SELECT event_id, user_id, ts, CASE WHEN value < 0.5 THEN NULL ELSE value END AS v, CASE event_type WHEN 'error' THEN 200 ELSE 350 END AS hi FROM events),
w AS (SELECT *, COUNT(v) OVER w AS n, CAST(SUM({DEC2('v')}) OVER w AS DOUBLE) AS s, CAST(SUM({DEC2('v')} * {DEC2('v')}) OVER w AS DOUBLE) AS q FROM r
 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
k AS (SELECT event_id, user_id, CASE WHEN v IS NULL THEN 'dropout' WHEN v NOT BETWEEN 0 AND hi THEN 'out_of_range'
 WHEN n >= 20 AND abs(v - s / n) > 3 * sqrt(GREATEST((q - s * s / n) / (CASE WHEN n > 1 THEN n - 1 END), 0)) THEN 'spike' END AS anomaly FROM w)
SELECT * FROM k WHERE anomaly IS NOT NULL""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", F.when(c("value") < 0.5, None).otherwise(c("value")).alias("reading"),
                           F.when(c("event_type") == "error", 200.0).otherwise(350.0).alias("hi"))
    out = N.sensor_anomalies(rows, "user_id", ["ts", "event_id"], "reading", F.lit(0.0), c("hi"), 20, 3.0, block=1000, scale=2)
    return out.select("event_id", "user_id", "anomaly")


# ---- carts

KINDS = {"view": "cart.item_added", "click": "cart.item_quantity_changed", "error": "cart.item_removed",
         "signup": "cart.discount_applied", "purchase": "cart.discount_removed"}


def _cart_events(t):
    kind = S.map_lookup(c("event_type"), KINDS)
    item = kind.startswith("cart.item")
    product = F.get_json_object("props", "$.k")
    return t.events.select(
        c("user_id").alias("cart"), "ts", c("event_id").alias("id"), kind.alias("type"), F.when(item, product).alias("product"),
        F.when(kind == "cart.item_added", 1).when(kind == "cart.item_quantity_changed", 3).alias("quantity"),
        F.when(kind == "cart.item_added", c("value")).alias("unit_price"),
        F.when(~item, F.when(c("value") > 30, "SAVE10").otherwise("MINUS5")).alias("code"),
        F.when(~item, F.when(c("value") > 30, "percentage").otherwise("fixed")).alias("discount_type"),
        F.when(~item, F.when(c("value") > 30, 10.0).otherwise(5.0)).alias("discount_value"))


CART = """WITH e AS (SELECT * FROM events WHERE ts <= TIMESTAMP '{as_of}'), i AS (SELECT user_id, json_extract_string(props, '$.k') AS product,
 MAX(CASE WHEN event_type = 'view' THEN (ts, event_id) END) AS a, MAX(CASE WHEN event_type = 'error' THEN (ts, event_id) END) AS r,
 MAX(CASE WHEN event_type = 'click' THEN (ts, event_id) END) AS ch, arg_max(value, CASE WHEN event_type = 'view' THEN (ts, event_id) END) AS price
 FROM e WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2),
k AS (SELECT user_id, COUNT(*) AS unique_items, CAST(SUM(CASE WHEN ch > a THEN 3 ELSE 1 END) AS BIGINT) AS item_count,
 SUM(CAST(price AS DECIMAL(18,2)) * CASE WHEN ch > a THEN 3 ELSE 1 END) AS subtotal FROM i WHERE a IS NOT NULL AND (r IS NULL OR a > r) GROUP BY 1),
d AS (SELECT user_id, CASE WHEN value > 30 THEN 'SAVE10' ELSE 'MINUS5' END AS code, arg_max(event_type, (ts, event_id)) AS last FROM e
 WHERE event_type IN ('signup', 'purchase') GROUP BY 1, 2),
o AS (SELECT user_id, MAX((code = 'SAVE10')::INT) AS pct, MAX((code = 'MINUS5')::INT) AS fix, string_agg(code, ',' ORDER BY code) AS discounts FROM d WHERE last = 'signup' GROUP BY 1),
u AS (SELECT user_id, MAX(ts) AS last_updated FROM e GROUP BY 1),
z AS (SELECT user_id, COALESCE(item_count, 0) AS item_count, COALESCE(unique_items, 0) AS unique_items, COALESCE(subtotal, 0) AS subtotal,
 COALESCE(pct, 0) AS pct, COALESCE(fix, 0) AS fix, COALESCE(discounts, '') AS discounts, last_updated FROM u LEFT JOIN k USING (user_id) LEFT JOIN o USING (user_id)),
y AS (SELECT *, ROUND(CAST(LEAST(subtotal, subtotal * pct / 10.0 + fix * 5) AS DECIMAL(18,6)), 2) AS discount FROM z)
SELECT user_id AS cart, item_count, unique_items, CAST(subtotal AS DOUBLE) AS subtotal, CAST(discount AS DOUBLE) AS discount,
 CAST(CAST(subtotal AS DECIMAL(18,2)) - CAST(discount AS DECIMAL(18,2)) AS DOUBLE) AS total, discounts, last_updated FROM y"""


@query("dom_13_cart_replay", CART.format(as_of="2024-01-15 00:00:00"))
def _(t):
    return P.cart_replay(_cart_events(t), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


@query("dom_13_cart_replay_from_snapshot", CART.format(as_of="2024-01-15 10:30:00"))
def _(t):
    log, saved = t.scratch("cart_events"), t.scratch("cart_snapshots")
    write_partitioned(_cart_events(t).withColumn("day", F.to_date("ts")), log, ["day"])
    events = t.spark.read.parquet(log)
    P.save_cart_snapshots(events, saved, ["2024-01-05 00:00:00", "2024-01-12 06:00:00", "2024-01-25 00:00:00"])
    return P.cart_replay_from(saved, events, "2024-01-15 10:30:00")


@query("dom_14_cart_read_model", CART.format(as_of="2025-01-01 00:00:00"))
def _(t):
    return P.cart_read_model(_cart_events(t), t.scratch("carts"))


# ---- offsets and partitions

@query("dom_15_consumer_lag", f"""
WITH p AS (SELECT event_type AS topic, ({hex_mod_sql('s', 4, 64)})::INTEGER AS part, ts FROM (SELECT *, sha256(user_id::VARCHAR) AS s FROM events)),
e AS (SELECT topic, part, COUNT(*) AS n, COUNT(*) FILTER (ts < TIMESTAMP '2024-01-25') AS a, COUNT(*) FILTER (ts < TIMESTAMP '2024-01-10') AS b FROM p GROUP BY 1, 2),
l AS (SELECT 'fast' AS grp, topic, part, n - a AS lag FROM e UNION ALL SELECT 'slow', topic, part, n - b FROM e),
r AS (SELECT * FROM l UNION ALL SELECT grp, topic, -1, CAST(SUM(lag) AS BIGINT) FROM l GROUP BY 1, 2)
SELECT grp, topic, part, lag, CASE WHEN lag > 1000 THEN 'high' WHEN lag > 200 THEN 'elevated' ELSE 'ok' END AS level FROM r""")
def _(t):
    placed = t.events.select(c("event_type").alias("topic"), S.hash_partition(c("user_id"), 4).alias("part"), "ts")
    ends = placed.groupBy("topic", "part").agg(F.count("*").alias("end_offset"))
    commits = None
    for grp, until in (("fast", "2024-01-25 00:00:00"), ("slow", "2024-01-10 00:00:00")):
        done = placed.where(c("ts") < F.lit(until).cast("timestamp_ntz")).groupBy("topic", "part").agg(
            F.count("*").alias("committed")).withColumn("grp", F.lit(grp))
        commits = done if commits is None else commits.unionByName(done)
    return B.consumer_lag(ends, commits, elevated=200, high=1000)


@query("dom_16_partition_skew", f"""
WITH p AS (SELECT user_id, ({hex_mod_sql('s', 6, 64)})::INTEGER AS part FROM (SELECT user_id, sha256(CASE WHEN event_type = 'error' AND value > 100 THEN 'stray' ELSE user_id::VARCHAR END) AS s FROM events)),
g AS (SELECT part, COUNT(*) AS messages, COUNT(DISTINCT user_id) AS keys FROM p GROUP BY 1), k AS (SELECT user_id, COUNT(DISTINCT part) AS d, COUNT(*) AS n FROM p GROUP BY 1)
SELECT 'partition' AS kind, part::VARCHAR AS name, messages::DOUBLE AS a, keys::DOUBLE AS b FROM g
UNION ALL SELECT 'stray_key', user_id::VARCHAR, n, d FROM k WHERE d > 1
UNION ALL SELECT 'imbalance', 'all', MAX(messages), MAX(messages) / (SUM(messages) / COUNT(*)) FROM g""")
def _(t):
    key = F.when((c("event_type") == "error") & (c("value") > 100), "stray").otherwise(c("user_id").cast("string"))
    per, strays, imbalance = B.partition_skew(t.events.select("user_id", S.hash_partition(key, 6).alias("part")), "part", "user_id")

    def row(df, kind, name, a, b):
        return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), a.cast("double").alias("a"), b.cast("double").alias("b"))
    return (row(per, "partition", c("part"), c("messages"), c("keys"))
            .unionByName(row(strays, "stray_key", c("user_id"), c("messages"), c("partitions")))
            .unionByName(row(imbalance, "imbalance", F.lit("all"), c("largest"), c("imbalance"))))


CODES = ["US", "CA", "BR", "MX", "AR", "GB", "DE", "FR", "ES", "IT", "JP", "AU", "IN", "KR", "SG", "ZA", "EG", "NG", "KE", "NZ", "CL", "PE", "TR", "SE", "NO"]
GEO = f"""WITH n AS (SELECT c_custkey, ({CODES})[c_nationkey + 1] AS country FROM customer),
m AS (SELECT c_custkey, country, md5(country) AS d, CASE WHEN country IN ('US', 'CA', 'BR', 'MX', 'AR') THEN 0 WHEN country IN ('GB', 'DE', 'FR', 'ES', 'IT') THEN 1
 WHEN country IN ('JP', 'AU', 'IN', 'KR', 'SG') THEN 2 END AS region FROM n),
g AS (SELECT c_custkey, country, COALESCE(region, ({hex_mod_sql('d', 3, 32)}))::INTEGER AS expected_part, ({hex_mod_sql('d', 3, 32)})::INTEGER AS actual FROM m)
SELECT c_custkey, country, expected_part, actual FROM g WHERE expected_part != actual"""


@query("dom_17_geo_route", GEO)
def _(t):
    country = F.try_element_at(F.array(*[F.lit(x) for x in CODES]), c("c_nationkey") + 1)
    rows = t.customer.select("c_custkey", country.alias("country")).withColumn("actual", S.hash_partition(c("country"), 3, "md5"))
    return B.misrouted(rows, "country", "actual", 3)


# ---- semantic layer

MODEL = {
    "base": "lineitem",
    "joins": {"orders": ("l_orderkey = o_orderkey", "many_to_one"), "part": ("l_partkey = p_partkey", "many_to_one"),
              "customer": ("o_custkey = c_custkey", "many_to_one"), "nation": ("c_nationkey = n_nationkey", "many_to_one"),
              "region": ("n_regionkey = r_regionkey", "many_to_one")},
    "keys": {"orders": ["o_orderkey"], "customer": ["c_custkey"]},
    "needs": {"customer": "orders", "nation": "customer", "region": "nation"},
    "dimensions": {"status": ("orders", "o_orderstatus"), "segment": ("customer", "c_mktsegment"), "state": ("nation", "n_name"),
                   "region": ("region", "r_name"), "category": ("part", "p_type"), "manager": ("region", "concat('Manager of ', r_name)"),
                   "priority": ("orders", "o_orderpriority"), "returnflag": ("lineitem", "l_returnflag")},
    "date_groups": {"ordered": ("orders", "o_orderdate")},
    "measures": {
        "sales": ("lineitem", "sum_money", "l_extendedprice"), "profit": ("lineitem", "sum_money", "cast(l_extendedprice as decimal(12,2)) * cast(0.5 - l_discount as decimal(4,2))"),
        "lines": ("lineitem", "count", "l_linenumber"), "orders": ("orders", "count_distinct", "o_orderkey"),
        "returned_orders": ("lineitem", "count_distinct", "case when l_returnflag = 'R' then l_orderkey end"),
        "customers": ("orders", "count_distinct", "o_custkey"), "order_value": ("orders", "sum_money", "o_totalprice"),
        "order_rows": ("orders", "count", "o_orderkey"), "balance": ("customer", "sum_money", "c_acctbal"),
        "value_per_order": (None, "ratio", ("order_value", "order_rows")),
        "profit_ratio": (None, "ratio", ("profit", "sales")), "returned_ratio": (None, "ratio", ("returned_orders", "orders"))},
    "parameters": {"profit_or_sales": {"profit": "profit", "sales": "sales"}},
}
PROFIT = "CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.5 - l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))) AS DOUBLE)"


def _views(t):
    return {v: getattr(t, v) for v in ("lineitem", "orders", "part", "customer", "nation", "region")}


@query("dom_18_semantic_query", f"""
SELECT c_mktsegment AS segment, date_trunc('quarter', o_orderdate)::DATE AS ordered_quarter, {PROFIT} AS profit_or_sales, COUNT(DISTINCT o_orderkey) AS orders,
 {PROFIT} / {dsum('l_extendedprice')} AS profit_ratio FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2""")
def _(t):
    return SM.semantic_query(_views(t), MODEL, ["segment", "ordered_quarter"], ["profit_or_sales", "orders", "profit_ratio"],
                             {"status": ["F", "O"]}, {"profit_or_sales": "profit"})


@query("dom_18_semantic_fanout", f"""
WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
l AS (SELECT l_returnflag AS returnflag, c_mktsegment AS segment, {dsum('l_extendedprice')} AS sales, COUNT(l_linenumber) AS lines FROM j GROUP BY 1, 2),
o AS (SELECT l_returnflag AS returnflag, c_mktsegment AS segment, {dsum('o_totalprice')} AS order_value, COUNT(*) AS order_rows
 FROM (SELECT DISTINCT l_returnflag, c_mktsegment, o_orderkey, o_totalprice FROM j) GROUP BY 1, 2),
k AS (SELECT l_returnflag AS returnflag, c_mktsegment AS segment, {dsum('c_acctbal')} AS balance FROM (SELECT DISTINCT l_returnflag, c_mktsegment, c_custkey, c_acctbal FROM j) GROUP BY 1, 2)
SELECT returnflag, segment, sales, lines, order_value, order_rows, balance, order_value / order_rows AS value_per_order FROM l JOIN o USING (returnflag, segment) JOIN k USING (returnflag, segment)""")
def _(t):
    return SM.semantic_query(_views(t), MODEL, ["returnflag", "segment"], ["sales", "lines", "order_value", "order_rows", "balance", "value_per_order"])


KPIS = ["returned_ratio", "sales", "profit", "customers", "profit_ratio", "orders"]


@query("dom_19_superstore_kpis", f"""
WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
 WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND p_type != 'PROMO' AND o_orderstatus IN ('F', 'O') AND year(o_orderdate) BETWEEN 1996 AND 1999 AND r_name != 'ASIA'),
k AS (SELECT 'month' AS panel, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS label, * FROM j UNION ALL SELECT 'state', n_name, * FROM j
 UNION ALL SELECT 'region', r_name, * FROM j UNION ALL SELECT 'manager', 'Manager of ' || r_name, * FROM j)
SELECT panel, label, COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) / COUNT(DISTINCT o_orderkey) AS returned_ratio, {dsum('l_extendedprice')} AS sales,
 {PROFIT} AS profit, COUNT(DISTINCT o_custkey) AS customers, {PROFIT} / {dsum('l_extendedprice')} AS profit_ratio, COUNT(DISTINCT o_orderkey) AS orders FROM k GROUP BY 1, 2""")
def _(t):
    import datetime as dt
    filters = {"segment": ["BUILDING", "MACHINERY", "HOUSEHOLD"], "category": ["ECONOMY", "STANDARD", "SMALL", "MEDIUM", "LARGE"], "status": ["F", "O"],
               "ordered_year": (dt.date(1996, 1, 1), dt.date(1999, 1, 1)), "region": ["AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"]}
    panels = SM.semantic_panels(_views(t), MODEL, ["ordered_month", "state", "region", "manager"], KPIS, filters)
    return panels.withColumn("panel", F.regexp_replace("panel", "^ordered_", ""))


# ---- further reports

@query("dom_20_repo_questions", """
WITH p AS (SELECT p_partkey, p_retailprice, p_brand, p_size, p_type, TIMESTAMP '2015-01-01' + p_size * INTERVAL 100 DAY AS made FROM part),
y AS (SELECT strftime(made, '%Y') AS y, p_brand, COUNT(*) AS n FROM p GROUP BY 1, 2)
SELECT 'total' AS question, 'all' AS label, COUNT(*)::DOUBLE AS value FROM p
UNION ALL (SELECT 'top_stars', p_partkey::VARCHAR, p_retailprice FROM p ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
UNION ALL SELECT 'best_per_language', p_brand || '/' || p_partkey, p_retailprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM p) WHERE rn = 1
UNION ALL (SELECT 'newest', p_partkey::VARCHAR, p_retailprice FROM p ORDER BY made DESC, p_partkey LIMIT 10)
UNION ALL SELECT 'language_share', y || '/' || p_brand, n * 100::DOUBLE / SUM(n) OVER (PARTITION BY y) FROM y
UNION ALL SELECT 'per_owner', p_type, COUNT(*) FROM p GROUP BY 2""")
def _(t):
    repos = t.part.withColumn("made_at", F.lit("2015-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=c("p_size") * 100))
    return R.repo_questions(repos, "p_partkey", "p_retailprice", "p_brand", "made_at", "p_type")


@query("dom_21_posts_by_month", """
SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, COUNT(*) AS posts FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def _(t):
    return R.posts_by_month(t.orders, "o_orderdate", c("o_orderstatus") == "F")


@query("dom_22_migrate_with_duration", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS shipping_duration
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    path = t.scratch("migrated")
    rows = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate")
    out = M.migrate_with_duration(rows, "o_orderdate", "l_shipdate", lambda df: df.write.parquet(path), lambda: t.spark.read.parquet(path))
    return out.drop("o_orderdate", "l_shipdate")


@query("dom_23_tag_search_pruned", """
SELECT layout, o_orderkey, o_totalprice FROM orders, (VALUES ('plain'), ('partitioned'), ('clustered')) v(layout)
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-30' AND o_orderpriority = '2-HIGH'""")
def _(t):
    path = t.scratch("layouts")
    M.write_three_ways(t.orders, path, "o_orderdate", "o_orderpriority")
    lo, hi = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")
    out = None
    for layout in ("plain", "partitioned", "clustered"):
        one = M.tag_search(t.spark, path, layout, "o_orderdate", lo, hi, "o_orderpriority", "2-HIGH").select(
            F.lit(layout).alias("layout"), "o_orderkey", "o_totalprice")
        out = one if out is None else out.unionByName(one)
    return out


@query("dom_25_product_cross_counts", f"""
WITH j AS (SELECT n_name, c_mktsegment, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'all' AS scope, n_name, c_mktsegment, {dsum('c_acctbal')} AS total FROM j GROUP BY 2, 3
UNION ALL SELECT 'one', n_name, c_mktsegment, {dsum('c_acctbal')} FROM j WHERE n_name = 'NATION_7' GROUP BY 2, 3""")
def _(t):
    rows = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    amount = c("c_acctbal").cast("decimal(18,2)")
    return (R.product_cross_counts(rows, "n_name", "c_mktsegment", amount).withColumn("scope", F.lit("all"))
            .unionByName(R.product_cross_counts(rows, "n_name", "c_mktsegment", amount, "NATION_7").withColumn("scope", F.lit("one"))))
