"""Projections, filters, joins, aggregates, sorting and set operations on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import davg, dsum, DEC2
from tidemill.functions import scalar as S
from tidemill.functions.exact import exact_avg, exact_sum
from tidemill.operators import aggregates as A
from tidemill.operators import joins as J
from tidemill.operators import ordered as O
from tidemill.operators import relational as R

c = F.col


# ---- projections and filters

def grouped():
    """Orders of three neighbouring customers under the first one's key: a join on it leaves the others without a match."""
    return c("o_custkey") - c("o_custkey") % 3


@query("prj_01_select_computed", """
SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS amount, l_extendedprice / 100 AS price_units
FROM lineitem""")
def _(t):
    return R.select_computed(t.lineitem, ["l_orderkey", "l_linenumber"], {
        "amount": c("l_extendedprice") * c("l_quantity"), "price_units": c("l_extendedprice") / 100})


@query("prj_02_rename_drop", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS amount,
       o_orderdate AS ordered_at FROM orders""")
def _(t):
    return R.drop_cols(R.rename_cols(t.orders, {
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
        "o_totalprice": "amount", "o_orderdate": "ordered_at"}), "o_orderpriority")


@query("prj_03_filter_compare", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
WHERE o_totalprice > 200000 AND o_totalprice < 400000 AND o_orderstatus != 'P' AND o_orderpriority = '2-HIGH'""")
def _(t):
    return R.filter_compare(t.orders, ("o_totalprice", ">", 200000.0), ("o_totalprice", "<", 400000.0),
                            ("o_orderstatus", "!=", "P"), ("o_orderpriority", "=", "2-HIGH")
                            ).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("prj_04_filter_in", "SELECT p_partkey, p_size, p_brand FROM part WHERE p_size IN (7, 11, 23, 42)")
def _(t):
    return R.filter_in(t.part, "p_size", ["7", "11", "23", "42"]).select("p_partkey", "p_size", "p_brand")


@query("prj_05_filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def _(t):
    return R.filter_like(t.part, "p_name", "blue%").select("p_partkey", "p_name")


@query("prj_06_filter_range", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1998-06-30 00:00:00'""")
def _(t):
    return R.filter_range(t.orders, "o_orderdate", F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"),
                          F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")).select("o_orderkey", "o_orderdate")


@query("prj_07_filter_not_null", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL AND user_id IS NOT NULL""")
def _(t):
    k = F.get_json_object("props", "$.k")
    return R.filter_not_null(t.events, k, "user_id").select("event_id", k.cast("long").alias("k"))


@query("prj_08_tier_case", """
SELECT event_id, CASE WHEN value < 50 THEN 'small' WHEN value < 200 THEN 'medium' ELSE 'large' END AS size_tier,
       CASE WHEN value > 200 THEN 'premium' WHEN value > 100 THEN 'standard' ELSE 'basic' END AS value_tier
FROM events""")
def _(t):
    v = c("value")
    return t.events.select("event_id", R.tier_case(v, [(50, "small"), (200, "medium")], "large").alias("size_tier"),
                           R.tier_case(v, [(200, "premium"), (100, "standard")], "basic", above=True
                                       ).alias("value_tier"))


@query("prj_09_distinct_values", "SELECT DISTINCT p_type, p_brand FROM part")
def _(t):
    return t.part.select("p_type", "p_brand").distinct()


@query("prj_10_select_constant", "SELECT o_orderkey, 1 AS one, 'z' AS new_column FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.lit(1).alias("one"), F.lit("z").alias("new_column"))


@query("prj_11_filter_finite", """
SELECT event_id, user_id, value FROM events
WHERE event_type IN ('view', 'purchase', 'signup') AND user_id IS NOT NULL AND value >= 1""")
def _(t):
    broken = (F.when(c("value") < 0.5, F.lit(float("nan"))).when(c("value") < 1, F.lit(float("inf")))
              .otherwise(c("value")))
    return R.filter_finite(t.events.withColumn("value", broken), "value", "user_id", "event_type",
                           ["view", "purchase", "signup"]).select("event_id", "user_id", "value")


@query("prj_12_ratio_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_tax, l_discount FROM lineitem
WHERE l_tax / NULLIF(l_discount, 0) * 100 > 150""")
def _(t):
    return R.ratio_filter(t.lineitem, c("l_tax"), c("l_discount"), 150).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_discount")


LATE = """
SELECT o_orderkey, l_partkey, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE epoch(l_shipdate) - epoch(o_orderdate) {} 720 * 3600"""


def _ingested(t, keep):
    rows = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return R.late_record_filter(rows, "o_orderdate", "l_shipdate", 720, keep).select(
        "o_orderkey", "l_partkey", "o_orderdate", "l_shipdate")


@query("prj_13_late_record_filter", LATE.format("<="))
def _(t):
    return _ingested(t, "on_time")


@query("prj_13_late_record_filter_late", LATE.format(">"))
def _(t):
    return _ingested(t, "late")


# ---- joins

@query("jon_01_inner_join", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    return J.inner_join(t.orders, t.customer, c("o_custkey") == c("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice")


@query("jon_02_left_join", """
SELECT c_custkey, o_orderkey, o_totalprice FROM customer
LEFT JOIN (SELECT o_custkey - o_custkey % 3 AS c_custkey, o_orderkey, o_totalprice FROM orders) USING (c_custkey)""")
def _(t):
    right = t.orders.select(grouped().alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.left_join(t.customer.select("c_custkey"), right, "c_custkey")


@query("jon_03_star_join", f"""
SELECT p_brand, c_mktsegment, s_nationkey, COUNT(*) AS n, {dsum('l_extendedprice')} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
def _(t):
    wide = J.star_join(t.lineitem, [
        (t.part.select("p_partkey", "p_brand"), c("l_partkey") == c("p_partkey")),
        (t.supplier.select("s_suppkey", "s_nationkey"), c("l_suppkey") == c("s_suppkey")),
        (t.orders.select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey")),
        (t.customer.select("c_custkey", "c_mktsegment"), c("o_custkey") == c("c_custkey"))])
    return A.group_agg(wide, ["p_brand", "c_mktsegment", "s_nationkey"],
                       n=F.count("*"), revenue=exact_sum("l_extendedprice", 2))


@query("jon_04_join_cast_key", """
SELECT o_orderkey, customer_ref, c_name FROM
(SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_ref FROM orders)
JOIN customer ON customer_ref = CAST(c_custkey AS VARCHAR)""")
def _(t):
    text_keyed = t.orders.select("o_orderkey", c("o_custkey").cast("string").alias("customer_ref"))
    return J.join_cast_key(text_keyed, "customer_ref", t.customer, "c_custkey").select(
        "o_orderkey", "customer_ref", "c_name")


@query("jon_05_interval_join", """
SELECT p.event_id AS purchase_id, k.event_id AS click_id, p.user_id AS user_id FROM events p JOIN events k
ON p.user_id = k.user_id AND k.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts
WHERE p.event_type = 'purchase' AND k.event_type = 'click'""")
def _(t):
    buy = t.events.where("event_type = 'purchase'").select(
        c("event_id").alias("purchase_id"), "user_id", c("ts").alias("bought_at"))
    click = t.events.where("event_type = 'click'").select(
        c("event_id").alias("click_id"), c("user_id").alias("click_user"), c("ts").alias("clicked_at"))
    return J.interval_join(buy, click, [("user_id", "click_user")], "bought_at", "clicked_at", -3600, 0).select(
        "purchase_id", "click_id", "user_id")


@query("jon_06_window_join", """
SELECT o_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 7 DAY AND o_orderdate + INTERVAL 7 DAY""")
def _(t):
    return J.window_join(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")], "o_orderdate", "l_shipdate",
                         7 * 86400).select("o_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate")


@query("jon_07_lookup_enrich", """
SELECT event_id, user_id, COALESCE(c_name, 'Unknown Customer') AS c_name, COALESCE(c_mktsegment, 'unknown') AS c_mktsegment,
       COALESCE(c_acctbal, 0.0) AS c_acctbal
FROM events LEFT JOIN customer ON CASE WHEN event_type = 'error' THEN -1 - user_id ELSE user_id END = c_custkey""")
def _(t):
    known = F.when(c("event_type") == "error", -1 - c("user_id")).otherwise(c("user_id"))  # events of errors name nobody
    return J.lookup_enrich(t.events.select("event_id", "user_id", known.alias("known_user")), t.customer,
                           c("known_user") == c("c_custkey"),
                           {"c_name": "Unknown Customer", "c_mktsegment": "unknown", "c_acctbal": 0.0}
                           ).select("event_id", "user_id", "c_name", "c_mktsegment", "c_acctbal")


@query("jon_08_asof_lookup", """
SELECT p.event_id AS event_id, p.user_id AS user_id, k.event_id AS click_id, k.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') k ON p.user_id = k.user_id AND p.ts >= k.ts""")
def _(t):
    buy = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    click = t.events.where("event_type = 'click'").select(
        "event_id", "user_id", "ts", "value")
    return J.asof_lookup(buy, click, "user_id", "ts", "ts", {"click_id": "event_id", "click_value": "value"},
                         "event_id", "event_id").select("event_id", "user_id", "click_id", "click_value")


@query("jon_09_table_table_join", """
SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer JOIN
(SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
ON o_custkey = c_custkey WHERE rn = 1""")
def _(t):
    newest = A.latest_by_offset(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                ["o_orderkey", "o_orderstatus"])
    people = A.latest_by_offset(t.customer, ["c_custkey"], ["c_acctbal"], ["c_name"])
    return J.inner_join(people, newest, c("c_custkey") == c("o_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", "o_orderstatus")


@query("jon_10_anti_join_new", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def _(t):
    loaded = t.orders.where("o_orderdate < timestamp_ntz'2000-01-01 00:00:00'")
    return J.anti_join_new(t.orders, loaded, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query("jon_11_not_in_subquery", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000)""")
def _(t):
    busy = t.orders.where("o_orderstatus = 'P' AND o_totalprice > 300000")
    return J.not_in_subquery(t.customer, "c_custkey", busy, "o_custkey").select("c_custkey", "c_name")


@query("jon_12_semi_join_exists", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def _(t):
    returned = t.lineitem.where("l_returnflag = 'R'")
    return J.semi_join_exists(t.orders, returned, c("o_orderkey") == c("l_orderkey")).select(
        "o_orderkey", "o_totalprice")


@query("jon_13_calendar_join", f"""
WITH cal AS (SELECT CAST(unnest(generate_series((SELECT MIN(o_orderdate) FROM orders),
                                                (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, COUNT(o_orderkey) AS orders,
       COUNT(DISTINCT day) AS days, {dsum('o_totalprice')} AS amount
FROM orders LEFT JOIN cal ON CAST(o_orderdate AS DATE) = day GROUP BY 1, 2""")
def _(t):
    cal = J.calendar_over(t.orders, "o_orderdate")
    joined = J.left_join(t.orders.withColumn("on_day", c("o_orderdate").cast("date")), cal, c("on_day") == c("day"))
    return A.group_agg(joined, ["year", "quarter"], orders=F.count("o_orderkey"), days=F.countDistinct("day"),
                       amount=exact_sum("o_totalprice", 2))


@query("jon_14_join_then_window", f"""
SELECT date_trunc('day', ts) AS window_start, c_mktsegment, COUNT(*) AS n, {dsum('value')} AS revenue
FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase' GROUP BY 1, 2""")
def _(t):
    joined = t.events.where("event_type = 'purchase'").join(
        t.customer.select("c_custkey", "c_mktsegment"), c("user_id") == c("c_custkey"))
    return (joined.groupBy(F.window("ts", "1 day").alias("w"), "c_mktsegment")
            .agg(F.count("*").alias("n"), exact_sum("value", 2).alias("revenue"))
            .select(c("w.start").alias("window_start"), "c_mktsegment", "n", "revenue"))


# ---- aggregates

@query("agg_01_global_agg", f"""
SELECT COUNT(*) AS n, {dsum('o_totalprice')} AS total, {davg('o_totalprice')} AS mean, MIN(o_totalprice) AS lowest,
       MAX(o_totalprice) AS highest FROM orders""")
def _(t):
    return A.global_agg(t.orders, n=F.count("*"), total=exact_sum("o_totalprice", 2), mean=exact_avg("o_totalprice", 2),
                        lowest=F.min("o_totalprice"), highest=F.max("o_totalprice"))


@query("agg_02_group_agg", f"""
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, {dsum('o_totalprice')} AS total, {davg('o_totalprice')} AS mean,
       MIN(o_totalprice) AS lowest, MAX(o_totalprice) AS highest FROM orders GROUP BY 1, 2""")
def _(t):
    return A.group_agg(t.orders, ["o_orderstatus", "o_orderpriority"], n=F.count("*"),
                       total=exact_sum("o_totalprice", 2), mean=exact_avg("o_totalprice", 2),
                       lowest=F.min("o_totalprice"), highest=F.max("o_totalprice"))


@query("agg_03_min_max_by_group", """
SELECT user_id, event_type, MAX(value) AS max_value, MIN(value) AS min_value FROM events GROUP BY 1, 2""")
def _(t):
    return A.min_max_by_group(t.events, ["user_id", "event_type"], "value")


@query("agg_04_count_distinct", """
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderpriority) AS priorities
FROM orders GROUP BY 1""")
def _(t):
    return A.group_agg(t.orders, ["o_orderstatus"], customers=F.countDistinct("o_custkey"),
                       priorities=F.countDistinct("o_orderpriority"))


@query("agg_05_conditional_sum", f"""
SELECT o_custkey, {dsum("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")} AS finished,
       {dsum("CASE WHEN o_orderstatus = 'O' THEN o_totalprice END")} AS open,
       SUM(CASE WHEN o_orderstatus = 'P' THEN 1 END)::BIGINT AS pending FROM orders GROUP BY 1""")
def _(t):
    st = c("o_orderstatus")
    price = c("o_totalprice").cast("decimal(18,2)")
    return A.group_agg(t.orders, ["o_custkey"],
                       finished=A.conditional_sum(price, st == "F").cast("double"),
                       open=A.conditional_sum(price, st == "O").cast("double"),
                       pending=A.conditional_sum(F.lit(1), st == "P"))


@query("agg_06_rate_pct", """
SELECT CAST(l_shipdate AS DATE) AS day, SUM((l_returnflag = 'R')::INT)::BIGINT AS returned,
  CASE WHEN SUM((l_returnflag IN ('R', 'A'))::INT) > 0
  THEN CAST(SUM((l_returnflag = 'R')::INT) * CAST(100 AS DOUBLE) / SUM((l_returnflag IN ('R', 'A'))::INT) AS DOUBLE)
  ELSE CAST(0 AS DOUBLE) END AS return_rate FROM lineitem GROUP BY 1""")
def _(t):
    days = A.group_agg(t.lineitem, [c("l_shipdate").cast("date").alias("day")],
                       returned=F.count_if(c("l_returnflag") == "R"),
                       base=F.count_if(c("l_returnflag").isin("R", "A")))
    return days.select("day", "returned", A.rate_pct(c("returned"), c("base")).alias("return_rate"))


@query("agg_07_share_pct", """
SELECT o_orderpriority, CAST(COALESCE(SUM(CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 1 END), 0) AS DOUBLE)
       * 100 / NULLIF(COUNT(*), 0) AS pending_pct FROM orders GROUP BY 1""")
def _(t):
    part = A.group_agg(t.orders, ["o_orderpriority"], n=F.count("*"),
                       pending=F.sum(F.when((c("o_orderstatus") == "P") & (c("o_totalprice") > 400000), 1)))
    return part.select("o_orderpriority", A.share_pct(c("pending"), c("n")).alias("pending_pct"))


@query("agg_08_having_filter", f"""
SELECT user_id, w AS window_start, COUNT(*) AS n, {dsum('value')} AS total FROM
(SELECT *, unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS w FROM events)
GROUP BY 1, 2 HAVING COUNT(*) >= 3""")
def _(t):
    hop = t.events.groupBy("user_id", F.window("ts", "2 hours", "1 hour").alias("w")).agg(
        F.count("*").alias("n"), exact_sum("value", 2).alias("total"))
    return hop.where("n >= 3").select("user_id", c("w.start").alias("window_start"), "n", "total")


def _joined(t, distinct):
    top = A.topk(t.lineitem, ["l_partkey"], "l_extendedprice", 3, distinct)
    text = F.array_join(F.transform("top", lambda v: v.cast("decimal(18,2)").cast("string")), ",")
    return top.select("l_partkey", text.alias("top_prices"))


TOPK = """
SELECT l_partkey, array_to_string(list_transform(list(p ORDER BY p DESC), lambda x: CAST(CAST(x AS DECIMAL(18,2)) AS VARCHAR)), ',') AS top_prices
FROM (SELECT l_partkey, p, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY p DESC) AS rn FROM {}) WHERE rn <= 3 GROUP BY 1"""


@query("agg_09_topk", TOPK.format("(SELECT l_partkey, l_extendedprice AS p FROM lineitem)"))
def _(t):
    return _joined(t, False)


@query("agg_10_topk_distinct", TOPK.format("(SELECT DISTINCT l_partkey, l_extendedprice AS p FROM lineitem)"))
def _(t):
    return _joined(t, True)


@query("agg_11_latest_by_offset", """
SELECT user_id, event_id, event_type, value FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(t):
    return A.latest_by_offset(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("agg_12_value_counts", "SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1")
def _(t):
    return A.value_counts(t.part, "p_brand")


NULLED = "SELECT c.*, o_orderkey, o_totalprice FROM customer c LEFT JOIN orders ON o_custkey - o_custkey % 3 = c_custkey"


@query("agg_13_null_counts", f"""
WITH j AS ({NULLED}), n AS (SELECT COUNT(*) - COUNT(c_custkey) AS c_custkey, COUNT(*) - COUNT(c_name) AS c_name,
  COUNT(*) - COUNT(c_nationkey) AS c_nationkey, COUNT(*) - COUNT(c_acctbal) AS c_acctbal, COUNT(*) - COUNT(c_mktsegment) AS c_mktsegment,
  COUNT(*) - COUNT(o_orderkey) AS o_orderkey, COUNT(*) - COUNT(o_totalprice) AS o_totalprice FROM j)
UNPIVOT n ON COLUMNS(*) INTO NAME column_name VALUE null_count""")
def _(t):
    orders = t.orders.select(grouped().alias("group_key"), "o_orderkey", "o_totalprice")
    return A.null_counts(J.left_join(t.customer, orders, c("group_key") == c("c_custkey")).drop("group_key"))


@query("agg_14_first_last_dates", """
SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS most_recent_order, COUNT(o_orderkey) AS number_of_orders
FROM orders GROUP BY 1""")
def _(t):
    return A.group_agg(t.orders, ["o_custkey"], first_order=F.min("o_orderdate"),
                       most_recent_order=F.max("o_orderdate"), number_of_orders=F.count("o_orderkey"))


@query("agg_15_experiment_split", """
SELECT event_type, COUNT(DISTINCT CASE WHEN value >= 50 THEN user_id END) AS users_true,
       COUNT(DISTINCT CASE WHEN value < 50 THEN user_id END) AS users_false FROM events GROUP BY 1""")
def _(t):
    out = A.experiment_split(t.events, "event_type", {"users_true": c("value") >= 50, "users_false": c("value") < 50},
                             "user_id")
    return out


@query("agg_16_group_by_date_part", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS w, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3""")
def _(t):
    d = c("o_orderdate")
    return A.group_agg(t.orders, [F.year(d).alias("y"), F.month(d).alias("m"), F.weekofyear(d).alias("w")],
                       n=F.count("*"))


@query("agg_18_word_count", r"""
WITH w AS (SELECT trim(unnest(regexp_split_to_array(lower(text), '[ \t\n\r]+')), '.,!?;:''"()[]{}') AS word FROM documents)
SELECT word, COUNT(*) AS n FROM w WHERE word != '' GROUP BY 1""")
def _(t):
    return A.word_count(t.documents, "text", S.PUNCTUATION)


@query("agg_19_last_n_reasons", """
WITH a AS (SELECT user_id, ts, event_id, event_type AS reason, CAST(LEAST(value / 10000, 1) AS DECIMAL(18,6)) AS risk,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, COUNT(*) AS alert_count, CAST(SUM(risk) AS DOUBLE) AS total_risk, CAST(SUM(risk) AS DOUBLE) / COUNT(*) AS avg_risk,
  MAX(ts) AS last_alert_at, string_agg(CASE WHEN rn <= 5 THEN reason END, ' | ' ORDER BY ts, event_id) AS reasons
FROM a GROUP BY 1""")
def _(t):
    alerts = t.events.select("user_id", "ts", "event_id", c("event_type").alias("reason"),
                                                 S.risk_value(c("value")).alias("risk"))
    return A.last_n_reasons(alerts, "user_id", ["ts", "event_id"], "reason", "risk")


@query("agg_20_weighted_avg", f"""
SELECT l_partkey, CAST(SUM({DEC2('l_extendedprice')} * {DEC2('l_quantity')}) AS DOUBLE) / {dsum('l_quantity')} AS avg_price
FROM lineitem GROUP BY 1""")
def _(t):
    return A.group_agg(t.lineitem, ["l_partkey"], avg_price=A.weighted_avg(c("l_extendedprice"), c("l_quantity"), 2))


@query("agg_21_revenue_join_agg", f"""
SELECT p_type, p_brand, COUNT(*) AS n, {dsum('l_quantity')} AS units, {dsum('l_extendedprice')} AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def _(t):
    joined = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey"))
    return A.group_agg(joined, ["p_type", "p_brand"], n=F.count("*"), units=exact_sum("l_quantity", 2),
                       revenue=exact_sum("l_extendedprice", 2))


@query("agg_22_mode_by_group", """
WITH k AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT month, o_orderstatus, n FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY n DESC, o_orderstatus) AS rn FROM k) WHERE rn = 1""")
def _(t):
    monthly = t.orders.select(F.trunc("o_orderdate", "month").alias("month"), "o_orderstatus")
    return A.mode_by_group(monthly, ["month"], "o_orderstatus")


# ---- sort, limit

@query("srt_01_order_by", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def _(t):
    return R.order_by(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
                      c("o_orderpriority").asc(), c("o_totalprice").desc(), c("o_orderkey"))


@query("srt_02_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return R.top_n(t.orders.select("o_orderkey", "o_totalprice"), [c("o_totalprice").desc(), c("o_orderkey")], 20)


@query("srt_03_top_n_per_group", """
SELECT p_brand, p_partkey, p_retailprice, CAST(rn AS INTEGER) AS rn FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 3""")
def _(t):
    return R.top_n_per_group(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"],
                             [c("p_retailprice").desc(), c("p_partkey")], 3)


# ---- set operations

@query("set_01_union_all", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000""")
def _(t):
    a = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    b = t.orders.where("o_totalprice > 100000").select("o_totalprice", "o_orderkey")
    return R.union_all(a, b)


@query("set_02_union_distinct", """
SELECT n_nationkey AS nationkey FROM nation UNION SELECT c_nationkey FROM customer""")
def _(t):
    return R.union_distinct(t.nation.select(c("n_nationkey").alias("nationkey")),
                            t.customer.select(c("c_nationkey").alias("nationkey")))


@query("set_03_except_all", """
WITH b AS (SELECT o_orderkey, o_orderstatus FROM orders), x AS (SELECT o_orderkey,
  CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT *, 'left' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM x)
UNION ALL SELECT *, 'right' AS side FROM (SELECT * FROM x EXCEPT ALL SELECT * FROM b)""")
def _(t):
    a = t.orders.select("o_orderkey", "o_orderstatus")
    b = t.orders.select("o_orderkey", F.when(c("o_totalprice") > 400000, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"))
    return R.except_all(a, b)


@query("set_04_merge_heterogeneous", """
SELECT event_id AS id, CAST(user_id AS VARCHAR) AS user_ref, ts, event_type AS key, value >= 50 AS variation, NULL::BIGINT AS k
FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL SELECT event_id, CAST(user_id AS VARCHAR), ts, event_type, value >= 50, CAST(json_extract(props, '$.k') AS BIGINT)
FROM events WHERE ts >= TIMESTAMP '2024-01-15'""")
def _(t):
    old = t.events.where("ts < timestamp_ntz'2024-01-15 00:00:00'").select(
        c("event_id").alias("legacy_id"), c("user_id").cast("string").alias("usr"), c("ts").alias("created"),
        c("event_type").alias("name"), F.when(c("value") >= 50, "t").otherwise("f").alias("flag"))
    new = t.events.where("ts >= timestamp_ntz'2024-01-15 00:00:00'")
    return R.merge_heterogeneous([
        (old, {"id": c("legacy_id"), "user_ref": c("usr"), "ts": c("created"), "key": c("name"),
               "variation": S.bool_decode(c("flag"))}),
        (new, {"id": c("event_id"), "user_ref": c("user_id"), "ts": c("ts"), "key": c("event_type"),
               "variation": c("value") >= 50, "k": F.get_json_object("props", "$.k")})],
        {"id": "bigint", "user_ref": "string", "ts": "timestamp_ntz", "key": "string", "variation": "boolean",
         "k": "bigint"})
