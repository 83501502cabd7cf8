"""Incremental loads, slowly changing dimensions, bulk loads and warehouse models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import dsum
from tidemill.functions.exact import exact_sum
from tidemill.operators import incremental as N
from tidemill.operators import joins as J
from tidemill.operators import ordered as O
from tidemill.operators.summaries import RetractableSummary
from tidemill.operators.versioned import VersionedTable
from tidemill.plans import warehouse as H
from tidemill.sinks import files as K
from tidemill.sources import bulkload as B
from tidemill.sources import files as R
from tidemill.sources import increments as I

c = F.col


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


Y1999, Y2000 = "1999-01-01 00:00:00", "2000-01-01 00:00:00"


@query("inc_01_watermark_table", """
WITH p AS (SELECT o_orderstatus AS pipeline_name, MAX(o_orderdate) AS last_ts FROM orders GROUP BY 1)
SELECT pipeline_name, last_ts, MAX(o_orderkey) AS last_id FROM p JOIN orders ON o_orderstatus = pipeline_name AND o_orderdate = last_ts GROUP BY 1, 2""")
def _(t):
    log = N.WatermarkLog(t.spark, t.scratch("marks"))
    for status in ("F", "O", "P"):
        part = t.orders.where(c("o_orderstatus") == status)
        for cut in (Y1999, "2100-01-01 00:00:00"):
            marks = I.high_water(part.where(c("o_orderdate") < ntz(cut)), "o_orderkey", "o_orderdate")
            now = dt.datetime.now(dt.timezone.utc)
            log.append(status, marks["max_id"], marks["max_ts"], now, now, "orders", "orders_copy")
    newest = log.read().groupBy("pipeline_name").agg(F.max_by(F.struct("last_ts", "last_id"), F.col("last_ts")).alias("m"))
    return newest.select("pipeline_name", "m.last_ts", "m.last_id")


COLS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


@query("inc_02_merge_partitions", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def _(t):
    path = t.scratch("by_year")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    K.write_partitioned(rows.where("year < 2000"), path, ["year"])
    N.merge_partitions(path, rows.where("year >= 1999").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"], "year")
    return t.spark.read.schema(rows.schema).parquet(path)


def _base(t):
    return t.orders.where(c("o_orderdate") < ntz(Y2000)).select(*COLS)


def _delta(t):
    """Everything since 1999, with status X where the price is high."""
    return t.orders.where(c("o_orderdate") >= ntz(Y1999)).select(
        "o_orderkey", F.when(c("o_totalprice") > 250000, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")


MERGED = """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END
 AS o_orderstatus, o_totalprice{} FROM orders"""


@query("inc_02_merge_upsert", MERGED.format(", CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'run-2' ELSE 'run-1' END AS etl_run"))
def _(t):
    table = VersionedTable(t.spark, t.scratch("upsert"))
    table.write(_base(t).withColumn("etl_run", F.lit("run-1")))
    table.write(N.merge_upsert(table.read(), _delta(t), ["o_orderkey"], {"etl_run": F.lit("run-2")}))
    return table.read()


@query("inc_03_merge_when_changed", MERGED.format(""", CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' OR (o_orderdate >= TIMESTAMP '1999-01-01'
 AND o_totalprice > 250000) THEN 'run-2' ELSE 'run-1' END AS etl_run, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'insert'
 WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_totalprice > 250000 THEN 'update' ELSE 'keep' END AS merge_action"""))
def _(t):
    target = _base(t).withColumn("etl_run", F.lit("run-1"))
    return N.merge_when_changed(target, _delta(t), ["o_orderkey"], ["o_orderstatus", "o_totalprice"], {"etl_run": F.lit("run-2")})


@query("inc_04_merge_soft_delete", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal, c_mktsegment = 'FURNITURE' AS is_deleted,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN TIMESTAMP '2024-06-01' END AS deleted_ts FROM customer
WHERE c_mktsegment != 'FURNITURE' OR c_acctbal > 0""")
def _(t):
    target = t.customer.where("c_acctbal > 0").select(
        "c_custkey", "c_acctbal", (c("c_mktsegment") == "MACHINERY").alias("is_deleted"),
        F.when(c("c_mktsegment") == "MACHINERY", ntz("2024-01-01 00:00:00")).alias("deleted_ts"))
    source = t.customer.where("c_mktsegment != 'FURNITURE'").select("c_custkey", (c("c_acctbal") + 1).alias("c_acctbal"))
    return N.merge_soft_delete(target, source, "c_custkey", ntz("2024-06-01 00:00:00"))


@query("inc_05_insert_new_only", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice FROM orders""")
def _(t):
    return N.insert_new_only(_base(t), _delta(t), ["o_orderkey"])


@query("inc_06_incremental_by_time_range", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice ELSE 0 END AS amount, strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def _(t):
    path = t.scratch("by_month")
    month = F.date_format("o_orderdate", "yyyy-MM")
    rows = t.orders.select("o_orderkey", c("o_totalprice").alias("amount"), "o_orderdate")
    K.write_partitioned(rows.withColumn("amount", F.lit(0.0)).withColumn("month", month), path, ["month"])
    for _ in range(2):  # the second run must change nothing
        N.replace_time_range(rows, path, "o_orderdate", ntz("1997-01-01 00:00:00"), ntz("1997-12-31 23:59:59"), "month", month)
    # month is a string everywhere: directory values such as 1997-01 are not left to inference
    schema = T.StructType([*rows.schema.fields, T.StructField("month", T.StringType())])
    return t.spark.read.schema(schema).parquet(path).drop("o_orderdate")


@query("inc_07_strategies", f"""
WITH d AS (SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END AS st, o_totalprice AS p FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01'), b AS (SELECT o_orderkey, o_orderstatus AS st, o_totalprice AS p FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
k AS (SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d)),
u AS (SELECT 'append' AS strategy, * FROM b UNION ALL SELECT 'append', * FROM d UNION ALL SELECT 'merge', * FROM k UNION ALL SELECT 'merge', * FROM d
  UNION ALL SELECT 'delete+insert', * FROM k UNION ALL SELECT 'delete+insert', * FROM d)
SELECT strategy, st AS o_orderstatus, COUNT(*) AS n, {dsum('p')} AS total FROM u GROUP BY 1, 2""")
def _(t):
    parts = [N.apply_strategy(s, _base(t), _delta(t), ["o_orderkey"]).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), exact_sum("o_totalprice", 2).alias("total")).withColumn("strategy", F.lit(s)) for s in N.STRATEGIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("inc_08_full_refresh", "SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS num_orders FROM orders GROUP BY 1")
def _(t):
    path = t.scratch("model")
    N.full_refresh(t.orders.groupBy("o_custkey").agg(F.lit(0).cast("long").alias("num_orders")), path)
    return N.full_refresh(t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderkey").alias("num_orders")), path)


def _parts(t):
    return t.part.select("p_partkey", "p_brand", "p_retailprice")


def _part_changes(t):
    return t.part.where("p_size > 25").select(
        "p_partkey", F.when(c("p_type") == "PROMO", "Brand#promo").otherwise(c("p_brand")).alias("p_brand"), "p_retailprice")


@query("inc_09_scd1", """
SELECT p_partkey, CASE WHEN p_size > 25 AND p_type = 'PROMO' THEN 'Brand#promo' ELSE p_brand END AS p_brand, p_retailprice FROM part
WHERE p_type != 'SMALL' OR p_size > 25""")
def _(t):
    base = t.part.where("p_type != 'SMALL'").select("p_partkey", "p_brand", "p_retailprice")
    return N.scd1(base, _part_changes(t), ["p_partkey"])


@query("inc_10_scd2", """
SELECT p_partkey, p_brand, p_retailprice, TIMESTAMP '2024-01-01' AS valid_from,
  CASE WHEN p_size > 25 AND p_type = 'PROMO' THEN TIMESTAMP '2024-06-01' END AS valid_to, NOT (p_size > 25 AND p_type = 'PROMO') AS is_current
FROM part WHERE p_type != 'SMALL'
UNION ALL SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'Brand#promo' ELSE p_brand END, p_retailprice, TIMESTAMP '2024-06-01', NULL, true
FROM part WHERE p_size > 25 AND p_type IN ('PROMO', 'SMALL')""")
def _(t):
    dim = t.part.where("p_type != 'SMALL'").select(
        "p_partkey", "p_brand", "p_retailprice", ntz("2024-01-01 00:00:00").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    return N.scd2_apply(dim, _part_changes(t), "p_partkey", ["p_brand", "p_retailprice"], ntz("2024-06-01 00:00:00"))


HISTORY = """h0 AS (SELECT user_id, event_type AS grp, ts, event_id, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
h AS (SELECT user_id, grp, ts AS valid_from, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM h0 WHERE p IS DISTINCT FROM grp)"""


@query("inc_10_scd2_history", f"WITH {HISTORY} SELECT user_id, grp, valid_from, valid_to, valid_to IS NULL AS is_current FROM h")
def _(t):
    log = t.events.select("user_id", c("event_type").alias("grp"), "ts", "event_id")
    return N.scd2_history(log, "user_id", ["grp"], "ts", "event_id")


@query("inc_10_scd2_fact_lookup", f"""
WITH {HISTORY} SELECT o_orderpriority, grp, COUNT(*) AS n FROM
(SELECT o_orderpriority, o_custkey, o_orderdate + INTERVAL 10000 DAY AS sold_at FROM orders) o
LEFT JOIN h ON o_custkey = user_id AND sold_at >= valid_from AND (valid_to IS NULL OR sold_at < valid_to) GROUP BY 1, 2""")
def _(t):
    log = t.events.select("user_id", c("event_type").alias("grp"), "ts", "event_id")
    history = N.scd2_history(log, "user_id", ["grp"], "ts", "event_id")
    shifted = t.orders.select("o_orderkey", "o_orderpriority", "o_custkey", (c("o_orderdate") + F.expr("INTERVAL 10000 DAYS")).alias("sold_at"))
    return N.scd2_lookup(shifted, history, "o_custkey", "sold_at", "o_orderkey", "user_id", ["grp"]).groupBy("o_orderpriority", "grp").agg(F.count("*").alias("n"))


@query("inc_11_dedup_by_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return N.dedup_by_key(rows, ["l_orderkey", "l_linenumber"], [c("l_shipdate").desc(), c("l_partkey"), c("l_suppkey")]).drop("l_suppkey")


# ---- bulk load: one file per market segment, with bad values

USERS = T.StructType([
    T.StructField("c_custkey", T.LongType(), False), T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("is_active", T.BooleanType()),
    T.StructField("created", T.DateType())])
BAD = """u AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment AS seg, c_nationkey = 3 AND c_mktsegment != 'BUILDING' AS bad_flag,
 c_acctbal < -900 AND c_mktsegment != 'BUILDING' AS bad_date FROM customer)"""


def _user_files(t):
    """CSV files by segment; segment BUILDING is clean. Returns the folder."""
    path = t.scratch("users")
    dirty = c("c_mktsegment") != "BUILDING"
    rows = t.customer.select(
        "c_custkey", "c_name", c("c_acctbal").cast("string").alias("c_acctbal"),
        F.when((c("c_nationkey") == 3) & dirty, "MAYBE").when(c("c_acctbal") > 5000, "1").otherwise("FALSE").alias("is_active"),
        F.when((c("c_acctbal") < -900) & dirty, "15/04/2023 13:10:07").otherwise("2023-04-15").alias("created"),
        c("c_mktsegment").alias("segment"))
    rows.hint("rebalance", c("segment")).write.partitionBy("segment").option("header", True).csv(path)
    return path


def _segment(col="source_file"):
    return F.regexp_extract(col, "segment=([A-Z]+)", 1).alias("segment")


@query("inc_12_copy_into", f"""
WITH {BAD} SELECT c_custkey, c_name, c_acctbal, c_acctbal > 5000 AS is_active, DATE '2023-04-15' AS created FROM u WHERE NOT bad_flag AND NOT bad_date""")
def _(t):
    path, table, ledger = _user_files(t), t.scratch("users_table"), t.scratch("users_ledger")
    B.copy_into(t.spark, path, table, ledger, USERS, on_error="CONTINUE", load_id="first")
    B.copy_into(t.spark, path, table, ledger, USERS, on_error="CONTINUE", load_id="second")  # loads nothing
    return t.spark.read.parquet(table).select(*[f.name for f in USERS.fields])


REJECTS = f"""WITH {BAD} SELECT seg AS segment, 'is_active' AS column_name, 'MAYBE' AS value, 'boolean' AS expected, COUNT(*) AS n
FROM u WHERE bad_flag GROUP BY 1 UNION ALL SELECT seg, 'created', '15/04/2023 13:10:07', 'date', COUNT(*) FROM u WHERE bad_date GROUP BY 1"""


@query("inc_13_validate_load", REJECTS)
def _(t):
    errors = B.validate_load(t.spark, _user_files(t), USERS)
    return errors.groupBy(_segment(), "column_name", "value", "expected").agg(F.count("*").alias("n"))


@query("inc_14_rejected_rows", REJECTS)
def _(t):
    path, table = _user_files(t), t.scratch("users_table")
    B.copy_into(t.spark, path, table, t.scratch("users_ledger"), USERS, on_error="CONTINUE")
    return t.spark.read.parquet(f"{table}_rejects").groupBy(_segment(), "column_name", "value", "expected").agg(F.count("*").alias("n"))


@query("inc_15_load_history", f"""
WITH {BAD}, s AS (SELECT seg AS segment, COUNT(*) AS parsed, COUNT(*) FILTER (NOT bad_flag AND NOT bad_date) AS loaded, COUNT(*) FILTER (bad_flag OR bad_date) AS errors FROM u GROUP BY 1)
SELECT 'first' AS load_id, segment, parsed, loaded, errors, CASE WHEN errors = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status FROM s
UNION ALL SELECT 'again', segment, 0, 0, 0, 'LOAD_SKIPPED' FROM s""")
def _(t):
    path, table, ledger = _user_files(t), t.scratch("users_table"), t.scratch("users_ledger")
    first = B.copy_into(t.spark, path, table, ledger, USERS, on_error="CONTINUE", load_id="first")
    again = B.copy_into(t.spark, path, table, ledger, USERS, on_error="CONTINUE", load_id="again")
    return first.unionByName(again).select("load_id", _segment("file"), "parsed", "loaded", "errors", "status")


@query("inc_16_bronze_to_silver", """
SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END AS c_nationkey, 'second' AS load_id FROM customer""")
def _(t):
    raw = t.customer.select(c("c_custkey").cast("string").alias("c_custkey"), "c_name", c("c_acctbal").cast("string").alias("c_acctbal"),
                            F.when(c("c_nationkey") == 3, "n/a").otherwise(c("c_nationkey").cast("string")).alias("c_nationkey"))
    bronze = raw.withColumn("load_id", F.lit("first")).unionByName(raw.withColumn("load_id", F.lit("second")))
    return B.bronze_to_silver(bronze, {"c_custkey": "bigint", "c_acctbal": "double", "c_nationkey": "int"}, ["c_custkey"], [c("load_id").desc()])


@query("inc_17_staging_model", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice / 100 AS amount, CAST(o_orderdate AS DATE) AS ordered_on FROM orders""")
def _(t):
    return H.staging_model(t.orders, {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount", "o_orderdate": "ordered_on"},
                           cents=["amount"], casts={"ordered_on": "date"})


@query("inc_18_dim_customers", """
WITH o AS (SELECT o_custkey - o_custkey % 3 AS o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS most_recent_order,
  COUNT(o_orderkey) AS number_of_orders FROM orders GROUP BY 1)
SELECT c_custkey, c_name, first_order, most_recent_order, COALESCE(number_of_orders, 0) AS number_of_orders FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def _(t):
    grouped = t.orders.withColumn("payer", c("o_custkey") - c("o_custkey") % 3)  # one of three customers pays for all
    return H.dim_customers(t.customer.select("c_custkey", "c_name"), grouped, "c_custkey", "payer", "o_orderdate", "o_orderkey")


@query("inc_19_fct_orders", f"""
WITH p AS (SELECT l_orderkey, {dsum("CASE WHEN l_returnflag = 'N' THEN l_extendedprice END")} AS amount FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, COALESCE(amount, 0) AS amount FROM orders LEFT JOIN p ON l_orderkey = o_orderkey""")
def _(t):
    return H.fct_orders(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, "o_orderkey", "l_orderkey", "l_extendedprice",
                        c("l_returnflag") == "N")


@query("inc_20_star_schema", f"""
SELECT p_brand, c_mktsegment, n_name, l_returnflag, COUNT(*) AS n, {dsum('l_extendedprice')} AS sales FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4""")
def _(t):
    sales = J.star_join(t.lineitem, [(t.part, c("l_partkey") == c("p_partkey")), (t.orders, c("l_orderkey") == c("o_orderkey")),
                                     (t.customer, c("o_custkey") == c("c_custkey")), (t.nation, c("c_nationkey") == c("n_nationkey"))])
    dims = {"product": (t.part, ["p_brand", "p_type"]), "customer": (t.customer, ["c_custkey", "c_mktsegment"]),
            "geo": (t.nation, ["n_name"]), "shipping": (t.lineitem, ["l_linestatus", "l_returnflag"])}
    star = H.star_schema(sales, dims, ["l_extendedprice", "l_quantity"])
    fact = star["fct_sales"]
    for name in dims:
        fact = fact.join(star[name], f"{name}_key")
    return fact.groupBy("p_brand", "c_mktsegment", "n_name", "l_returnflag").agg(
        F.count("*").alias("n"), exact_sum("l_extendedprice", 2).alias("sales"))


@query("inc_21_calendar_dim", """
WITH cal AS (SELECT CAST(unnest(generate_series((SELECT MIN(o_orderdate) FROM orders), (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, year(day)::INTEGER AS year, quarter(day)::INTEGER AS quarter, month(day)::INTEGER AS month, weekofyear(day)::INTEGER AS week,
  dayofmonth(day)::INTEGER AS day_of_month, (isodow(day) - 1)::INTEGER AS weekday FROM cal""")
def _(t):
    return J.calendar_over(t.orders, "o_orderdate")


@query("inc_22_materialized_summary", f"""
SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS orders, {dsum('o_totalprice')} AS amount FROM orders GROUP BY 1""")
def _(t):
    sums = {"orders": F.lit(1), "amount": c("o_totalprice").cast("decimal(18,2)")}
    table = VersionedTable(t.spark, t.scratch("summary"))
    edges = [None, "1997-01-01 00:00:00", Y1999, None]
    for lo, hi in zip(edges, edges[1:]):
        batch = t.orders
        batch = batch if lo is None else batch.where(c("o_orderdate") >= ntz(lo))
        batch = batch if hi is None else batch.where(c("o_orderdate") < ntz(hi))
        delta = N.summary_delta(batch, ["o_custkey"], sums)
        table.write(N.summary_merge(table.read(), delta, ["o_custkey"], list(sums)) if table.exists() else delta)
    return table.read().withColumn("amount", c("amount").cast("double"))


def _signed(df, sign):
    return df.withColumn("sign", F.lit(sign))


@query("inc_22_summary_with_deletes", f"""
WITH o AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1999-01-01' THEN o_custkey % 10 ELSE o_custkey END AS o_custkey, o_orderstatus,
 CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1999-01-01' THEN o_totalprice + 100 ELSE o_totalprice END AS price FROM orders WHERE o_orderpriority != '5-LOW')
SELECT o_custkey, COUNT(*) AS n, {dsum('price')} AS amount, MIN(price) AS min_price, MAX(price) AS max_price, COUNT(DISTINCT price) AS distinct_price,
 COUNT(DISTINCT o_orderstatus) AS distinct_o_orderstatus FROM o GROUP BY 1""")
def _(t):
    """Orders come in two batches; the second also moves urgent ones to other customers at other prices, the third deletes the low ones."""
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", c("o_totalprice").alias("price"))
    early, urgent = rows.where(c("o_orderdate") < ntz(Y1999)), c("o_orderpriority") == "1-URGENT"
    moved = early.where(urgent).withColumn("o_custkey", c("o_custkey") % 10).withColumn("price", c("price") + 100)
    low = rows.where("o_orderpriority = '5-LOW'")
    summary = RetractableSummary(t.spark, t.scratch("summary"), ["o_custkey"], {"amount": c("price").cast("decimal(18,2)")}, ["price", "o_orderstatus"], 2)
    summary.apply(_signed(early, 1), "b1")
    for _ in range(2):  # the second time changes nothing
        summary.apply(_signed(rows.where(c("o_orderdate") >= ntz(Y1999)), 1).unionByName(_signed(early.where(urgent), -1)).unionByName(_signed(moved, 1)), "b2")
    summary.apply(_signed(low, -1), "b3")
    return summary.read().select("o_custkey", "n", c("amount").cast("double").alias("amount"), "min_price", "max_price", "distinct_price", "distinct_o_orderstatus")


@query("inc_23_run_incremental", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(t):
    table, log = VersionedTable(t.spark, t.scratch("orders_copy"), ["o_orderkey"]), N.WatermarkLog(t.spark, t.scratch("marks"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    for cut in ("1997-01-01 00:00:00", Y2000, "2100-01-01 00:00:00", "2100-01-01 00:00:00"):
        N.run_incremental(rows.where(c("o_orderdate") < ntz(cut)), table, log, "orders", "o_orderkey", "o_orderdate")
    return table.read()
