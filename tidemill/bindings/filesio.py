"""Sources and sinks: every one writes or reads whole tables and is compared after a round trip."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import dsum
from tidemill.functions import scalar as S
from tidemill.functions.exact import exact_sum
from tidemill.operators import joins as J
from tidemill.sinks import files as K
from tidemill.sources import files as R
from tidemill.sources import increments as I

c = F.col
EVENT_DDL = "event_id bigint, user_id bigint, event_type string, valid boolean, created_at string, ingested_at string, step int, value double"


def event_records(events):
    """Events as eight-field log records with times as text."""
    late = F.make_dt_interval(secs=c("event_id") * 37 % 600)
    return events.select("event_id", "user_id", "event_type", (c("value") >= 50).alias("valid"),
                         c("ts").cast("string").alias("created_at"), (c("ts") + late).cast("string").alias("ingested_at"),
                         F.get_json_object("props", "$.k").cast("int").alias("step"), "value")


RECORDS = """SELECT event_id, user_id, event_type, value >= 50 AS valid, ts AS created_at,
 ts + (event_id * 37 % 600) * INTERVAL 1 SECOND AS ingested_at, CAST(json_extract(props, '$.k') AS INTEGER) AS step, value FROM events"""


@query("src_01_read_json_lines", RECORDS)
def _(t):
    path = t.scratch("jsonl")
    event_records(t.events).write.json(path)
    back = R.read_json_lines(t.spark, path, EVENT_DDL)
    return back.withColumns({x: c(x).cast("timestamp_ntz") for x in ("created_at", "ingested_at")})


CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_02_read_csv_typed", "SELECT * FROM customer")
def _(t):
    path = t.scratch("csv")
    K.write_csv(t.customer, path)
    return R.read_csv_typed(t.spark, path, CUSTOMER_DDL)


@query("src_03_read_csv_inferred", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = t.scratch("csv")
    K.write_csv(t.customer, path)
    return R.read_csv_inferred(t.spark, path)


@query("src_04_inline_table", """
SELECT metric_id, metric_name, COUNT(*) AS n FROM events JOIN (VALUES (0, 'Loss', 'error'), (1, 'Accuracy', 'purchase'))
v(metric_id, metric_name, kind) ON event_type = kind GROUP BY 1, 2""")
def _(t):
    lookup = R.inline_table(t.spark, [(0, "Loss", ["error"]), (1, "Accuracy", ["purchase"])],
                            "metric_id int, metric_name string, kinds array<string>")
    kinds = lookup.select("metric_id", "metric_name", F.explode("kinds").alias("event_type"))
    return t.events.join(F.broadcast(kinds), "event_type").groupBy("metric_id", "metric_name").agg(F.count("*").alias("n"))


@query("src_05_read_parquet_cols", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate FROM lineitem""")
def _(t):
    return R.read_parquet_cols(t.spark, t.path("lineitem"), [
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"])


@query("src_06_read_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    path = t.scratch("by_status")
    K.write_partitioned(t.orders, path, ["o_orderstatus"])
    return R.read_partitioned(t.spark, path, c("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("src_07_load_seed", """
SELECT n_nationkey, n_name, COUNT(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def _(t):
    path = t.scratch("seed")
    K.write_csv(t.nation, path)
    seed = R.load_seed(t.spark, path, "n_nationkey int, n_name string, n_regionkey int", ["n_nationkey"])
    return t.customer.join(seed, c("c_nationkey") == c("n_nationkey")).groupBy("n_nationkey", "n_name").agg(
        F.count("*").alias("customers"))


@query("src_09_read_increment", """
WITH m AS (SELECT MAX(o_orderdate) AS ts FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30'),
i AS (SELECT MAX(o_orderkey) AS id FROM orders, m WHERE o_orderdate = m.ts)
SELECT 'incrementing' AS mode, o_orderkey FROM orders, i WHERE o_orderkey > i.id
UNION ALL SELECT 'timestamp', o_orderkey FROM orders, m WHERE o_orderdate > m.ts
UNION ALL SELECT 'timestamp+incrementing', o_orderkey FROM orders, m, i WHERE o_orderdate > m.ts OR (o_orderdate = m.ts AND o_orderkey > i.id)
UNION ALL SELECT 'bulk', o_orderkey FROM orders""")
def _(t):
    seen = t.orders.where("o_orderdate <= timestamp_ntz'1999-06-30 00:00:00'")
    state = I.high_water(seen, "o_orderkey", "o_orderdate")
    parts = [I.read_increment(t.orders, m, "o_orderkey", "o_orderdate", state).select(F.lit(m).alias("mode"), "o_orderkey")
             for m in I.MODES]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("src_12_read_csv_format", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def _(t):
    path = t.scratch("format")
    text = t.customer.select("c_custkey", F.when(c("c_acctbal") < 0, "null").otherwise(c("c_acctbal").cast("string")).alias("c_acctbal"),
                             F.when(c("c_mktsegment") == "BUILDING", "NULL").when(c("c_mktsegment") == "MACHINERY", "")
                             .otherwise(c("c_mktsegment")).alias("c_mktsegment"))
    K.write_csv(text, path, quote_all=True)
    schema = T.StructType.fromDDL("c_custkey bigint, c_acctbal double, c_mktsegment string")
    return R.read_csv_format(t.spark, path, schema)


@query("src_13_with_lineage", """
SELECT o_orderkey, o_orderstatus, 'load-1' AS load_id, true AS has_file, true AS in_order FROM orders""")
def _(t):
    """Files are written in order of their keys, so a row's number is the rank of its key in the file."""
    path = t.scratch("lineage")
    K.write_csv(t.orders.select("o_orderkey", "o_orderstatus").repartition(4).sortWithinPartitions("o_orderkey"), path)
    rows = R.with_lineage(R.read_csv_typed(t.spark, path, "o_orderkey bigint, o_orderstatus string"), "load-1")
    rank = F.row_number().over(Window.partitionBy("source_file").orderBy("o_orderkey"))
    return rows.select("o_orderkey", "o_orderstatus", "load_id", c("source_file").endswith(".csv").alias("has_file"), (c("row_number") == rank).alias("in_order"))


@query("src_14_flatten_api_json", """
SELECT c_custkey AS id, c_name AS title, n_name AS location, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS company,
  CASE WHEN c_acctbal < 1000 THEN NULL ELSE r_name END AS category
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    rows = J.star_join(t.customer, [(t.nation, c("c_nationkey") == c("n_nationkey")), (t.region, c("n_regionkey") == c("r_regionkey"))])
    nested = rows.select(c("c_custkey").alias("id"), c("c_name").alias("title"),
                         F.struct(c("n_name").alias("display_name")).alias("location"),
                         F.when(c("c_acctbal") >= 0, F.struct(c("c_mktsegment").alias("display_name"))).alias("company"),
                         F.when(c("c_acctbal") >= 1000, F.struct(c("r_name").alias("label"))).alias("category"))
    path = t.scratch("nested")
    nested.write.json(path)
    back = R.read_json_lines(t.spark, path, nested.schema)
    return R.flatten_api_json(back, {"id": "id", "title": "title", "location": "location.display_name",
                                     "company": "company.display_name", "category": "category.label"})


@query("src_15_read_evolved", """
SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'unknown' ELSE 'user-' || user_id END AS device_type,
  CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'ADJUSTMENT' ELSE upper(event_type) END AS update_type,
  CASE WHEN ts < TIMESTAMP '2024-01-20' THEN NULL ELSE value END AS reading FROM events""")
def _(t):
    ev, root = t.events, t.scratch("evolved")
    first, second = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    device = F.concat(F.lit("user-"), c("user_id")).alias("device_type")
    v1 = ev.where(c("ts") < first).select("event_id", "event_type")
    v2 = ev.where((c("ts") >= first) & (c("ts") < second)).select("event_id", "event_type", device)
    v3 = ev.where(c("ts") >= second).select("event_id", "event_type", device, F.upper("event_type").alias("update_type"),
                                            c("value").alias("reading"))
    for name, df in (("v1", v1), ("v2", v2), ("v3", v3)):
        df.write.json(f"{root}/{name}")
    read = [R.read_json_lines(t.spark, f"{root}/{n}", d.schema) for n, d in (("v1", v1), ("v2", v2), ("v3", v3))]
    return R.read_evolved(read, v3.schema, {"device_type": "unknown", "update_type": "ADJUSTMENT"})


# ---- sinks

@query("snk_01_write_partitioned", "SELECT p_partkey, p_brand, p_type FROM part")
def _(t):
    path = t.scratch("by_type")
    K.write_partitioned(t.part.select("p_partkey", "p_brand", "p_type"), path, ["p_type"])
    return t.spark.read.parquet(path)


@query("snk_02_write_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = t.scratch("quoted")
    K.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path, quote_all=True)
    return R.read_csv_typed(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("snk_03_convert_format", "SELECT * FROM supplier")
def _(t):
    src, dst = t.scratch("supplier_csv"), t.scratch("supplier_parquet")
    K.write_csv(t.supplier, src)
    K.convert_format(t.spark, src, dst, t.supplier.schema)
    return t.spark.read.parquet(dst)


@query("snk_04_ctas_view", f"""
SELECT o_orderstatus, COUNT(*) AS n, {dsum('o_totalprice')} AS total FROM orders GROUP BY 1""")
def _(t):
    made = K.ctas(t.spark, "tm_status_totals", "SELECT o_orderstatus, count(*) AS n, "
                  "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM tm_orders GROUP BY o_orderstatus",
                  t.scratch("ctas"), tm_orders=t.orders)
    return K.create_view(made, "tm_status_view")


@query("snk_05_write_clustered", """
SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01' AND o_orderpriority = '1-URGENT'""")
def _(t):
    path = t.scratch("clustered")
    K.write_clustered(t.orders, path, F.date_format("o_orderdate", "yyyy-MM"), "month", ["o_orderpriority", "o_orderkey"])
    return t.spark.read.parquet(path).where(
        "month BETWEEN '1997-03' AND '1997-05' AND o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_orderpriority", "o_orderdate")


@query("snk_10_route_by_topic", """
SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS topic, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def _(t):
    path = t.scratch("topics")
    K.route_by_topic(t.events, S.day_suffix(c("event_type"), c("ts")), path)
    return t.spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("snk_11_external_table", f"""
SELECT s_nationkey, COUNT(*) AS n, {dsum('s_acctbal')} AS balance FROM supplier GROUP BY 1""")
def _(t):
    path = t.scratch("external")
    t.supplier.write.parquet(path)
    return K.external_table(t.spark, "tm_supplier_ext", path).groupBy("s_nationkey").agg(
        F.count("*").alias("n"), exact_sum("s_acctbal", 2).alias("balance"))


@query("snk_05_write_zordered", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 110000
UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-31'""")
def _(t):
    """Orders clustered by date and price together; a filter on either skips files."""
    path = t.scratch("zordered")
    K.write_zordered(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), path, ["o_orderdate", "o_totalprice"], 16)
    rows = t.spark.read.parquet(path)
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    return rows.where(c("o_totalprice").between(100000, 110000)).unionByName(
        rows.where(c("o_orderdate").between(day("1998-01-01 00:00:00"), day("1998-01-31 00:00:00"))))
