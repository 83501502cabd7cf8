"""Scalar functions, record transforms and user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import DEC2, dsum
from tidemill.functions import records as X
from tidemill.functions import scalar as S
from tidemill.functions import udfs as U
from tidemill.functions.exact import exact_sum
from tidemill.operators import joins as J

c = F.col


@query("fun_01_parse_ts", """
SELECT o_orderkey, o_orderdate AS from_iso, date_trunc('day', o_orderdate) AS from_us_date, o_orderdate AS from_us_stamp FROM orders""")
def _(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", S.ISO_SECONDS).alias("iso"),
                           F.date_format("o_orderdate", S.US_DATE).alias("us"),
                           F.date_format("o_orderdate", S.US_STAMP).alias("stamp"))
    return text.select("o_orderkey", S.parse_ts(c("iso"), S.ISO_SECONDS).alias("from_iso"),
                       S.parse_ts(c("us"), S.ISO_SECONDS, S.US_DATE).alias("from_us_date"),
                       S.parse_ts(c("stamp"), S.US_STAMP).alias("from_us_stamp"))


@query("fun_02_coerce_ts", """
SELECT event_id, CASE event_type WHEN 'view' THEN date_trunc('millisecond', ts) WHEN 'click' THEN date_trunc('second', ts)
  WHEN 'signup' THEN date_trunc('day', ts) WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)
    WHEN 1 THEN date_trunc('second', ts) ELSE date_trunc('millisecond', ts) END
  WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '1970-01-01' - INTERVAL 1 SECOND * event_id END END AS at FROM events""")
def _(t):
    kind, ts = c("event_type"), c("ts")
    raw = (F.when(kind == "view", F.unix_millis(ts.cast("timestamp")).cast("string"))
           .when(kind == "click", F.date_format(ts, S.ISO_SECONDS)).when(kind == "signup", F.date_format(ts, S.US_DATE))
           .when((kind == "purchase") & (c("event_id") % 3 == 0), F.date_format(ts, S.US_STAMP))
           .when((kind == "purchase") & (c("event_id") % 3 == 1), F.date_format(ts, S.PLAIN_SECONDS))
           .when(kind == "purchase", F.date_format(ts, S.ISO_FRACTION))
           .when(c("event_id") % 2 == 0, (c("event_id") * -1000).cast("string")).otherwise("not a time"))
    return t.events.select("event_id", raw.alias("raw")).select(
        "event_id", S.coerce_ts(c("raw"), S.ISO_SECONDS, S.US_DATE, S.US_STAMP, S.PLAIN_SECONDS, S.ISO_FRACTION).alias("at"))


@query("fun_03_date_diff_days", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days,
  date_trunc('month', o_orderdate)::DATE AS order_month, date_trunc('week', o_orderdate)::DATE AS order_week,
  date_trunc('quarter', o_orderdate)::DATE AS order_quarter, date_trunc('year', o_orderdate)::DATE AS order_year
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    joined = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey",
                         S.date_diff_days(c("l_shipdate"), c("o_orderdate")).alias("days"),
                         *[F.trunc("o_orderdate", p).alias(f"order_{p}") for p in ("month", "week", "quarter", "year")])


@query("fun_04_duration_minutes", """
SELECT user_id, (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(60000000 AS DOUBLE) AS minutes FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy("user_id").agg(S.duration_minutes(F.min("ts"), F.max("ts")).alias("minutes"))


@query("fun_05_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS w, CAST(o_orderdate AS DATE) AS d FROM orders""")
def _(t):
    d = c("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.weekofyear(d).alias("w"),
                           F.to_date(d).alias("d"))


@query("fun_06_format_day_suffix", "SELECT event_id, event_type || '-' || strftime(ts, '%Y%m%d') AS topic FROM events")
def _(t):
    return t.events.select("event_id", S.day_suffix(c("event_type"), c("ts")).alias("topic"))


@query("fun_07_current_ts_columns", """SELECT COUNT(*) AS n, COUNT(*) AS stamped, COUNT(*) AS dated, CAST(1 AS BIGINT) AS stamps FROM orders""")
def _(t):
    loaded = t.orders.select("*", F.current_timestamp().alias("loaded_at"), F.current_date().alias("load_date"))
    # what can be said of a clock: every row has one and the same stamp, and its date is the load date
    return loaded.agg(F.count("*").alias("n"), F.count("loaded_at").alias("stamped"),
                      F.count_if(c("loaded_at").cast("date") == c("load_date")).alias("dated"), F.count_distinct("loaded_at").alias("stamps"))


@query("fun_08_concat_name", """
SELECT c_custkey, c_mktsegment || ' ' || n_name AS full_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    return t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select(
        "c_custkey", S.concat_name(c("c_mktsegment"), c("n_name")).alias("full_name"))


@query("fun_09_text_stats", r"""
SELECT doc_id, md5(upper(replace(text, 'ß', 'ss'))) AS upper_digest, length(text)::INTEGER AS chars,
  CASE WHEN trim(text, E' \t\n\r') = '' THEN 0 ELSE len(regexp_split_to_array(trim(text, E' \t\n\r'), '[ \t\n\r]+')) END::INTEGER AS words
FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(F.upper("text")).alias("upper_digest"),
                              F.length("text").alias("chars"), S.count_words(c("text")).alias("words"))


EMAIL = "lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example'"
MASKED = f"SELECT c_custkey, substr({EMAIL}, 1, 1) || '***@' || lower(c_mktsegment) || '.example' AS masked FROM customer"


def _emails(t):
    return t.customer.select("c_custkey", F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                                                   F.lower("c_mktsegment"), F.lit(".example")).alias("email"))


@query("fun_10_mask_email", MASKED)
def _(t):
    return _emails(t).select("c_custkey", S.mask_email(c("email")).alias("masked"))


@query("fun_11_regex_route", """
SELECT event_id, 'company-' || event_type || '-data' AS topic FROM events""")
def _(t):
    return t.events.select("event_id", S.regex_route(F.concat(F.lit("mysql-"), "event_type"), "^mysql-(.*)$",
                                                     "company-$1-data").alias("topic"))


@query("fun_12_surrogate_key", """
SELECT l_orderkey, l_linenumber, l_partkey, md5(concat_ws(',', length(l_orderkey::VARCHAR) || ':' || l_orderkey, length(l_partkey::VARCHAR) || ':' || l_partkey,
  length(l_linenumber::VARCHAR) || ':' || l_linenumber, COALESCE('1:' || NULLIF(l_returnflag, 'N'), '-'))) AS sk FROM lineitem""")
def _(t):
    flag = F.nullif("l_returnflag", F.lit("N"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.surrogate_key(
        c("l_orderkey"), c("l_partkey"), c("l_linenumber"), flag).alias("sk"))


def hex_mod_sql(digest: str, n: int, digits: int) -> str:
    out = "0::BIGINT"
    for start in range(1, digits, 8):
        out = f"(({out} * 4294967296 + ('0x' || substr({digest}, {start}, 8))::BIGINT) % {n})"
    return out


@query("fun_13_hash_partition", f"""
SELECT event_id, user_id, ({hex_mod_sql('s', 6, 64)})::INTEGER AS p_sha, ({hex_mod_sql('m', 6, 32)})::INTEGER AS p_md5
FROM (SELECT event_id, user_id, sha256(user_id::VARCHAR) AS s, md5(user_id::VARCHAR) AS m FROM events)""")
def _(t):
    return t.events.select("event_id", "user_id", S.hash_partition(c("user_id"), 6).alias("p_sha"),
                           S.hash_partition(c("user_id"), 6, "md5").alias("p_md5"))


@query("fun_14_round_cast_decimal", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(10,2)) AS amount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS wide FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", S.to_money(c("o_totalprice")).alias("amount"),
                           S.to_money(c("o_totalprice"), 12).alias("wide"))


@query("fun_15_null_handling", """
SELECT c_custkey, o_orderkey, COALESCE(o_totalprice, 0) AS amount, NULLIF(o_orderpriority, '1-URGENT') AS priority,
       COALESCE(o_orderstatus, 'none') AS status
FROM customer LEFT JOIN orders ON o_custkey - o_custkey % 3 = c_custkey""")
def _(t):
    joined = t.customer.join(t.orders, c("c_custkey") == c("o_custkey") - c("o_custkey") % 3, "left")
    return joined.select("c_custkey", "o_orderkey", F.coalesce("o_totalprice", F.lit(0.0)).alias("amount"),
                         F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
                         F.coalesce("o_orderstatus", F.lit("none")).alias("status"))


@query("fun_16_null_safe_equal", """
WITH v AS (SELECT o_orderkey, NULLIF(o_orderpriority, '1-URGENT') AS a,
           CASE WHEN o_totalprice > 300000 THEN NULLIF(o_orderpriority, '1-URGENT') ELSE 'x' END AS b FROM orders)
SELECT o_orderkey, a IS NOT DISTINCT FROM b AS same FROM v""")
def _(t):
    a = F.nullif("o_orderpriority", F.lit("1-URGENT"))
    b = F.when(c("o_totalprice") > 300000, a).otherwise("x")
    return t.orders.select("o_orderkey", a.eqNullSafe(b).alias("same"))


@query("fun_17_bool_decode", """
SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false WHEN 'signup' THEN true
       WHEN 'purchase' THEN true END AS flag FROM events""")
def _(t):
    kind = c("event_type")
    raw = (F.when(kind == "view", "t").when(kind == "click", "F").when(kind == "signup", "TRUE")
           .when(kind == "purchase", "1").otherwise("MAYBE"))
    return t.events.select("event_id", S.bool_decode(raw).alias("flag"))


@query("fun_18_json_get", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    return t.events.select("event_id", S.json_get(c("props"), "k int")["k"].alias("k"))


WORDS = r"""
SELECT doc_id, word, COUNT(*) AS n FROM
(SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word FROM documents) WHERE word != '' GROUP BY 1, 2"""


@query("fun_19_explode_words", WORDS)
def _(t):
    words = t.documents.select("doc_id", F.explode(S.words_of(c("text"))).alias("word"))
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("fun_20_array_ops", """
WITH a AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY 1)
SELECT user_id, len(types)::INTEGER AS n, list_contains(types, 'purchase') AS buys, array_to_string(types, '|') AS joined FROM a""")
def _(t):
    types = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return types.select("user_id", F.size("types").alias("n"), F.array_contains("types", "purchase").alias("buys"),
                        F.array_join("types", "|").alias("joined"))


@query("fun_20_array_embedding", """
SELECT vec_id, len(embedding)::INTEGER AS dims, embedding[1] AS first_value, list_max(embedding) AS largest,
       len(list_filter(embedding, lambda x: x > 0))::INTEGER AS positive FROM embeddings""")
def _(t):
    e = c("embedding")
    return t.embeddings.select("vec_id", F.size(e).alias("dims"), F.try_element_at(e, F.lit(1)).alias("first_value"),
                               F.array_max(e).alias("largest"), F.size(F.filter(e, lambda x: x > 0)).alias("positive"))


@query("fun_21_map_ops", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, 'k' AS keys,
       'k=' || json_extract_string(props, '$.k') AS entries FROM events""")
def _(t):
    m = S.json_get(c("props"), "map<string,int>")
    return t.events.select("event_id", F.element_at(m, "k").alias("k"), F.array_join(F.map_keys(m), ",").alias("keys"),
                           F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(
                               e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("entries"))


@query("fun_22_struct_ops", """
SELECT c_custkey, n_name AS city, r_name AS region, upper(n_name) AS rebuilt
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    nested = J.star_join(t.customer, [(t.nation, c("c_nationkey") == c("n_nationkey")),
                                      (t.region, c("n_regionkey") == c("r_regionkey"))]).select(
        "c_custkey", F.struct(c("n_name").alias("city"), F.struct(c("r_name").alias("name")).alias("region")).alias("address"))
    changed = nested.withColumn("address2", c("address").withField("city", F.upper("address.city")))
    return changed.select("c_custkey", c("address.city").alias("city"), c("address.region.name").alias("region"),
                          c("address2.city").alias("rebuilt"))


@query("fun_23_math_derive", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(ROUND({DEC2('l_extendedprice')} * {DEC2('l_quantity')} * (1 - {DEC2('l_discount')}), 2) AS DOUBLE) AS profit,
  l_extendedprice / NULLIF(l_quantity, 0) AS unit_price FROM lineitem""")
def _(t):
    d = lambda n: c(n).cast("decimal(18,2)")
    profit = F.round(d("l_extendedprice") * d("l_quantity").cast("decimal(8,2)") * (1 - c("l_discount").cast("decimal(4,2)")), 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", profit.cast("double").alias("profit"),
                             (c("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("unit_price"))


@query("fun_24_risk_score", """
WITH n AS (SELECT user_id, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS top FROM events GROUP BY 1)
SELECT user_id, LEAST(0.5::DOUBLE + (n - 5) * 0.1::DOUBLE, 1.0::DOUBLE) AS by_count, LEAST(top / 10000.0::DOUBLE, 1.0::DOUBLE) AS by_value,
       LEAST(0.6::DOUBLE + (total - 1000.0::DOUBLE) / 25000.0::DOUBLE, 1.0::DOUBLE) AS by_total FROM n""")
def _(t):
    per = t.events.groupBy("user_id").agg(F.count("*").alias("n"), exact_sum("value", 2).alias("total"), F.max("value").alias("top"))
    return per.select("user_id", S.risk_frequency(c("n")).alias("by_count"), S.risk_value(c("top")).alias("by_value"),
                      S.risk_velocity(c("total"), threshold=1000.0).alias("by_total"))


@query("fun_25_strip_chars", r"""
SELECT word, COUNT(*) AS n FROM (SELECT trim(unnest(regexp_split_to_array(text, '[ \t\n\r]+')), '.,!?;:''"()[]{}') AS word
FROM conversations) WHERE word != '' GROUP BY 1""")
def _(t):
    words = t.conversations.select(F.explode(S.words_of(c("text"))).alias("raw")).select(
        S.strip_chars(c("raw")).alias("word"))
    return words.where("word != ''").groupBy("word").agg(F.count("*").alias("n"))


# ---- record transforms

@query("trx_01_insert_field", "SELECT c_custkey, c_name, 'crm' AS source_system FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name").transform(X.insert_field("source_system", "crm"))


@query("trx_02_replace_field", "SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer")
def _(t):
    return t.customer.transform(X.replace_field({"c_custkey": "id", "c_name": "name"}, exclude=["c_acctbal", "c_nationkey"]))


@query("trx_03_mask_field", "SELECT c_custkey, '' AS c_name, 0::DOUBLE AS c_acctbal, c_mktsegment, 0::INTEGER AS c_nationkey FROM customer")
def _(t):
    return t.customer.transform(X.mask_field("c_name", "c_acctbal", "c_nationkey"))


@query("trx_04_cast_field", """
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, NULL::INTEGER AS bad, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""")
def _(t):
    text = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"),
                           c("o_orderpriority").alias("bad"), "o_custkey")
    return text.transform(X.cast_field({"level": "int", "bad": "int", "o_custkey": "string"}))


@query("trx_05_flatten", """
SELECT c_custkey AS id, n_name AS address_city, r_name AS address_region_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    nested = J.star_join(t.customer, [(t.nation, c("c_nationkey") == c("n_nationkey")),
                                      (t.region, c("n_regionkey") == c("r_regionkey"))]).select(
        c("c_custkey").alias("id"),
        F.struct(c("n_name").alias("city"), F.struct(c("r_name").alias("name")).alias("region")).alias("address"))
    return nested.transform(X.flatten("_"))


@query("trx_06_extract_field", "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k int").alias("payload")).transform(X.extract_field("payload"))


@query("trx_07_filter_predicate", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P' OR o_totalprice < 1000)")
def _(t):
    return t.orders.transform(X.filter_predicate((c("o_orderstatus") == "P") | (c("o_totalprice") < 1000))).select(
        "o_orderkey", "o_orderstatus")


@query("trx_08_timestamp_router", """
SELECT event_id, event_type || '-' || strftime(ts, '%Y%m%d') AS day_topic,
       regexp_replace(event_type, '^(pur|sig)(.*)$', 'company-\\1\\2') AS rule_topic FROM events""".replace("\\\\", "\\"))
def _(t):
    steps = X.chain(X.timestamp_router(c("event_type"), c("ts"), name="day_topic"),
                    X.regex_router(c("event_type"), "^(pur|sig)(.*)$", "company-$1$2", name="rule_topic"))
    return t.events.transform(steps).select("event_id", "day_topic", "rule_topic")


@query("trx_09_chain", "SELECT c_custkey AS id, '' AS name, c_acctbal, 'eu' AS origin FROM customer WHERE c_acctbal >= 0")
def _(t):
    return t.customer.transform(X.chain(
        X.filter_predicate(c("c_acctbal") < 0), X.replace_field({"c_custkey": "id", "c_name": "name"},
                                                               include=["c_custkey", "c_name", "c_acctbal"]),
        X.mask_field("name"), X.insert_field("origin", "eu")))


@query("trx_10_pipeline_stage", """
WITH p AS (SELECT CASE WHEN value < 5 THEN ' ' ELSE props END AS payload, event_type AS source FROM events),
r AS (SELECT CASE WHEN trim(payload) = '' THEN 'e' WHEN source NOT IN ('view', 'click', 'purchase') THEN 's' END AS reason FROM p)
SELECT 'received' AS counter, COUNT(*) AS n FROM r UNION ALL SELECT 'rejected_empty_payload', COUNT(*) FROM r WHERE reason = 'e'
UNION ALL SELECT 'rejected_bad_source', COUNT(*) FROM r WHERE reason = 's'
UNION ALL SELECT unnest(['validated', 'enriched', 'completed']), n FROM (SELECT COUNT(*) AS n FROM r WHERE reason IS NULL)""")
def _(t):
    msgs = t.events.select("event_id", F.when(c("value") < 5, " ").otherwise(c("props")).alias("payload"),
                           c("event_type").alias("source"))
    return X.pipeline_counters(X.pipeline_stage(msgs, "payload", "source", ["view", "click", "purchase"]))


@query("trx_11_value_to_key", """
SELECT o_custkey AS key_customer, COUNT(*) AS n, COUNT(DISTINCT o_orderstatus) AS statuses FROM orders GROUP BY 1""")
def _(t):
    keyed = t.orders.transform(X.value_to_key("o_custkey", "o_orderstatus"))
    return keyed.groupBy(c("key.o_custkey").alias("key_customer")).agg(
        F.count("*").alias("n"), F.countDistinct("key.o_orderstatus").alias("statuses"))


# ---- user-defined functions

@query("udf_01_scalar", MASKED)
def _(t):
    return _emails(t).select("c_custkey", U.mask_email_udf()("email").alias("masked"))


@query("udf_02_aggregate", f"""
SELECT l_suppkey, round(SUM(l_extendedprice * (l_quantity + 0.25)) / SUM(l_quantity + 0.25), 4) AS weighted_mean
FROM lineitem WHERE l_returnflag != 'N' GROUP BY 1""")
def _(t):
    rows = t.lineitem.select("l_suppkey", (c("l_quantity") + 0.25).alias("weight"),  # fractional weights, and rows without a value
                             F.when(c("l_returnflag") != "N", c("l_extendedprice")).alias("price"))
    return U.weighted_mean_partials()(rows, ["l_suppkey"], "price", "weight").withColumn("weighted_mean", F.round("weighted_mean", 4))


@query("udf_03_table", r"""
SELECT conv_id, word, COUNT(*) AS n FROM (SELECT conv_id, unnest(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')) AS word
FROM conversations) WHERE word != '' GROUP BY 1, 2""")
def _(t):
    words = t.conversations.lateralJoin(U.split_words_udtf()(c("text").outer()))
    return words.groupBy("conv_id", "word").agg(F.count("*").alias("n"))


@query("udf_05_custom_check", """
SELECT event_id, CASE WHEN value > 200 THEN 'value too large' END AS problem FROM events""")
def _(t):
    check = U.custom_check(lambda v: v <= 200, "value too large")
    return t.events.select("event_id", check("value").alias("problem"))


@query("udf_06_custom_partitioner")
def _(t):
    placed = t.events.withColumn("p", S.hash_partition(c("user_id"), 8)).repartitionById(8, c("p"))
    return (placed.withColumn("physical", F.spark_partition_id()).groupBy("p", "physical")
            .agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users")))
