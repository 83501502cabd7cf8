"""Streaming queries: run to the end of their input, then compared as tables.

Windows that a watermark closes need something newer than the last event, so a marker row
far in the future is fed to them and filtered out of the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.bindings import jobs as J_
from tidemill.bindings.functions import hex_mod_sql
from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import DEC2, dsum
from tidemill.operators import aggregates as A
from tidemill.operators import joins as J
from tidemill.operators import timewindows as W
from tidemill.operators.versioned import VersionedTable
from tidemill.plans import fraud as FR
from tidemill.session import rocksdb_state
from tidemill.streaming import sinks as K
from tidemill.streaming import sources as R
from tidemill.streaming import stateful as X
from tidemill.streaming.asof import asof_lookup_stream
from tidemill.streaming.live_sessions import latest_sessions, session_changes

c = F.col
DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
FIRST, SECOND = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
MARKER = "2030-01-01 00:00:00"


def as_json(df):
    return df.select(F.to_json(F.struct(*df.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))


def drop(df, folder):
    """Let more files land in a watched folder."""
    as_json(df).write.mode("append").text(folder)


def marker(events):
    return events.sparkSession.createDataFrame([(-1, MARKER, -1, "marker", 0.0, "{}")],
                                               DDL.replace("timestamp_ntz", "string")).withColumn("ts", c("ts").cast("timestamp_ntz"))


def part(events, lo=None, hi=None, col="ts"):
    out = events
    out = out if lo is None else out.where(c(col) >= F.lit(lo).cast("timestamp_ntz"))
    return out if hi is None else out.where(c(col) < F.lit(hi).cast("timestamp_ntz"))


def watched(t, *frames):
    folder = t.scratch("landing")
    for f in frames:
        drop(f, folder)
    return folder


def events_stream(t, folder, delay="10 minutes"):
    rows = R.stream_json_events(t.spark, folder, DDL)
    return R.with_event_time(rows, "ts", delay) if delay else rows


# ---- sources

@query("src_10_stream_json_events", """
SELECT event_id, user_id, CASE WHEN event_type != 'signup' THEN event_type END AS event_type, value FROM events WHERE event_type != 'error' OR value >= 30""")
def _(t):
    body = F.to_json(F.struct("event_id", "user_id", F.when(c("event_type") != "signup", c("event_type")).alias("event_type"), "value"))
    lines = t.events.select(F.when((c("event_type") == "error") & (c("value") < 30), F.substring(body, 1, 20)).otherwise(body).alias("value"))
    folder, out = t.scratch("landing"), t.scratch("decoded")
    lines.write.text(folder)
    rows = R.stream_json_events(t.spark, folder, "event_id bigint, user_id bigint, event_type string, value double")
    K.append_stream(rows, out, t.scratch("ckpt"))
    return t.spark.read.parquet(out)


@query("src_11_auto_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    folder, out, ckpt = t.scratch("drops"), t.scratch("ingested"), t.scratch("ckpt")
    ddl = "event_id bigint, user_id bigint, event_type string, value double"
    cols = ["event_id", "user_id", "event_type", "value"]
    for lo, hi in ((None, FIRST), (FIRST, SECOND), (SECOND, None)):
        part(t.events, lo, hi).select(*cols).write.mode("append").option("header", True).csv(folder)
        K.append_stream(R.auto_ingest(t.spark, folder, ddl), out, ckpt)
    return t.spark.read.parquet(out)


@query("src_16_stream_text_lines", r"""
SELECT line, COUNT(*) AS n, true AS arrived FROM (SELECT unnest(string_split(text, E'\n')) AS line FROM documents) GROUP BY 1""")
def _(t):
    """Lines, and whether each came between the start of the stream and now."""
    started = F.lit(t.spark.sql("SELECT current_timestamp() AS t").first().t)
    folder, out = t.scratch("text"), t.scratch("lines")
    t.documents.select("text").write.option("lineSep", "\n").text(folder)
    K.append_stream(R.stream_text_lines(t.spark, folder), out, t.scratch("ckpt"))
    arrived = F.min(c("arrived_at").between(started, F.current_timestamp()))
    return t.spark.read.parquet(out).groupBy(c("value").alias("line")).agg(F.count("*").alias("n"), F.coalesce(arrived, F.lit(False)).alias("arrived"))


# ---- sinks

@query("snk_07_append_stream", "SELECT event_id, ts, value FROM events")
def _(t):
    out, ckpt, folder = t.scratch("appended"), t.scratch("ckpt"), watched(t, t.events)
    K.append_stream(events_stream(t, folder, None), out, ckpt)
    return t.spark.read.parquet(out).select("event_id", "ts", "value")


HOURLY = f"SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1, 2"


def hourly(df):
    return W.tumbling(df, "ts", "1 hour", ["event_type"], n=F.count("*"), total=F.sum(c("value").cast("decimal(18,2)"))).drop("window_end")


@query("snk_08_upsert_stream", HOURLY)
def _(t):
    table, ckpt, folder = VersionedTable(t.spark, t.scratch("hourly"), ["window_start", "event_type"]), t.scratch("ckpt"), t.scratch("landing")
    for lo, hi in ((None, "2024-01-15 12:30:00"), ("2024-01-15 12:30:00", None)):  # the cut is inside an hour
        drop(part(t.events, lo, hi), folder)
        K.upsert_stream(hourly(events_stream(t, folder)), table, ckpt)
    return table.read().withColumn("total", c("total").cast("double"))


@query("snk_09_fan_out", f"""
SELECT 'raw' AS sink, event_type AS label, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 2
UNION ALL SELECT 'by_day', strftime(ts, '%Y-%m-%d'), COUNT(*), {dsum('value')} FROM events GROUP BY 2
UNION ALL SELECT 'by_type', event_type, COUNT(*), {dsum('value')} FROM events GROUP BY 2""")
def _(t):
    path, folder = t.scratch("fan"), watched(t, part(t.events, None, SECOND), part(t.events, SECOND))
    money = F.sum(c("value").cast("decimal(18,2)")).alias("total")
    K.fan_out(R.stream_json_events(t.spark, folder, DDL), {
        "raw": lambda b: b,
        "by_day": lambda b: b.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("label")).agg(F.count("*").alias("n"), money),
        "by_type": lambda b: b.groupBy(c("event_type").alias("label")).agg(F.count("*").alias("n"), money),
    }, path, t.scratch("ckpt"))
    raw = t.spark.read.parquet(f"{path}/raw").groupBy(c("event_type").alias("label")).agg(F.count("*").alias("n"), money)
    out = raw.withColumn("sink", F.lit("raw"))
    for name in ("by_day", "by_type"):
        folded = t.spark.read.parquet(f"{path}/{name}").groupBy("label").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        out = out.unionByName(folded.withColumn("sink", F.lit(name)))
    return out.withColumn("total", c("total").cast("double"))


@query("agg_17_running_totals", f"""
SELECT user_id, event_type, COUNT(*) AS n, {dsum('value')} AS total, MAX(value) AS highest FROM events GROUP BY 1, 2""")
def _(t):
    table, ckpt, folder = VersionedTable(t.spark, t.scratch("totals"), ["user_id", "event_type"]), t.scratch("ckpt"), t.scratch("landing")
    for lo, hi in ((None, FIRST), (FIRST, None)):
        drop(part(t.events, lo, hi), folder)
        totals = A.group_agg(events_stream(t, folder, None), ["user_id", "event_type"], n=F.count("*"),
                             total=F.sum(c("value").cast("decimal(18,2)")), highest=F.max("value"))
        K.upsert_stream(totals, table, ckpt, compact_every=2)
    return table.read().withColumn("total", c("total").cast("double"))


# ---- streaming semantics

@query("str_01_with_watermark", HOURLY)
def _(t):
    out = t.scratch("closed")
    folder = watched(t, t.events, marker(t.events))
    K.append_stream(hourly(events_stream(t, folder, "5 seconds")), out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).where("event_type != 'marker'").withColumn("total", c("total").cast("double"))


def arriving(t):
    return t.events.withColumn("arrival", c("ts") + F.make_dt_interval(secs=c("event_id") * 37 % 600))


@query("str_02_split_late", """
WITH a AS (SELECT event_id, ts, ts + (event_id * 37 % 600) * INTERVAL 1 SECOND AS arrival FROM events),
m AS (SELECT *, MAX(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)
SELECT event_id, arrival, COALESCE(ts < seen - INTERVAL 1 MINUTE, false) AS late FROM m""")
def _(t):
    return X.split_late(arriving(t).select("event_id", "ts", "arrival"), "ts", ["arrival", "event_id"], 60).drop("ts")


@query("str_02_split_late_stream", f"""
WITH a AS (SELECT event_id, ts, ts + (event_id * 37 % 600) * INTERVAL 1 SECOND AS arrival FROM events),
b AS (SELECT *, CASE WHEN arrival < TIMESTAMP '{FIRST}' THEN 0 WHEN arrival < TIMESTAMP '{SECOND}' THEN 1 ELSE 2 END AS batch FROM a),
m AS (SELECT batch, MAX(ts) AS newest FROM b GROUP BY 1), s AS (SELECT b.*, (SELECT MAX(newest) FROM m WHERE m.batch < b.batch) AS seen FROM b)
SELECT event_id, COALESCE(ts < seen - INTERVAL 1 MINUTE, false) AS late FROM s""")
def _(t):
    path, ckpt, folder = t.scratch("late"), t.scratch("ckpt"), t.scratch("landing")
    rows = arriving(t)
    for lo, hi in ((None, FIRST), (FIRST, SECOND), (SECOND, None)):
        drop(part(rows, lo, hi, "arrival").drop("arrival"), folder)
        stream = events_stream(t, folder, None).withColumn("ts", c("ts").cast("timestamp"))
        K.split_late_stream(stream, "ts", 60, path, ckpt)
    late = t.spark.read.parquet(f"{path}/late").select("event_id", F.lit(True).alias("late"))
    return late.unionByName(t.spark.read.parquet(f"{path}/on_time").select("event_id", F.lit(False).alias("late")))


@query("str_03_dedup_stream", "SELECT event_id, user_id, value FROM events")
def _(t):
    out, folder = t.scratch("once"), watched(t, t.events, t.events)
    rows = R.stream_json_events(t.spark, folder, DDL).withColumn("ts", c("ts").cast("timestamp"))
    K.append_stream(X.dedup_stream(rows, ["event_id"], "ts", "1 hour"), out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).select("event_id", "user_id", "value")


@query("str_03_dedup_silence_stream", """
SELECT user_id, event_id FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
WHERE p IS NULL OR ts - p > INTERVAL 6 HOUR""")
def _(t):
    """Users that come again after six hours of silence; rows arrive up to ten minutes late."""
    first = lambda events: X.dedup_stream(events.select("ts", "event_id", "user_id"), ["user_id"], "ts", "6 hours", eager=False)
    return _as_they_arrive(t, {"events": t.events}, first).select("user_id", "event_id")


@query("str_04_checkpointed_query", HOURLY)
def _(t):
    """Two runs of one query around a restart; windows open at the restart go on."""
    out, ckpt, folder = t.scratch("closed"), t.scratch("ckpt"), t.scratch("landing")
    for frames in ((part(t.events, None, "2024-01-15 12:30:00"),), (part(t.events, "2024-01-15 12:30:00"), marker(t.events))):
        for f in frames:
            drop(f, folder)
        K.append_stream(hourly(events_stream(t, folder, "1 hour")), out, ckpt)
    return t.spark.read.parquet(out).where("event_type != 'marker'").withColumn("total", c("total").cast("double"))


@query("str_05_session_tracker", """
WITH l AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM l)
SELECT user_id, CAST(s AS BIGINT) AS session_no, MIN(ts) AS session_start, MAX(ts) AS last_seen, COUNT(*) AS actions,
  arg_max(event_type, (ts, event_id)) AS last_action FROM g GROUP BY user_id, s""")
def _(t):
    return X.session_tracker(t.events, "user_id", "ts", "event_id", "event_type", 2 * 3600)


@query("str_05_session_tracker_stream", """
WITH l AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM l)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS last_seen, COUNT(*) AS actions, arg_max(event_type, (ts, event_id)) AS last_action
FROM g GROUP BY user_id, s""")
def _(t):
    out, folder = t.scratch("sessions"), watched(t, t.events, marker(t.events))
    K.append_stream(X.session_tracker(events_stream(t, folder), "user_id", "ts", "event_id", "event_type", 2 * 3600), out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).where("user_id >= 0")


@query("str_06_state_ttl", f"SELECT date_trunc('day', ts) AS window_start, user_id, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1, 2")
def _(t):
    out, folder = t.scratch("daily"), watched(t, t.events, marker(t.events))
    daily = W.tumbling(events_stream(t, folder, "2 hours"), "ts", "1 day", ["user_id"], n=F.count("*"),
                       total=F.sum(c("value").cast("decimal(18,2)"))).drop("window_end")
    K.append_stream(daily, out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).where("user_id >= 0").withColumn("total", c("total").cast("double"))


@query("str_07_threshold_route", """
SELECT event_id, CASE WHEN value > 35 THEN 'alert' ELSE 'normal' END AS route, CAST(SUM((value > 35)::INT) OVER
 (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS alerts_so_far FROM events""")
def _(t):
    routed = R.threshold_route(t.events, "value", 35)
    out = X.rolling_reduce(routed, ["user_id"], ["ts", "event_id"], {"alerts_so_far": ("sum", (c("value") > 35).cast("long"))})
    return out.select("event_id", "route", "alerts_so_far")


@query("str_08_push_pull_query", HOURLY.replace("FROM events", "FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20'"))
def _(t):
    table, folder = VersionedTable(t.spark, t.scratch("pushed"), ["window_start", "event_type"]), watched(t, t.events)
    K.upsert_stream(hourly(events_stream(t, folder)), table, t.scratch("ckpt"))
    pulled = W.window_lookup(table.read(), "event_type", "purchase", F.lit(SECOND).cast("timestamp"), F.lit(MARKER).cast("timestamp"))
    return pulled.withColumn("total", c("total").cast("double"))


@query("str_09_chain_streams", f"""
SELECT date_trunc('day', ts) AS window_start, CASE WHEN value > 100 THEN 'premium' ELSE 'standard' END AS tier, c_mktsegment, COUNT(*) AS n, {dsum('value')} AS total
FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase' GROUP BY 1, 2, 3""")
def _(t):
    folder, middle, out = watched(t, t.events, marker(t.events)), t.scratch("enriched"), t.scratch("windowed")
    people = t.customer.select("c_custkey", "c_mktsegment")
    rows = events_stream(t, folder, None).where("event_type IN ('purchase', 'marker')")
    enriched = J.lookup_enrich(rows, people, c("user_id") == c("c_custkey"), {"c_mktsegment": "unknown"}).select(
        "ts", "value", "c_mktsegment", F.when(c("value") > 100, "premium").otherwise("standard").alias("tier"))
    K.append_stream(enriched, middle, t.scratch("ckpt"))
    second = R.with_event_time(t.spark.readStream.schema(t.spark.read.parquet(middle).schema).parquet(middle), "ts", "10 minutes")
    daily = W.tumbling(second, "ts", "1 day", ["tier", "c_mktsegment"], n=F.count("*"), total=F.sum(c("value").cast("decimal(18,2)")))
    K.append_stream(daily.drop("window_end"), out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).where("c_mktsegment != 'unknown'").withColumn("total", c("total").cast("double"))


EVERY_THIRD = f"""
WITH a AS (SELECT user_id, ROW_NUMBER() OVER w AS alert_count, CAST(SUM({DEC2('value')}) OVER w AS DOUBLE) AS total FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, alert_count, total FROM a WHERE alert_count % 3 = 0"""


@query("str_10_publish_every_n", EVERY_THIRD)
def _(t):
    out = X.publish_every_n(t.events.select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"],
                            c("value").cast("decimal(18,2)"), 3)
    return out.select("user_id", "alert_count", c("total").cast("double").alias("total"))


@query("str_11_commit_batches", "SELECT event_id, user_id FROM events")
def _(t):
    out, folder = t.scratch("batches"), watched(t, part(t.events, None, FIRST), part(t.events, FIRST, SECOND), part(t.events, SECOND))
    K.append_batches(R.stream_json_events(t.spark, folder, DDL, files_per_batch=10), out, t.scratch("ckpt"))
    return t.spark.read.parquet(out).select("event_id", "user_id")


@query("str_12_rolling_reduce", f"""
SELECT event_id, MAX(value) OVER w AS highest, MIN(value) OVER w AS lowest, CAST(SUM({DEC2('value')}) OVER w AS DOUBLE) AS total FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(t):
    rows = t.events.select("event_id", "event_type", "ts", "value")
    out = X.rolling_reduce(rows, ["event_type"], ["ts", "event_id"], {
        "highest": ("max", c("value")), "lowest": ("min", c("value")), "total": ("sum", c("value").cast("decimal(18,2)"))})
    return out.select("event_id", "highest", "lowest", c("total").cast("double").alias("total"))


def _in_two_runs(t, shape):
    """Land the events in two parts and run the query after each."""
    out, ckpt, folder = t.scratch("stateful"), t.scratch("ckpt"), t.scratch("landing")
    for lo, hi in ((None, FIRST), (FIRST, None)):
        drop(part(t.events, lo, hi), folder)
        rows = events_stream(t, folder, None).withColumn("cents", F.round(c("value") * 100).cast("long"))
        K.append_stream(shape(rows), out, ckpt)
    return t.spark.read.parquet(out)


@query("str_12_rolling_reduce_stream", f"""
SELECT event_id, MAX(value) OVER w AS highest, MIN(value) OVER w AS lowest, CAST(SUM({DEC2('value')}) OVER w AS DOUBLE) AS total FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(t):
    out = _in_two_runs(t, lambda rows: X.rolling_reduce_stream(rows, "user_id", ["ts", "event_id"], "cents"))
    return out.select("event_id", *[(c(n) / 100.0).alias(n) for n in ("highest", "lowest", "total")])


@query("win_06_count_window_stream", f"""
SELECT user_id, CAST((rn - 1) // 10 AS BIGINT) AS window_no, {dsum('value')} AS total FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1, 2 HAVING COUNT(*) = 10""")
def _(t):
    out = _in_two_runs(t, lambda rows: X.count_window_stream(rows, "user_id", ["ts", "event_id"], "cents", 10))
    return out.select("user_id", "window_no", (c("total_cents") / 100.0).alias("total"))


@query("str_13_load_shed", f"""
WITH h AS (SELECT event_id, event_type, sha256(event_id::VARCHAR) AS s FROM events)
SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 1 ELSE 10 END AS weight FROM h
WHERE event_type = 'error' OR {hex_mod_sql('s', 10, 64)} = 0""")
def _(t):
    return R.load_shed(t.events, c("event_type") == "error", c("event_id"), 10).select("event_id", "event_type", "weight")


@query("udf_04_stateful_agent", """
SELECT event_id, 'high_frequency' AS rule FROM
 (SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS n FROM events) WHERE n > 2
UNION ALL SELECT event_id, 'place_change' FROM (SELECT *, LAG(event_type) OVER w AS was, LAG(ts) OVER w AS before FROM events
 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE was != event_type AND ts - before <= INTERVAL 24 HOUR""")
def _(t):
    return _in_two_runs(t, lambda rows: X.fraud_agent_stream(
        R.with_event_time(rows, "ts", "10 minutes"), "user_id", "ts", "event_id", "event_type", 2, 86400))


# ---- event-time work by panes: rows are dealt to three runs by their arrival, up to ten minutes after they happened

def _as_they_arrive(t, rows, shape, out=None, keep="user_id >= 0"):
    """Land rows in three parts by arrival, run the query after each, and a last time behind a marker in the far future.

    ``rows`` maps a landing folder's name to its rows; ``shape`` gets the opened streams.
    """
    out, ckpt = out or t.scratch("arrived"), t.scratch("ckpt")
    folders = {name: t.scratch(name) for name in rows}
    late = lambda df: df.withColumn("arrival", c("ts") + F.make_dt_interval(secs=c("event_id") * 37 % 600))
    for lo, hi in ((None, FIRST), (FIRST, SECOND), (SECOND, None), ("marker", None)):
        for name, df in rows.items():
            drop(marker(t.events) if lo == "marker" else part(late(df), lo, hi, "arrival").drop("arrival"), folders[name])
        K.append_stream(shape(*[R.stream_json_events(t.spark, f, DDL) for f in folders.values()]), out, ckpt)
    return t.spark.read.parquet(out).where(keep)


def _by_panes(t, rows, shape, keep="user_id >= 0"):
    """``_as_they_arrive`` for shapes with states and timers per key."""
    with rocksdb_state(t.spark):
        return _as_they_arrive(t, rows, shape, keep=keep)


@query("jon_08_asof_lookup_stream", """
SELECT p.event_id AS event_id, p.user_id AS user_id, k.event_id AS click_id, k.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') k ON p.user_id = k.user_id AND p.ts >= k.ts""")
def _(t):
    sides = {"buys": t.events.where("event_type = 'purchase'"), "clicks": t.events.where("event_type = 'click'")}
    return _by_panes(t, sides, lambda buys, clicks: asof_lookup_stream(
        buys.select("event_id", "user_id", "ts"), clicks, "user_id", "ts", "ts", {"click_id": "event_id", "click_value": "value"},
        "event_id", "event_id", "20 minutes", 86400)).select("event_id", "user_id", "click_id", "click_value")


@query("str_05_session_tracker_live", """
WITH l AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM l)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS last_seen, COUNT(*) AS actions, arg_max(event_type, (ts, event_id)) AS last_action,
  'closed' AS state FROM g GROUP BY user_id, s""")
def _(t):
    changes = _by_panes(t, {"events": t.events}, lambda events: session_changes(
        events, "user_id", "ts", "event_id", "event_type", 2 * 3600, "20 minutes"))
    return latest_sessions(changes, "user_id")


def _history_stream(t, limits):
    def shape(events):
        txns = events.select(c("event_id").alias("id"), c("user_id").alias("user"), "ts", c("value").alias("amount"),
                             c("event_type").alias("country"), F.get_json_object("props", "$.k").alias("merchant"))
        return FR.fraud_rules_stream(txns, limits, "20 minutes", 86400)
    return _by_panes(t, {"events": t.events}, shape, "user >= 0")


@query("dom_07_fraud_rules_stream", J_.FRAUD + 'SELECT id, "user", ts, rule, detail, risk FROM a')
def _(t):
    return _history_stream(t, J_.LIMITS)


@query("dom_07_fraud_rules_trailing_stream", J_.TRAILING)
def _(t):
    return _history_stream(t, J_.TRAILING_LIMITS)
