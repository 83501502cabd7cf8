"""Time windows and analytic windows on the events and orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.bindings.registry import query
from tidemill.bindings.sqltext import DEC2, davg, dsum
from tidemill.functions.exact import exact_avg, exact_sum
from tidemill.operators import sketches as SK
from tidemill.operators import aggregates as A
from tidemill.operators import analytic as N
from tidemill.operators import ordered as O
from tidemill.operators import timewindows as W

c = F.col


@query("win_01_tumbling", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
       COUNT(*) AS n, {dsum('value')} AS total, MAX(value) AS highest FROM events GROUP BY 1, 2, 3""")
def _(t):
    return W.tumbling(t.events, "ts", "1 hour", ["event_type"], n=F.count("*"), total=exact_sum("value", 2),
                      highest=F.max("value"))


@query("win_01_tumbling_5min", f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1, 2""")
def _(t):
    return W.tumbling(t.events, "ts", "5 minutes", n=F.count("*"), total=exact_sum("value", 2))


@query("win_02_hopping", f"""
SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, COUNT(*) AS n, {dsum('value')} AS total FROM
(SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - i * INTERVAL 2 HOUR AS window_start FROM events, range(3) r(i))
GROUP BY 1, 2, 3""")
def _(t):
    return W.hopping(t.events, "ts", "6 hours", "2 hours", ["event_type"], n=F.count("*"), total=exact_sum("value", 2))


SESSIONS = """
WITH l AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 3 HOUR THEN 1 ELSE 0 END) OVER
      (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM l)
"""


@query("win_03_session", SESSIONS + f"""
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 3 HOUR AS session_end, COUNT(*) AS n, {dsum('value')} AS total,
  (epoch_us(MAX(ts) + INTERVAL 3 HOUR) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS duration_s FROM g GROUP BY user_id, s""")
def _(t):
    out = W.session(t.events, "ts", 3 * 3600, ["user_id"],
                    {"n": ("count", F.lit(1)), "total": ("sum", c("value").cast("decimal(18,2)"))})
    return out.withColumn("total", c("total").cast("double"))


@query("win_03_session_last_event", SESSIONS + """
SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS n,
  (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS duration_s FROM g GROUP BY user_id, s""")
def _(t):
    return W.session(t.events, "ts", 3 * 3600, ["user_id"], {"n": ("count", F.lit(1))}, end="last_event")


@query("win_04_moving_average", f"""
SELECT window_start, event_type, {dsum('value')} AS total, COUNT(value) AS n, {davg('value')} AS mean FROM
(SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - i * INTERVAL 1 HOUR AS window_start FROM events, range(5) r(i)) GROUP BY 1, 2""")
def _(t):
    return W.moving_average(t.events, "ts", 5 * 3600, 3600, ["event_type"], "value", 2)


@query("win_05_window_lookup", f"""
SELECT date_trunc('day', ts) AS window_start, user_id, COUNT(*) AS n, {dsum('value')} AS total FROM events
WHERE user_id = 7 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2""")
def _(t):
    path = t.scratch("windows")
    W.tumbling(t.events, "ts", "1 day", ["user_id"], n=F.count("*"), total=exact_sum("value", 2)).write.parquet(path)
    mv = t.spark.read.parquet(path)
    return W.window_lookup(mv, "user_id", 7, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"),
                           F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).drop("window_end")


@query("win_06_count_window", f"""
SELECT user_id, CAST((rn - 1) // 10 AS BIGINT) AS window_no, MIN(ts) AS first_ts, MAX(ts) AS last_ts, {dsum('value')} AS total FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING COUNT(*) = 10""")
def _(t):
    return W.count_window(t.events, ["user_id"], ["ts", "event_id"], 10, first_ts=F.min("ts"), last_ts=F.max("ts"),
                          total=exact_sum("value", 2))


@query("win_07_window_distinct", """
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def _(t):
    return W.window_distinct(t.events, "ts", "1 hour", ["event_type"], "user_id", "users")


ARRIVAL = "ts + (event_id * 37 % 600) * INTERVAL 1 SECOND"


def with_arrival(df):
    """A repeatable arrival time up to ten minutes behind the event time."""
    lag = F.make_dt_interval(secs=(c("event_id") * 37 % 600))
    return df.withColumn("arrival", c("ts") + lag)


@query("win_08_processing_time_window", f"""
WITH e AS (SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS n_event_time FROM events GROUP BY 1),
a AS (SELECT date_trunc('hour', {ARRIVAL}) AS window_start, COUNT(*) AS n_arrival FROM events GROUP BY 1)
SELECT window_start, COALESCE(n_event_time, 0) AS n_event_time, COALESCE(n_arrival, 0) AS n_arrival
FROM e FULL JOIN a USING (window_start)""")
def _(t):
    ev = with_arrival(t.events)
    a = W.tumbling(ev, "ts", "1 hour", n_event_time=F.count("*")).drop("window_end")
    b = W.tumbling(ev, "arrival", "1 hour", n_arrival=F.count("*")).drop("window_end")
    return a.join(b, "window_start", "full").na.fill(0, ["n_event_time", "n_arrival"])


@query("win_09_gap_fill", f"""
WITH h AS (SELECT date_trunc('minute', ts) AS window_start, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1),
s AS (SELECT unnest(generate_series((SELECT MIN(window_start) FROM h), (SELECT MAX(window_start) FROM h), INTERVAL 1 MINUTE)) AS window_start)
SELECT window_start, COALESCE(n, 0) AS n, COALESCE(total, 0) AS total FROM s LEFT JOIN h USING (window_start)""")
def _(t):
    minutes = W.tumbling(t.events, "ts", "1 minute", n=F.count("*"), total=exact_sum("value", 2)).drop("window_end")
    return W.gap_fill(minutes, "window_start", "1 minute", {"n": 0, "total": 0.0})


@query("win_10_multi_resolution", f"""
SELECT size, window_start, event_type, COUNT(*) AS n, {dsum('value')} AS total, MIN(value) AS lowest, MAX(value) AS highest FROM
(SELECT '1 hour' AS size, date_trunc('hour', ts) AS window_start, * FROM events
 UNION ALL SELECT '6 hours', time_bucket(INTERVAL 6 HOUR, ts), * FROM events
 UNION ALL SELECT '1 day', date_trunc('day', ts), * FROM events) GROUP BY 1, 2, 3""")
def _(t):
    out = W.multi_resolution(t.events, "ts", ["1 hour", "6 hours", "1 day"], ["event_type"], {
        "n": ("count", F.lit(1)), "total": ("sum", c("value").cast("decimal(18,2)")),
        "lowest": ("min", c("value")), "highest": ("max", c("value"))})
    return out.withColumn("total", c("total").cast("double"))


@query("win_11_mean_duration_by_hour", f"""
WITH e AS (SELECT date_trunc('hour', ts) AS hour, {davg('value')} AS mean_event_time FROM events GROUP BY 1),
a AS (SELECT date_trunc('hour', {ARRIVAL}) AS hour, {davg('value')} AS mean_arrival_time FROM events GROUP BY 1)
SELECT hour, mean_event_time, mean_arrival_time FROM e FULL JOIN a USING (hour)""")
def _(t):
    return W.mean_duration_by_hour(with_arrival(t.events), "ts", "arrival", "value", 2)


# ---- analytic

@query("ana_01_first_entry", """
SELECT user_id, event_type, event_id, ts FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def _(t):
    return N.first_entry(t.events.select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"],
                         ["ts", "event_id"])


@query("ana_02_prev_value", """
SELECT event_id, user_id, event_type, prev_event_type FROM
(SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_type FROM events)
WHERE prev_event_type != event_type""")
def _(t):
    return N.changed_from_previous(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id",
                                   ["ts", "event_id"], "event_type").drop("ts")


@query("ana_03_daily_allocation", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS grp FROM events GROUP BY 1, 2),
s AS (SELECT user_id, CAST(unnest(generate_series(MIN(day), (SELECT MAX(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY user_id)
SELECT user_id, day, LAST_VALUE(grp IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS event_type
FROM s LEFT JOIN d USING (user_id, day)""")
def _(t):
    return N.daily_allocation(t.events, "user_id", "ts", "event_id", "event_type")


TOTALS = f"(SELECT user_id, {dsum('value')} AS total_score FROM events GROUP BY 1)"


@query("ana_04_leaderboard", f"""
SELECT user_id, total_score, CAST(ROW_NUMBER() OVER (ORDER BY total_score DESC, user_id) AS INTEGER) AS place FROM {TOTALS}
ORDER BY place LIMIT 100""")
def _(t):
    return N.leaderboard(t.events, "user_id", "value", 100, 2)


@query("ana_04_player_rank", f"""
SELECT 7::INTEGER AS user_id, COUNT(*) FILTER (total_score > (SELECT total_score FROM {TOTALS} WHERE user_id = 7)) + 1 AS place,
       COUNT(*) AS players FROM {TOTALS}""")
def _(t):
    return N.player_rank(t.events, "user_id", "value", 7, 2)


@query("ana_05_leaderboard_by_period", f"""
WITH p AS (SELECT date_trunc('week', ts)::DATE AS period, user_id, {dsum('value')} AS total_score FROM events GROUP BY 1, 2)
SELECT period, user_id, total_score, CAST(place AS INTEGER) AS place FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY period ORDER BY total_score DESC, user_id) AS place FROM p) WHERE place <= 10""")
def _(t):
    return N.leaderboard_by_period(t.events, F.trunc("ts", "week"), "user_id", "value", 10, 2)


@query("ana_06_rolling_sum_range", f"""
SELECT event_id, user_id, COUNT(*) OVER w AS n_12h, CAST(SUM({DEC2('value')}) OVER w AS DOUBLE) AS total_12h FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 12 HOUR PRECEDING AND CURRENT ROW)""")
def _(t):
    out = N.rolling_sum_range(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", 12 * 3600,
                              n_12h=("count", F.lit(1)), total_12h=("sum", c("value").cast("decimal(18,2)")))
    return out.select("event_id", "user_id", "n_12h", c("total_12h").cast("double").alias("total_12h"))


@query("ana_07_consecutive_condition", f"""
WITH h AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, {davg('value')} AS mean_value FROM events GROUP BY 1, 2),
p AS (SELECT *, LAG(slot) OVER (PARTITION BY event_type ORDER BY slot) AS before FROM h WHERE mean_value < 45),
r AS (SELECT *, SUM(CASE WHEN before = slot - INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY slot) AS run FROM p)
SELECT event_type, MIN(slot) AS run_start, MAX(slot) AS run_end, COUNT(*) AS periods FROM r
GROUP BY event_type, run HAVING COUNT(*) >= 2""")
def _(t):
    slots = A.group_agg(t.events, ["event_type", F.window("ts", "30 minutes")["start"].alias("slot")], mean_value=exact_avg("value", 2))
    return N.consecutive_condition(slots, ["event_type"], "slot", c("mean_value") < 45, 2, 1800)


@query("ana_08_cumulative_metrics", f"""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS period, SUM({DEC2('o_totalprice')}) AS a, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT period, CAST(a AS DOUBLE) AS amount, n, CAST(SUM(a) OVER (ORDER BY period) AS DOUBLE) AS running_amount,
  CAST(SUM(n) OVER (ORDER BY period) AS BIGINT) AS running_n,
  CAST(a AS DOUBLE) / CAST((SELECT SUM(a) FROM d) AS DOUBLE) AS share FROM d""")
def _(t):
    out = A.running_global(t.orders, c("o_orderdate").cast("date"), amount=F.sum(c("o_totalprice").cast("decimal(18,2)")),
                           n=F.count("*"))
    whole = t.orders.agg(exact_sum("o_totalprice", 2).alias("whole")).scalar()
    return out.select(
        "period", c("amount").cast("double").alias("amount"), "n", c("running_amount").cast("double").alias("running_amount"),
        "running_n", (c("amount").cast("double") / whole).alias("share"))


@query("ana_08_cumulative_by_customer", f"""
SELECT o_orderkey, o_custkey, CAST(SUM({DEC2('o_totalprice')}) OVER w AS DOUBLE) AS running_amount, COUNT(*) OVER w AS order_no
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""")
def _(t):
    out = O.running(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {
        "running_amount": ("sum", c("o_totalprice").cast("decimal(18,2)")), "order_no": ("count", F.lit(1))})
    return out.select("o_orderkey", "o_custkey", c("running_amount").cast("double").alias("running_amount"), "order_no")


@query("ana_09_windowed_leaderboard", f"""
WITH p AS (SELECT date_trunc('day', ts) AS window_start, user_id, {dsum('value')} AS window_score FROM events GROUP BY 1, 2)
SELECT window_start, user_id, window_score, CAST(place AS INTEGER) AS place, total_score AS all_time_score FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY window_score DESC, user_id) AS place FROM p)
JOIN {TOTALS} USING (user_id) WHERE place <= 5""")
def _(t):
    return N.windowed_leaderboard(t.events, "ts", "1 day", "user_id", "value", 5, 2)


# ---- sketches

GRAINS = {"1 hour": "date_trunc('hour', ts)", "1 day": "date_trunc('day', ts)", "7 days": "time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')"}


@query("win_07_distinct_from_sketches", " UNION ALL ".join(f"""
SELECT '{size}' AS grain, {start} AS window_start, event_type, COUNT(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 2, 3""" for size, start in GRAINS.items()))
def _(t):
    """Users per window at three grains, all from sketches saved per minute, held against the exact counts."""
    path = t.scratch("sketches")
    SK.distinct_sketches(t.events, "ts", "user_id", ["event_type"]).write.parquet(path)
    saved, out = t.spark.read.parquet(path), None
    for size in GRAINS:
        exact = W.window_distinct(t.events, "ts", size, ["event_type"], "user_id", "users")
        met = exact.join(SK.distinct_over(saved, size, ["event_type"], "estimate"), ["window_start", "event_type"], "full")
        near = F.abs(c("estimate") - c("users")) <= F.greatest(F.lit(1.0), 0.05 * c("users"))  # three standard errors
        one = met.select(F.lit(size).alias("grain"), "window_start", "event_type", "users", F.coalesce(near, F.lit(False)).alias("near"))
        out = one if out is None else out.unionByName(one)
    return out
