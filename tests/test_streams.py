"""A stream run to its end must give the rows of its batch twin."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemill.operators import joins as J
from tidemill.operators import ordered as O
from tidemill.operators import timewindows as W
from tidemill.operators.versioned import VersionedTable
from tidemill.plans import fraud as FR
from tidemill.streaming import sinks as K
from tidemill.streaming import sources as R
from tidemill.streaming import stateful as X
from tidemill.streaming.asof import asof_lookup_stream
from tidemill.streaming.live_sessions import latest_sessions, session_changes

c = F.col
DDL = "id bigint, u string, t timestamp, v bigint"
T0 = dt.datetime(2024, 1, 1)
FAR = dt.datetime(2030, 1, 1)


def land(spark, folder, rows):
    """One file with these rows."""
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(folder)


def events(n=200):
    """Three users; one of them has most of the rows."""
    return [(i, "hot" if i % 5 else f"u{i % 3}", T0 + dt.timedelta(seconds=i * 97 + (i % 7) * 3), i % 13) for i in range(n)]


def stream(spark, folder):
    return spark.readStream.schema(DDL).parquet(folder)


def rows(df, *cols):
    return sorted(tuple(r[x] for x in cols) for r in df.collect())


def drained(spark, df, work):
    out = work("out")
    K.append_stream(df, out, work("ckpt"))
    return spark.read.parquet(out)


def test_session_stream(spark, work):
    folder = work("in")
    land(spark, folder, events())
    batch = spark.read.schema(DDL).parquet(folder)
    aggs = {"n": ("count", F.lit(1)), "total": ("sum", c("v"))}
    want = rows(W.session(batch, "t", 300, ["u"], aggs), "u", "session_start", "session_end", "n", "total")
    land(spark, folder, [(-1, "marker", FAR, 0)])
    got = W.session(stream(spark, folder).withWatermark("t", "1 minute"), "t", 300, ["u"], aggs)
    got = drained(spark, got, work).where("u != 'marker'")
    assert rows(got, "u", "session_start", "session_end", "n", "total") == want


def test_window_stream(spark, work):
    folder = work("in")
    land(spark, folder, events())
    batch = spark.read.schema(DDL).parquet(folder)
    for shape in (lambda d: W.tumbling(d, "t", "10 minutes", ["u"], n=F.count("*")),
                  lambda d: W.hopping(d, "t", "10 minutes", "5 minutes", ["u"], n=F.count("*"))):
        want = rows(shape(batch).where("u != 'marker'"), "window_start", "u", "n")
        if batch.where("u = 'marker'").isEmpty():
            land(spark, folder, [(-1, "marker", FAR, 0)])
        got = drained(spark, shape(stream(spark, folder).withWatermark("t", "1 minute")), work).where("u != 'marker'")
        assert rows(got, "window_start", "u", "n") == want


def test_interval_join_stream(spark, work):
    left, right = work("l"), work("r")
    land(spark, left, events())
    land(spark, right, [(i, u, t + dt.timedelta(seconds=40), v) for i, u, t, v in events()])

    def sides(read):
        a = read(left).select(c("id").alias("a"), c("u").alias("ua"), c("t").alias("ta"))
        b = read(right).select(c("id").alias("b"), c("u").alias("ub"), c("t").alias("tb"))
        return a, b
    a, b = sides(lambda p: spark.read.schema(DDL).parquet(p))
    want = rows(J.interval_join(a, b, [("ua", "ub")], "ta", "tb", -200, 0), "a", "b")
    assert want
    a, b = sides(lambda p: stream(spark, p))
    with pytest.raises(ValueError, match="watermark"):
        J.interval_join(a, b, [("ua", "ub")], "ta", "tb", -200, 0)
    joined = J.interval_join(a.withWatermark("ta", "1 hour"), b.withWatermark("tb", "1 hour"), [("ua", "ub")], "ta", "tb", -200, 0)
    assert rows(drained(spark, joined, work), "a", "b") == want


def test_lookup_on_a_stream(spark, work):
    folder = work("in")
    land(spark, folder, events(20))
    dim = spark.createDataFrame([("hot", "Hot Inc")], "who string, name string")
    out = J.lookup_enrich(stream(spark, folder), dim, c("u") == c("who"), {"name": "Unknown Customer"})
    got = drained(spark, out, work)
    assert {r.name for r in got.where("u = 'hot'").collect()} == {"Hot Inc"}
    assert {r.name for r in got.where("u != 'hot'").collect()} == {"Unknown Customer"}


def test_upserts_survive_a_repeated_batch(spark, work):
    folder, ckpt = work("in"), work("ckpt")
    table = VersionedTable(spark, work("table"), ["u"])
    totals = lambda: stream(spark, folder).groupBy("u").agg(F.sum("v").alias("total"))
    for part in (events()[:90], events()[90:]):
        land(spark, folder, part)
        K.upsert_stream(totals(), table, ckpt, compact_every=2)
    want = rows(spark.read.schema(DDL).parquet(folder).groupBy("u").agg(F.sum("v").alias("total")), "u", "total")
    assert rows(table.read(), "u", "total") == want
    K.upsert_stream(totals(), table, ckpt)  # nothing new
    assert rows(table.read(), "u", "total") == want


def test_every_nth_stream(spark, work):
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    rows_ = sorted(events(), key=lambda e: (e[2], e[0]))
    for part in (rows_[:77], rows_[77:]):
        land(spark, folder, part)
        K.append_stream(X.publish_every_n_stream(stream(spark, folder), "u", ["t", "id"], "v", 3), out, ckpt)
    batch = X.publish_every_n(spark.read.schema(DDL).parquet(folder), "u", ["t", "id"], c("v"), 3, chunk=3)
    assert rows(spark.read.parquet(out), "u", "alert_count", "total_cents") == rows(batch, "u", "alert_count", "total")


KEYED = "id bigint, u bigint, t timestamp, v bigint"


def many_keys(n=6000, keys=2500):
    """More keys than buckets, the NULL key too; ids beyond 2^53 beside a missing one, and missing values."""
    big = 2 ** 60
    out = [(big + i, i * 7919 % keys, T0 + dt.timedelta(seconds=i // 3), None if i % 5 == 0 else big // 8 * (i % 3) + i % 13) for i in range(n)]
    return out + [(big + n + i, None, T0 + dt.timedelta(seconds=n + i), i) for i in range(5)] + [(None, 1, T0 + dt.timedelta(seconds=n + 9), 4)]


def in_two_runs(spark, work, rows_, shape):
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    for part in (rows_[:len(rows_) // 3], rows_[len(rows_) // 3:]):
        spark.createDataFrame(part, KEYED).coalesce(3).write.mode("append").parquet(folder)
        K.append_stream(shape(spark.readStream.schema(KEYED).parquet(folder)), out, ckpt)
    return spark.read.parquet(out), spark.read.format("statestore").load(ckpt)


def by_key(rows_):
    keys = {}
    for r in sorted(rows_, key=lambda r: (r[2], r[0] is None, r[0])):
        keys.setdefault(r[1], []).append(r)
    return keys


def test_rolling_reduce_takes_keys_together(spark, work):
    """One state row per bucket and not per key; values and ids stay whole numbers, what is missing stays out."""
    rows_ = many_keys()
    got, state = in_two_runs(spark, work, rows_, lambda s: X.rolling_reduce_stream(s, "u", ["t", "id"], "v"))
    want = []
    for u, mine in by_key(rows_).items():
        seen = []
        for i, _, t, v in mine:
            seen += [] if v is None else [v]
            want.append((u, t, i, *((max(seen), min(seen), sum(seen)) if seen else (None,) * 3)))
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    assert sorted(map(tuple, got.select("u", "t", "id", "highest", "lowest", "total").collect()), key=key) == sorted(want, key=key)
    assert state.count() <= X.BUCKETS + 1 < len(by_key(rows_))


def test_counts_take_keys_together(spark, work):
    rows_ = many_keys()
    windows, state = in_two_runs(spark, work, rows_, lambda s: X.count_window_stream(s, "u", ["t", "id"], "v", 2, buckets=16))
    nth, _ = in_two_runs(spark, work, rows_, lambda s: X.publish_every_n_stream(s, "u", ["t", "id"], "v", 2, buckets=16))
    sums = {u: [sum(r[3] or 0 for r in mine[:k]) for k in range(0, len(mine) + 1, 2)] for u, mine in by_key(rows_).items()}
    key = lambda rs: sorted(rs, key=str)
    assert key(map(tuple, windows.collect())) == key((u, k, b - a) for u, s in sums.items() for k, (a, b) in enumerate(zip(s, s[1:])))
    assert key(map(tuple, nth.collect())) == key((u, 2 * k, total) for u, s in sums.items() for k, total in enumerate(s) if k)
    assert state.count() == 17


def test_idle_keys_of_a_bucket_are_forgotten(spark, work):
    """A key without rows for long enough starts anew, beside keys of its bucket that go on."""
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    for k, (part, pause) in enumerate((([1, 2], 0), ([1], 3), ([1, 2], 0))):
        time.sleep(pause)
        land(spark, folder, [(10 * k + u, str(u), T0 + dt.timedelta(minutes=k), 1) for u in part])
        counts = X.publish_every_n_stream(stream(spark, folder), "u", ["t", "id"], "v", 1, idle_ms=2000, buckets=1)
        counts.writeStream.trigger(once=True).option("checkpointLocation", ckpt).start(out, "parquet", "append").awaitTermination()
    assert rows(spark.read.parquet(out), "u", "alert_count") == [("1", 1), ("1", 2), ("1", 3), ("2", 1), ("2", 1)]


def test_agents_take_keys_together(spark, work):
    """The agent's alerts over two runs; of agents whose time has passed no state stays."""
    rows_ = [(i, u, t, v) for i, u, t, v in many_keys(4000, 1500) if i is not None]
    shape = lambda s: X.fraud_agent_stream(s.withWatermark("t", "1 minute").withColumn("place", c("v").cast("string")), "u", "t", "id", "place", 1, 600)
    got, state = in_two_runs(spark, work, rows_, shape)
    want, epoch = [], dt.datetime(1970, 1, 1)
    for mine in by_key(rows_).values():
        number = {}
        for k, (i, _, t, v) in enumerate(mine):
            window = int((t - epoch).total_seconds()) // 600
            number[window] = number.get(window, 0) + 1
            want += [(i, "high_frequency")] if number[window] > 1 else []
            if k and None not in (v, mine[k - 1][3]) and v != mine[k - 1][3] and (t - mine[k - 1][2]).total_seconds() <= 600:
                want.append((i, "place_change"))
    assert rows(got, "id", "rule") == sorted(want) and {r for _, r in want} == {"high_frequency", "place_change"}
    assert 0 < state.count() <= X.BUCKETS + 1


def test_malformed_and_missing(spark):
    raw = spark.createDataFrame([('{"a":1,"b":"x"}',), ("{oops",), ('{"a":2}',), (None,)], "value string")
    assert rows(R.decode_json(raw, "a int, b string"), "a") == [(1,), (2,)]
    assert rows(R.decode_json(raw, "a int, b string", missing_ok=False), "a") == [(1,)]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        R.decode_json(raw, "a int, b string", ignore_parse_errors=False).collect()


def test_agent_state_expires(spark, work):
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    t0 = dt.datetime(2024, 1, 1, 10)
    batches = [[(1, "u", t0, 1), (2, "u", t0 + dt.timedelta(minutes=5), 2), (3, "u", t0 + dt.timedelta(minutes=6), 2)],
               [(4, "u", t0 + dt.timedelta(minutes=20), 2), (5, "w", t0 + dt.timedelta(hours=9), 7)],
               [(6, "u", t0 + dt.timedelta(hours=10), 9), (7, "u", t0 + dt.timedelta(hours=10, minutes=1), 9)]]
    for part in batches:
        land(spark, folder, part)
        rows_ = stream(spark, folder).withWatermark("t", "1 minute").withColumn("place", c("v").cast("string"))
        K.append_stream(X.fraud_agent_stream(rows_, "u", "t", "id", "place", 2, 3600), out, ckpt)
    # the place moved at 2; 3 and 4 are beyond two in the hour; hours later nothing is remembered
    assert rows(spark.read.parquet(out), "id", "rule") == [(2, "place_change"), (3, "high_frequency"), (4, "high_frequency")]


def late_parts(rows_, minutes=20):
    """Three parts in which rows come up to so many minutes after their time, and a last one far ahead."""
    arrival = lambda r: r[2] + dt.timedelta(minutes=(r[0] * 37) % minutes)
    come = sorted(rows_, key=arrival)
    n = len(come) // 3
    return [come[:n], come[n:2 * n], come[2 * n:], [(-1, "marker", FAR, 0)]]


def mixed(n=90):
    """Few rows a minute apart at places, hours apart at others; NULL keys, equal times."""
    return [(i, None if i % 17 == 3 else "hot" if i % 3 else f"u{i % 2}", T0 + dt.timedelta(seconds=(i // 10) * 9000 + (i % 10 // 2) * 400), i % 7) for i in range(n)]


def test_asof_stream_over_three_parts(spark, work):
    """Versions that come late within the watermark count; only the newest closed version of a key stays in the state."""
    rows_, out, ckpt = mixed(), work("out"), work("ckpt")
    sides = {"l": [r for r in rows_ if r[3] < 3], "r": [r for r in rows_ if r[3] >= 3]}
    folders = {name: work(name) for name in sides}
    parts = late_parts(rows_)
    cols = {"vid": "id", "v2": "v"}
    for k in range(4):
        for name, side in sides.items():
            land(spark, folders[name], [r for r in parts[k] if r in side or r[0] < 0])
        left, right = (stream(spark, folders[n]) for n in ("l", "r"))
        K.append_stream(asof_lookup_stream(left, right, "u", "t", "t", cols, "id", "id", "25 minutes", 1800), out, ckpt)
    left, right = (spark.createDataFrame(sides[n], DDL) for n in ("l", "r"))
    want = J.asof_lookup(left, right, "u", "t", "t", cols, "id", "id")
    key = lambda df: sorted((tuple(r[x] for x in ("id", "u", "t", "v", "vid", "v2")) for r in df.collect()), key=str)
    assert key(spark.read.parquet(out).where("id >= 0")) == key(want) and want.where("vid IS NOT NULL").count() > 10
    state = spark.read.format("statestore").option("stateVarName", "waiting").load(ckpt)
    assert state.count() <= 2  # the marker's own pane; nothing of the closed ones
    newest = spark.read.format("statestore").option("stateVarName", "newest").load(ckpt)
    assert newest.count() == len({r[1] for r in sides["r"]} - {None})


def test_live_sessions_over_restarts(spark, work):
    """The last change of every session is the batch's session, also where late rows join two or move a start."""
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    parts = late_parts(mixed())
    end, minutes = max(r[2] for r in parts[0]), lambda m: dt.timedelta(minutes=m)
    parts[0] += [(200, "m", end - minutes(16), 1), (201, "m", end, 2)]
    parts[1] += [(222, "m", end - minutes(8), 3), (223, "m", end - minutes(20), 4)]  # one joins the two, one moves the start
    rows_ = [r for part in parts[:3] for r in part]
    for part in parts:
        land(spark, folder, part)
        K.append_stream(session_changes(stream(spark, folder), "u", "t", "id", "v", 600, "25 minutes"), out, ckpt)
    changes = spark.read.parquet(out).where("u IS NULL OR u != 'marker'")
    got = latest_sessions(changes, "u")
    batch = X.session_tracker(spark.createDataFrame(rows_, DDL), "u", "t", "id", "v", 600)
    key = lambda df: sorted((tuple(map(str, (r[x] for x in ("u", "session_start", "last_seen", "actions", "last_action")))) for r in df.collect()))
    assert key(got) == key(batch) and {r.state for r in got.collect()} == {"closed"}
    assert changes.where("state = 'merged'").count() >= 2
    assert changes.where("state = 'open'").count() == len(rows_)  # every row is a change


@pytest.mark.parametrize("parts, pane", [(1, 900), (3, 20_000)])
def test_fraud_stream_is_the_batch(spark, work, parts, pane):
    """Also where a pane is longer than a window, so that rows wait while the watermark passes what they need."""
    limits = FR.Limits(count=3, count_window=3600, value=9.0, total=12.0, total_window=7200, merchants=2, full_value=20.0, total_span=50.0, parts=parts)
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    rows_ = mixed(150)

    def txns(df):
        return df.select("id", c("u").alias("user"), c("t").alias("ts"), (c("v") * 1.7).alias("amount"),
                         F.when(c("id") % 11 != 4, (c("id") % 4).cast("string")).alias("country"), F.when(c("id") % 5 > 0, (c("id") % 5).cast("string")).alias("merchant"))
    for part in late_parts(rows_):
        land(spark, folder, part)
        K.append_stream(FR.fraud_rules_stream(txns(stream(spark, folder)), limits, "25 minutes", pane), out, ckpt)
    want = FR.fraud_rules(txns(spark.createDataFrame(rows_, DDL)), limits, chunk=7)
    key = lambda df: sorted((tuple(map(str, r)) for r in df.select("id", "user", "ts", "rule", "detail", "risk").collect()))
    assert key(spark.read.parquet(out).where("id >= 0")) == key(want)
    assert {r.rule for r in want.collect()} == {"country_hop", "high_value", "spending_velocity", "high_frequency", "merchant_diversity"}


def test_trailing_windows_by_hand(spark):
    """A window of one hour in four parts holds the row's quarter of an hour and the three before."""
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows_ = [(1, "u", at(1), 5.0, "a", "x"), (2, "u", at(14), 1.0, "a", "y"), (3, "u", at(46), 2.0, "a", "x"), (4, "u", at(59), 1.0, None, None),
             (5, "u", at(60), 4.0, "b", "y"), (6, "u", at(200), 1.0, "b", "z")]
    df = spark.createDataFrame(rows_, "id long, user string, ts timestamp, amount double, country string, merchant string")
    got = FR.with_history(df, FR.Limits(count_window=3600, total_window=3600, parts=4), chunk=3)
    assert rows(got, "id", "was", "n", "merchants", "total") == [
        (1, None, 1, 1, 5), (2, "a", 2, 2, 6), (3, "a", 3, 2, 8), (4, "a", 4, 3, 9), (5, None, 3, 3, 7), (6, "b", 1, 1, 1)]


def test_dedup_of_a_chain(spark, work):
    """An id that comes every fifty minutes is never silent for an hour: it counts once, in both forms."""
    chain = [(i, "c", T0 + dt.timedelta(minutes=50 * i), 0) for i in range(8)] + [(20, "c", T0 + dt.timedelta(hours=9), 0), (21, "d", T0, 1), (22, "d", T0 + dt.timedelta(hours=1), 1)]
    batch = X.dedup_stream(spark.createDataFrame(chain, DDL), ["u"], "t", "1 hour")
    assert rows(batch, "id") == [(0,), (20,), (21,)]
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    for part in (chain[:3] + chain[-2:], chain[3:7], chain[7:-2], [(-1, "marker", FAR, 0)]):
        land(spark, folder, part)
        K.append_stream(X.dedup_stream(stream(spark, folder), ["u"], "t", "1 hour", eager=False), out, ckpt)
    assert rows(spark.read.parquet(out).where("id >= 0"), "id") == [(0,), (20,), (21,)]


def test_agent_ignores_unknown_places(spark, work):
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    batches = [[(1, "u", T0, 1), (2, "u", T0 + dt.timedelta(minutes=1), None)], [(3, "u", T0 + dt.timedelta(minutes=2), 1), (4, "u", T0 + dt.timedelta(minutes=3), None)],
               [(5, "u", T0 + dt.timedelta(minutes=4), None), (6, "u", T0 + dt.timedelta(minutes=5), 2), (7, "u", T0 + dt.timedelta(minutes=6), 3)]]
    for part in batches:
        land(spark, folder, part)
        rows_ = stream(spark, folder).withWatermark("t", "1 minute").withColumn("place", c("v").cast("string"))
        K.append_stream(X.fraud_agent_stream(rows_, "u", "t", "id", "place", 99, 3600), out, ckpt)
    assert rows(spark.read.parquet(out), "id", "rule") == [(7, "place_change")]


def test_sets_of_running_columns(spark):
    """Columns with keys of their own agree with plain windows, over chunk borders."""
    rows_ = [(i, "h" if i % 4 else f"k{i % 3}", i // 7, i // 5, None if i % 6 == 0 else f"p{i % 5}", i % 9) for i in range(120)]
    df = spark.createDataFrame(rows_, "id long, k string, b1 long, b2 long, p string, v long").cache()
    got = O.running_sets(O.cut(df, ["k"], ["id"], 9), ["k"], ["id"], {
        "n": (("b1",), "count", F.lit(1)), "s": (("b2",), "sum", c("v")), "was": ((), "before", c("p")), "all": ((), "sum", c("v"))})
    from pyspark.sql import Window
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", F.count("*").over(w.partitionBy("k", "b1")).alias("n"), F.sum("v").over(w.partitionBy("k", "b2")).alias("s"),
                     F.last("p", ignorenulls=True).over(before).alias("was"), F.sum("v").over(w.partitionBy("k")).alias("all"))
    key = lambda d: sorted((tuple(map(str, (r[x] for x in ("id", "n", "s", "was", "all")))) for r in d.collect()))
    assert key(got) == key(want)


def by_buckets(spark, work, shape, state):
    """The result over many keys of rows and a marker, the rows, and how many entries of a state wait before the marker."""
    rows_ = [(i, u, t, None if v is None else v % 13) for i, u, t, v in many_keys(3000, 1201) if i is not None]
    folder, out, ckpt, entries = work("in"), work("out"), work("ckpt"), []
    for part in (rows_, [(-1, -1, FAR, 0)]):
        spark.createDataFrame(part, KEYED).coalesce(3).write.mode("append").parquet(folder)
        K.append_stream(shape(spark.readStream.schema(KEYED).parquet(folder)), out, ckpt)
        entries.append(spark.read.format("statestore").option("stateVarName", state).option("flattenCollectionTypes", False).load(ckpt).count())
    return spark.read.parquet(out), spark.createDataFrame(rows_, KEYED), entries[0]


def all_rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


def test_asof_panes_take_keys_together(spark, work):
    """A state entry per bucket and pane, not per key; -0.0 and 0.0 are one key, NULL keys meet nothing."""
    key = F.when(c("u") < 2, F.when(c("id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0))).otherwise(c("u").cast("double")).alias("u")
    cols = {"vid": "id", "v2": "v"}

    def sides(df):
        df = df.select("id", key, "t", "v")
        return df.where("id % 3 = 0"), df.where("id % 3 != 0")
    got, rows_, entries = by_buckets(spark, work, lambda s: asof_lookup_stream(*sides(s), "u", "t", "t", cols, "id", "id", "25 minutes", 86400), "waiting")
    assert 0 < entries <= 128
    want = J.asof_lookup(*sides(rows_), "u", "t", "t", cols, "id", "id")
    same = lambda df: all_rows(df.where("id >= 0").withColumn("u", c("u") + 0.0))
    assert same(got) == same(want) and want.where("vid IS NOT NULL").count() > 100 and want.where("u IS NULL").count()


def test_live_sessions_take_keys_together(spark, work):
    got, rows_, entries = by_buckets(spark, work, lambda s: session_changes(s, "u", "t", "id", "v", 420, "25 minutes"), "users")
    assert 0 < entries <= 128
    batch = X.session_tracker(rows_, "u", "t", "id", "v", 420).drop("session_no").withColumn("last_action", c("last_action").cast("string"))
    assert all_rows(latest_sessions(got.where("u IS NULL OR u >= 0"), "u").drop("state")) == all_rows(batch)


@pytest.mark.parametrize("parts", [1, 4])
def test_fraud_panes_take_keys_together(spark, work, parts):
    limits = FR.Limits(count=1, count_window=400, value=9.0, total=12.0, total_window=800, merchants=1, full_value=20.0, total_span=50.0, parts=parts)

    def txns(df):
        return df.select("id", c("u").alias("user"), c("t").alias("ts"), (c("v") * 1.7).alias("amount"), (c("id") % 4).cast("string").alias("country"),
                         F.when(c("id") % 5 > 0, (c("id") % 5).cast("string")).alias("merchant"))
    got, rows_, entries = by_buckets(spark, work, lambda s: FR.fraud_rules_stream(txns(s), limits, "25 minutes", 86400), "waiting")
    assert 0 < entries <= 128
    want = FR.fraud_rules(txns(rows_), limits)
    assert all_rows(got.where("id >= 0")) == all_rows(want) and want.select("rule").distinct().count() == 5
