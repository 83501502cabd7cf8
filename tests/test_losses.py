"""Cases in which rows could be lost, doubled or misread: crossing marks, vanished days, second checkpoints, NULL keys, ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalar as S
from tidemill.functions import udfs as U
from tidemill.operators import aggregates as A
from tidemill.operators import analytic as N
from tidemill.operators import incremental as I
from tidemill.operators import joins as J
from tidemill.operators import quality as Q
from tidemill.operators import sketches
from tidemill.operators import timewindows as W
from tidemill.operators.versioned import VersionedTable
from tidemill.operators.summaries import RetractableSummary as Summary
from tidemill.plans import migrate, reports, semantic, shop
from tidemill.sinks import files
from tidemill.streaming import sinks as K
from tidemill.streaming import stateful as X

c = F.col


def day(n):
    return dt.datetime(2024, 1, n)


def values(df, *cols):
    return sorted((tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()), key=str)


def test_ids_may_fall_while_time_rises(spark, work):
    table, log = VersionedTable(spark, work("t"), ["id"]), I.WatermarkLog(spark, work("log"))
    rows = []
    for i, d in ((900, 1), (5, 2), (7, 2), (3, 4)):
        rows.append((i, day(d)))
        source = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
        I.run_incremental(source, table, log, "p", "id", "ts")
    assert values(table.read(), "id") == sorted([900, 5, 7, 3], key=str)
    assert log.latest("p") == {"max_id": 3, "max_ts": day(4)}


def test_a_range_reload_drops_vanished_rows_only(spark, work):
    path, schema = work("range"), "id int, ts timestamp_ntz"
    part = F.date_format("ts", "yyyy-MM-dd")

    def load(rows, a, b, by=part):
        I.replace_time_range(spark.createDataFrame(rows, schema), path, "ts", F.lit(a), F.lit(b), "part", by)

    def table():
        return values(spark.read.schema(schema + ", part string").parquet(path), "id")

    load([(1, day(1)), (2, day(2)), (3, day(3))], day(1), day(9))
    load([(1, day(1)), (3, day(3))], day(1), day(9))  # the second day is empty at the source
    assert table() == [1, 3]
    load([(4, day(3))], day(3), day(3))
    assert table() == [1, 4]
    path = work("month")
    month = F.date_format("ts", "yyyy-MM")
    load([(1, day(5)), (2, day(20))], day(1), day(31), month)
    load([(3, day(6))], day(1), day(10), month)  # ends inside the month: the 20th stays
    assert table() == [2, 3]


def feed(spark, folder, rows):
    spark.createDataFrame(rows, "k string, v int, n int").coalesce(1).write.mode("append").json(folder)


def test_a_second_checkpoint_skips_and_overwrites_nothing(spark, work):
    table, folder = VersionedTable(spark, work("t"), ["k"]), work("in")
    out, fan = work("batches"), work("fan")
    for i, rows in enumerate([[("a", 1, 1)], [("a", 2, 2), ("b", 5, 1)]]):
        feed(spark, f"{folder}{i}", rows)
        stream = lambda: spark.readStream.schema("k string, v int, n int").json(f"{folder}{i}")  # noqa: B023, E731
        K.upsert_stream(stream(), table, work("ckpt"), "append", order=["n"])
        K.append_batches(stream(), out, work("ckpt"))
        K.fan_out(stream(), {"raw": lambda b: b}, fan, work("ckpt"))
    assert values(table.read(), "k", "v") == [("a", 2), ("b", 5)]
    assert values(spark.read.parquet(out), "k", "v") == [("a", 1), ("a", 2), ("b", 5)]
    assert values(spark.read.parquet(f"{fan}/raw"), "k", "v") == [("a", 1), ("a", 2), ("b", 5)]


def test_null_keys_and_ties_in_an_upserted_table(spark, work):
    table = VersionedTable(spark, work("t"), ["k"])
    table.write(spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int"))
    table.upsert(spark.createDataFrame([(None, 2)], "k string, v int"))
    assert values(table.read(), "k", "v") == sorted([(None, 2), ("a", 1)], key=str)
    folder = work("in")
    feed(spark, folder, [("x", i, (i * 3) % 5) for i in range(5)])
    stream = spark.readStream.schema("k string, v int, n int").json(folder)
    keyed = VersionedTable(spark, work("u"), ["k"])
    with pytest.raises(ValueError):
        K.upsert_stream(stream, keyed, work("ckpt"), "append")
    K.upsert_stream(stream, keyed, work("ckpt"), "append", order=["n"])
    assert values(keyed.read(), "v") == [3]


def test_merges_refuse_or_resolve_doubled_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    for merged in (I.merge_upsert(target, twice, ["k"]), I.merge_when_changed(target, twice, ["k"], ["v"], {})):
        with pytest.raises(Exception, match="several source rows for one key: k=1"):
            merged.collect()
    assert values(I.merge_upsert(target, twice, ["k"], order=[c("v").desc()]), "k", "v") == [(1, "c")]
    assert values(I.merge_when_changed(target, twice, ["k"], ["v"], {}, order=[c("v")]), "k", "v") == [(1, "b")]


def test_weighted_means_take_numbers_as_they_are(spark):
    df = spark.createDataFrame([("g", 10.0, 0.4), ("g", 20.0, 2.5), ("g", None, 9.0), ("g", 5.0, None), ("h", None, 1.0)], "k string, v double, w double")
    want = (10 * 0.4 + 20 * 2.5) / 2.9
    assert U.weighted_mean_partials()(df, ["k"], "v", "w").where("k = 'g'").first().weighted_mean == pytest.approx(want)
    assert df.groupBy("k").agg(A.weighted_avg(c("v"), c("w")).alias("m")).where("k = 'g'").first().m == pytest.approx(want)


def test_profiles_take_numbers_as_they_are(spark):
    df = spark.createDataFrame([(0.004, 1e17), (0.002, 3e17)], "a double, b double")
    got = {r.column_name: r for r in Q.profile(df).collect()}
    assert got["a"]["mean"] == pytest.approx(0.003) and got["a"].stddev == pytest.approx(0.002 / 2 ** 0.5)
    assert got["b"]["mean"] == 2e17
    assert Q.profile(spark.createDataFrame([(float("nan"),)], "a double")).first()["mean"] != 0


def test_null_keys_meet_nothing(spark):
    left = spark.createDataFrame([(1, None, 5), (2, "a", 5)], "id int, k string, s int").withColumn("t", F.timestamp_seconds("s"))
    right = spark.createDataFrame([(1, None, 1, "x"), (2, "a", 2, "y")], "id int, k string, s int, v string").withColumn("t", F.timestamp_seconds("s"))
    assert values(J.asof_lookup(left, right, "k", "t", "t", {"v": "v"}, "id", "id"), "id", "v") == [(1, None), (2, "y")]


def test_surrogate_keys_do_not_collide(spark):
    rows = [("a-b", "c"), ("a", "b-c"), ("_null_", "x"), (None, "x"), ("", "x"), ("1:a", ""), ("a", "1:"), ("-", None), (None, "-"), ("a,b", "c")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(S.surrogate_key(c("a"), c("b")).alias("k")).distinct().count() == len(rows)


def test_missing_periods_end_a_run(spark):
    df = spark.createDataFrame([("k", h, True) for h in (1, 2, 9, 10, 11, 15)], "k string, h int, ok boolean").withColumn(
        "hour", F.timestamp_seconds(c("h") * 3600))
    runs = N.consecutive_condition(df, ["k"], "hour", c("ok"), 2, 3600)
    assert values(runs, "periods") == [2, 3]


def test_an_id_that_returns_later_counts_again(spark):
    rows = [("a", day(1), 1), ("a", day(1), 2), ("a", day(9), 3), ("b", day(2), 4), ("b", day(2) + dt.timedelta(minutes=30), 5)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, n int")
    assert values(X.dedup_stream(df, ["id"], "ts", "1 hour"), "n") == [1, 3, 4]


def test_not_in_with_nulls_on_either_side(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    empty, some, null = (spark.createDataFrame(r, "b int") for r in ([], [(1,)], [(1,), (None,)]))
    assert [values(J.not_in_subquery(df, "a", s, "b"), "a") for s in (empty, some, null)] == [[1, 2, None], [2], []]


def test_a_migration_compares_values(spark):
    rows = spark.createDataFrame([(1, day(1), day(3)), (2, day(2), day(2))], "id int, o timestamp_ntz, s timestamp_ntz")
    held = []
    assert migrate.migrate_with_duration(rows, "o", "s", held.append, lambda: held[-1]).count() == 2
    with pytest.raises(ValueError, match="values"):
        migrate.migrate_with_duration(rows, "o", "s", held.append, lambda: held[-1].withColumn("shipping_duration", F.lit(1)))
    with pytest.raises(ValueError, match="rows"):
        migrate.migrate_with_duration(rows, "o", "s", held.append, lambda: held[-1].limit(1))


def test_epochs_of_any_length(spark):
    df = spark.createDataFrame([("5000",), ("-1000",), ("x",), ("1700000000000",)], "x string")
    got = [r[0] for r in df.select(F.unix_millis(S.coerce_ts(c("x"), S.PLAIN_SECONDS).cast("timestamp"))).collect()]
    assert got == [5000, -1000, None, 1700000000000]


def test_gaps_are_filled_per_key(spark):
    rows = [("a", 1, 5), ("a", 4, 6), ("b", 2, 7), (None, 1, 8), (None, 3, 9)]
    df = spark.createDataFrame([(k, day(d), v) for k, d, v in rows], "k string, w timestamp_ntz, v int")
    got = W.gap_fill(df, "w", "1 day", {"v": 0}, ["k"]).withColumn("d", F.dayofmonth("w"))
    want = [("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("a", 4, 6), ("b", 2, 7), (None, 1, 8), (None, 2, 0), (None, 3, 9)]
    assert values(got, "k", "d", "v") == sorted(want, key=str)


def test_doubled_source_keys_are_refused_or_ordered(spark):
    """One rule for all merges: a batch has one row per key, unless an order says which one counts."""
    dim = spark.createDataFrame([(1, "a", day(1), None, True), (2, "b", day(1), None, True)], "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "p", 1), (3, "q", 2)], "k int, v string, seq int")
    order, now = [c("seq").desc()], F.lit(day(5)).cast("timestamp_ntz")
    versions = I.scd2_apply(dim, twice, "k", ["v"], now, order)
    assert values(versions.where("is_current"), "k", "v") == [(1, "y"), (2, "b"), (3, "q")]
    assert versions.where("k = 1").count() == 2
    target = spark.createDataFrame([(1, "a", False, None), (2, "b", False, None)], "k int, v string, is_deleted boolean, deleted_ts timestamp_ntz")
    merged = I.merge_soft_delete(target, twice.drop("seq").dropDuplicates(["k"]), "k", now)
    assert values(merged, "k", "is_deleted") == [(1, False), (2, True), (3, False)]
    assert values(I.merge_soft_delete(target.withColumn("seq", F.lit(0)), twice, "k", now, order), "k", "v", "is_deleted") == [(1, "y", False), (2, "b", True), (3, "q", False)]
    old = target.select("k", "v").withColumn("seq", F.lit(0))
    assert values(I.insert_new_only(old, twice, ["k"], order), "k", "v") == [(1, "a"), (2, "b"), (3, "q")]
    for refused in (lambda: I.scd2_apply(dim, twice, "k", ["v"], now), lambda: I.merge_soft_delete(target.withColumn("seq", F.lit(0)), twice, "k", now),
                    lambda: I.insert_new_only(old, twice, ["k"])):
        with pytest.raises(Exception, match="several source rows for one key"):
            refused().collect()


def test_numbers_survive_as_they_are(spark):
    """Neither 0.004 nor 1e17 is taken for money unless a scale says so."""
    df = spark.createDataFrame([("a", 0.004, day(1)), ("a", 0.002, day(1)), ("b", 1e17, day(1))], "p string, v double, t timestamp_ntz")
    want = {"a": 0.006, "b": 1e17}
    near = lambda got: {k: pytest.approx(v, rel=1e-12) for k, v in got.items()} == want
    assert near({r.p: r.total_score for r in N.leaderboard(df, "p", "v", 9).collect()})
    assert near({r.p: r.total_score for r in N.leaderboard_by_period(df, F.trunc("t", "month"), "p", "v", 9).collect()})
    assert near({r.p: r.all_time_score for r in N.windowed_leaderboard(df, "t", "1 day", "p", "v", 9).collect()})
    assert N.player_rank(df, "p", "v", "a").first().place == 2
    assert near({r.p: r.total for r in W.moving_average(df, "t", 3600, 3600, ["p"], "v").collect()})
    few = df.where("p = 'a'")
    assert W.mean_duration_by_hour(few, "t", "t", "v").first().mean_event_time == pytest.approx(0.003)
    assert reports.taxi_summary(few, "v", "v", "v", "v", c("v"), long_trip=1, high_tip_pct=1).first().mean_distance == pytest.approx(0.003)
    assert reports.zone_stats(few, "p", "v", "v", min_distance=0, min_fare=0).first().mean_distance == pytest.approx(0.003)
    calls = df.select(c("p").alias("call"), c("v").alias("delay"), F.lit(1).alias("zip"), c("p").alias("hood"), F.lit("x").alias("city"), "t")
    report = {(r.question, r.label): r.value for r in reports.fire_calls_report(
        calls, "call", "delay", "zip", "hood", "city", "t", slow=1, zips=[1], year=2024, in_city="x").collect()}
    assert report["totals", "low"] == 0.002 and report["totals", "total"] == pytest.approx(1e17) and report["slow_calls", "over 1"] == 1
    model = {"base": "t", "joins": {}, "dimensions": {"p": ("t", "p")}, "measures": {"s": ("t", "sum", "v")}}
    assert near({r.p: r.s for r in semantic.semantic_query({"t": df}, model, ["p"], ["s"]).collect()})


def test_report_on_an_empty_table(spark):
    none = spark.createDataFrame([], "call string, delay double, zip int, hood string, city string, t timestamp_ntz")
    got = {(r.question, r.label): r.value for r in reports.fire_calls_report(
        none, "call", "delay", "zip", "hood", "city", "t", slow=1, zips=[1], year=2024, in_city="x").collect()}
    assert got["totals", "calls"] == 0 and got["slow_calls", "over 1"] == 0


def test_measures_do_not_fan_out(spark):
    """An order counts once per group however many lines it has; what might repeat rows undeclared is refused."""
    lines = spark.createDataFrame([(1, "A", 1.0), (1, "A", 2.0), (1, "B", 3.0), (2, "B", 4.0), (9, "B", 5.0)], "ok int, flag string, price double")
    orders = spark.createDataFrame([(1, 10, 100.0), (2, 10, 200.0), (3, 11, 400.0)], "k int, cust int, total double")
    notes = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "nk int, note string")
    model = {"base": "lines", "joins": {"orders": ("ok = k", "many_to_one"), "notes": ("k = nk", "one_to_many")}, "needs": {"notes": "orders"},
             "keys": {"orders": ["k"]}, "dimensions": {"flag": ("lines", "flag"), "cust": ("orders", "cust"), "note": ("notes", "note")},
             "measures": {"total": ("orders", "sum", "total"), "n": ("orders", "count", "k"), "sales": ("lines", "sum", "price"),
                          "mean": (None, "ratio", ("total", "n")), "most": ("orders", "max", "total")}}
    tables = {"lines": lines, "orders": orders, "notes": notes}
    ask = lambda dims, measures, m=model: sorted((tuple(r) for r in semantic.semantic_query(tables, m, dims, measures).collect()), key=str)
    assert ask(["flag"], ["total", "n", "sales", "mean", "most"]) == [("A", 100.0, 1, 3.0, 100.0, 100.0), ("B", 300.0, 2, 12.0, 150.0, 200.0)]
    assert ask([], ["total", "sales"]) == [(300.0, 15.0)]
    assert ask(["cust"], ["total"]) == sorted([(10, 300.0), (None, None)], key=str)
    assert ask(["note"], ["total"]) == sorted([("x", 100.0), ("y", 100.0), (None, 200.0)], key=str)
    with pytest.raises(semantic.ModelError, match="no key"):  # notes repeat lines, and lines have no declared key
        ask(["note"], ["sales"])
    with pytest.raises(semantic.ModelError, match="no cardinality"):
        ask(["flag"], ["total"], {**model, "joins": {"orders": "ok = k"}})
    assert ask(["flag"], ["most"], {**model, "joins": {"orders": "ok = k"}}) == [("A", 100.0), ("B", 200.0)]
    panels = semantic.semantic_panels(tables, model, ["flag", "cust"], ["sales"])
    assert values(panels, "panel", "label", "sales") == sorted([("flag", "A", 3.0), ("flag", "B", 12.0), ("cust", "10", 10.0), ("cust", None, 5.0)], key=str)
    assert values(semantic.semantic_panels(tables, model, ["flag"], ["total"]), "panel", "label", "total") == [("flag", "A", 100.0), ("flag", "B", 300.0)]


def test_summary_under_inserts_updates_and_deletes(spark, work):
    """After every batch the saved summary is the one rebuilt from the rows that are there."""
    import random
    rng, rows, s = random.Random(4), {}, Summary(spark, work("s"), ["g"], {"total": c("v").cast("decimal(18,2)")}, ["v", "w"], 2)
    for batch in range(4):
        signed = []
        for _ in range(60):
            i = rng.randrange(40)
            if i in rows:
                signed.append((*rows.pop(i), -1))
            if rng.random() < (0.7 if batch < 3 else 0.2):
                rows[i] = (rng.choice(["a", "b", None]), rng.choice([1.5, 2.0, 7.25, None]), rng.choice(["x", "y", None]))
                signed.append((*rows[i], 1))
        for _ in range(2):  # a batch applied twice counts once
            s.apply(spark.createDataFrame(signed, "g string, v double, w string, sign int"), f"b{batch}")
        want = spark.createDataFrame(list(rows.values()) or [("-", None, None)], "g string, v double, w string").where("g IS NULL OR g != '-'").groupBy("g").agg(
            F.count("*").alias("n"), F.sum(c("v").cast("decimal(18,2)")).alias("total"), F.min("v").alias("min_v"), F.max("v").alias("max_v"),
            F.countDistinct("v").alias("distinct_v"), F.min("w").alias("min_w"), F.max("w").alias("max_w"), F.countDistinct("w").alias("distinct_w"))
        cols = [x for x in want.columns if x != "total"]
        assert values(s.read(), *cols) == values(want, *cols)
        money = lambda df: {r.g: float(r.total or 0) for r in df.collect()}
        assert money(s.read()) == money(want)
    with pytest.raises(Exception, match="taken away"):
        s.apply(spark.createDataFrame([("a", 99.0, "q", -1)] * 999, "g string, v double, w string, sign int"), "bad")


def test_retracting_stream(spark, work):
    """After every batch the aggregates equal a recomputation over the current rows; the grouping key may change; old rows are required."""
    schema = "op string, tombstone boolean, before struct<id:int,s:string,v:double>, after struct<id:int,s:string,v:double>"
    folder, ckpt, s = work("in"), work("ckpt"), Summary(spark, work("s"), ["s"], {"total": c("v").cast("decimal(18,2)")}, ["v"])
    r = lambda i, st, v: (i, st, v)
    batches = [[("c", False, None, r(1, "new", 5.0)), ("r", False, None, r(2, "new", 7.0)), ("c", False, None, r(3, "paid", 7.0))],
               [("u", False, r(1, "new", 5.0), r(1, "paid", 6.0)), ("d", False, r(3, "paid", 7.0), None), (None, True, None, None)],
               [("u", False, r(1, "paid", 6.0), r(1, "paid", 9.0)), ("d", False, r(2, "new", 7.0), None)]]
    want = [[("new", 2, 5.0, 7.0, 2, 12.0), ("paid", 1, 7.0, 7.0, 1, 7.0)], [("new", 1, 7.0, 7.0, 1, 7.0), ("paid", 1, 6.0, 6.0, 1, 6.0)], [("paid", 1, 9.0, 9.0, 1, 9.0)]]
    for rows, now in zip(batches, want):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):  # the second run has nothing new
            K.retract_stream(spark.readStream.schema(schema).parquet(folder), s, ["s", "v"], ckpt)
        assert sorted((x.s, x.n, x.min_v, x.max_v, x.distinct_v, float(x.total)) for x in s.read().collect()) == now
    spark.createDataFrame([("d", False, None, None)], schema).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="without its old row"):
        K.retract_stream(spark.readStream.schema(schema).parquet(folder), s, ["s", "v"], ckpt)


def test_dashboard_over_any_range(spark, work):
    """Customers are exact when the range starts and ends within days, at midnight, or lies in one day."""
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i * 37), f"c{i % 7}", "x" if i % 3 else "y", "paid", 1.0 + i % 11) for i in range(250)]
    orders = spark.createDataFrame(rows, "id long, ts timestamp_ntz, customer string, category string, status string, amount double")
    path = work("dash")
    shop.save_dashboard_tables(orders, path)
    for as_of, back in (("2024-01-06 00:00:00", 3 * 86400), ("2024-01-05 13:07:00", 2 * 86400 + 3600), ("2024-01-03 20:00:00", 7200), ("2024-01-04 05:00:00", 30000)):
        end = dt.datetime.fromisoformat(as_of)
        inside = [x for x in rows if end - dt.timedelta(seconds=back) <= x[1] < end]
        got = shop.revenue_dashboard(orders, path, as_of, back).collect()
        pick = lambda q: {x.label: x.value for x in got if x.question == q}
        spent = {}
        for x in inside:
            spent[x[2]] = spent.get(x[2], 0) + x[5]
        assert pick("top_customers") == spent
        assert pick("total")["orders"] == len(inside) and pick("total")["revenue"] == sum(spent.values())
        assert sum(pick("category").values()) == sum(spent.values()) and sum(pick("orders_per_minute").values()) == len(inside)


def test_replay_from_snapshots(spark, work):
    """Equal to the full replay at three times, reading the newest snapshot before and no older day."""
    kinds = ["cart.item_added", "cart.item_removed", "cart.item_quantity_changed", "cart.discount_applied", "cart.discount_removed"]
    rows = [(f"c{i % 4}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 5), i, kinds[i * 7 % 5 if i % 3 else 0], f"p{i % 3}" if i * 7 % 5 < 3 or i % 3 == 0 else None,
             1 + i % 4, 2.5 + i % 5, None if i * 7 % 5 < 3 or i % 3 == 0 else "TEN" if i % 2 else "FIVE", "percentage" if i % 2 else "fixed", 10.0 if i % 2 else 5.0) for i in range(120)]
    flat = spark.createDataFrame(rows, "cart string, ts timestamp_ntz, id long, type string, product string, quantity int, unit_price double, code string, discount_type string, discount_value double")
    log, saved = work("log"), work("snapshots")
    flat.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(log)
    events = spark.read.parquet(log)
    shop.save_cart_snapshots(events, saved, ["2024-01-08 00:00:00", "2024-01-15 12:00:00"])
    cols = ["cart", "item_count", "unique_items", "subtotal", "discount", "total", "discounts", "last_updated"]
    for as_of, days in (("2024-01-05 03:00:00", None), ("2024-01-11 07:00:00", 8), ("2024-01-20 00:00:00", 15)):
        got = shop.cart_replay_from(saved, events, as_of)
        assert values(got, *cols) == values(shop.cart_replay(flat, F.lit(as_of).cast("timestamp_ntz")), *cols)
        if days:
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert f">= 2024-01-{days:02d}" in plan.split("PartitionFilters: [", 1)[1]
            snapshots = {f.split("at=")[1][:15] for f in got.inputFiles() if "at=" in f}
            assert len(snapshots) == 1 and max(n for n in ("20240108T000000", "20240115T120000") if n[:8] <= as_of[:10].replace("-", "")) in snapshots


def test_clustering_by_two_columns(spark, work):
    """A filter on the second column alone meets under a third of the files that a sort by both leaves."""
    rows = spark.range(20_000).select(c("id"), (c("id") * 7919 % 20_011).alias("a"), F.timestamp_seconds(c("id") * 104_729 % 20_021).alias("b"))
    rows = rows.withColumn("b", F.when(c("id") % 500 != 0, c("b")))
    z, linear = work("z"), work("linear")
    files.write_zordered(rows, z, ["a", "b"], 36)
    rows.repartitionByRange(36, "a", "b").sortWithinPartitions("a", "b").write.parquet(linear)
    lo, hi = F.timestamp_seconds(F.lit(5000)), F.timestamp_seconds(F.lit(5400))

    def met(path):
        per = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("b").alias("lo"), F.max("b").alias("hi"))
        return per.where((c("lo") <= hi) & (c("hi") >= lo)).count()
    assert met(z) * 3 < met(linear)
    found = [values(spark.read.parquet(p).where(c("b").between(lo, hi)), "id") for p in (z, linear)]
    assert found[0] == found[1] and found[0] and spark.read.parquet(z).count() == 20_000


def test_merged_sketches_are_the_whole(spark, work):
    """Profiles merged from parts say what one over the whole says; quantiles are within the stated rank error; streams append sketches."""
    df = spark.range(30_000).select((c("id") % 7).alias("part"), F.when(c("id") % 10 != 0, (c("id") * 37 % 9973).cast("double")).alias("v"), (c("id") % 50).cast("string").alias("w"))
    parts = sketches.merge_profiles(sketches.profile_sketches(df, ["v", "w"], ["part"]))
    got = {r.column_name: r for r in sketches.profile_report(parts).collect()}
    one = {r.column_name: r for r in sketches.profile_report(sketches.profile_sketches(df, ["v", "w"])).collect()}
    assert got["v"].row_count == 30_000 and got["v"].null_count == 3000 and (got["w"].min_value, got["w"].max_value) == ("0", "9")
    exact = df.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"), F.countDistinct("v").alias("d")).first()
    assert got["v"].mean == pytest.approx(exact.m) and got["v"].stddev == pytest.approx(exact.s) and abs(got["v"].distinct_count - exact.d) < 0.05 * exact.d
    assert got["w"].distinct_count == 50 == one["w"].distinct_count and got["w"].mean is None and got["w"].p50 is None
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(df.where(c("v") <= got["v"][name]).count() / 27_000 - share) < 0.02
    events = spark.range(5000).select(F.timestamp_seconds(c("id") * 13).alias("t"), (c("id") % 900).alias("u"))
    folder, out, ckpt = work("in"), work("out"), work("ckpt")
    for low in (0, 2500):
        events.where(c("u").isNotNull() & (F.unix_seconds("t") >= low * 13) & (F.unix_seconds("t") < (low + 2500) * 13)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder).withWatermark("t", "0 seconds")
        K.append_stream(sketches.distinct_sketches(stream, "t", "u"), out, ckpt)
    K.append_stream(sketches.distinct_sketches(spark.readStream.schema(events.schema).parquet(folder).withWatermark("t", "0 seconds"), "t", "u"), out, ckpt)
    saved = sketches.merge_sketches(spark.read.parquet(out))
    whole = sketches.distinct_over(saved, None).first().members
    assert abs(whole - 900) < 45
