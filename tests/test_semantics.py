"""Exact answers on small fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import records as X
from tidemill.functions import scalar as S
from tidemill.functions import udfs as U
from tidemill.operators import aggregates as A
from tidemill.operators import cdc as C
from tidemill.operators import incremental as N
from tidemill.operators import joins as J
from tidemill.operators import quality as Q
from tidemill.operators import relational as R
from tidemill.operators import timewindows as W
from tidemill.operators.versioned import VersionedTable
from tidemill.plans import broker as B
from tidemill.plans import semantic as SM
from tidemill.plans import shop as P
from tidemill.session import hadoop_fs
from tidemill.sources import bulkload as L
from tidemill.sources import files as I
from tidemill.sources import increments as K

c = F.col


def values(df, *cols):
    return sorted(tuple(r[x] for x in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect())


def ts(text):
    return dt.datetime.fromisoformat(text)


# ---- late records, colours, seeds

def test_late_filter_keeps_the_boundary(spark):
    t0 = ts("2024-01-01T00:00:00")
    rows = [(i, t0, t0 + dt.timedelta(hours=h)) for i, h in enumerate([0, 3.99, 4, 4.01, 9])]
    df = spark.createDataFrame(rows, "id int, created timestamp, ingested timestamp")
    assert values(R.late_record_filter(df, "created", "ingested", 4), "id") == [0, 1, 2]
    assert values(R.late_record_filter(df, "created", "ingested", 4, "late"), "id") == [3, 4]
    with pytest.raises(ValueError):
        R.late_record_filter(df, "created", "ingested", 4, "some")


def test_colour_counts(spark):
    from tidemill.plans.reports import product_cross_counts
    rows = [("TX", "Red", 20), ("NV", "Blue", 66), ("NV", "Blue", 24), ("CO", "Blue", 79), ("CO", "Blue", 1), ("OR", "Blue", 71), ("WA", "Yellow", 93)]
    df = spark.createDataFrame(rows, "state string, colour string, n int")
    got = [(r.state, r.total) for r in product_cross_counts(df, "state", "colour", c("n")).collect()]
    assert got == [("WA", 93.0), ("NV", 90.0), ("CO", 80.0), ("OR", 71.0), ("TX", 20.0)]
    assert values(product_cross_counts(df, "state", "colour", c("n"), "CO"), "total") == [80.0]


def test_orders_per_item_of_the_seed(spark, work):
    path = work("seed")
    rows = [(1, 2, "2020-01-01"), (2, 1, "2020-01-01"), (3, 3, "2020-01-03"), (4, 1, "2020-01-04"), (5, 1, "2020-01-05"), (6, 1, "2020-01-06"), (7, 1, "2020-01-07")]
    spark.createDataFrame(rows, "id int, item_id int, event_date string").write.option("header", True).csv(path)
    seed = I.load_seed(spark, path, "id int, item_id int, event_date date", ["id"])
    model = A.group_agg(seed, ["item_id"], num_orders=F.countDistinct("id"))
    assert values(model, "item_id", "num_orders") == [(1, 5), (2, 1), (3, 1)]
    with pytest.raises(ValueError):
        I.load_seed(spark, path, "id int, item_id int, event_date date", ["item_id"])


def test_null_counts_and_clean_rows(spark):
    rows = [(1, "a", 1.0, "ok"), (2, "b", None, "ok"), (None, "c", 3.0, "ok"), (4, "d", 4.0, None), (5, "e", 5.0, "ok")]
    df = spark.createDataFrame(rows, "user_id int, at string, amount double, status string")
    assert dict((r.column_name, r.null_count) for r in A.null_counts(df).collect()) == {"user_id": 1, "at": 0, "amount": 1, "status": 1}
    assert R.filter_finite(df, "amount", "user_id", "status", ["ok"]).count() == 2


# ---- functions

def test_mask_email(spark):
    rows = [("alice@example.com",), ("a@b.com",), ("@x.com",), ("nobody",), (None,), ("ab@c.de",)]
    want = ["a***@example.com", "a@b.com", "@x.com", "nobody", None, "a***@c.de"]
    df = spark.createDataFrame(rows, "e string").coalesce(1)
    assert [r[0] for r in df.select(S.mask_email(c("e"))).collect()] == want
    assert [r[0] for r in df.select(U.mask_email_udf()("e")).collect()] == want


def test_hash_partition_takes_the_whole_digest(spark):
    import hashlib
    keys = ["a", "user-17", "", "é", "x" * 200]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for r in df.select("k", S.hash_partition(c("k"), 7).alias("s"), S.hash_partition(c("k"), 7, "md5").alias("m")).collect():
        assert r.s == int(hashlib.sha256(r.k.encode()).hexdigest(), 16) % 7
        assert r.m == int(hashlib.md5(r.k.encode()).hexdigest(), 16) % 7


def test_coerce_ts_and_bool(spark):
    rows = [("1700000000000",), ("2023-11-14T22:13:20",), ("11/14/2023",), ("11/14/2023 10:13:20 PM",), ("junk",), ("15/04/2023",), (None,)]
    df = spark.createDataFrame(rows, "x string").coalesce(1)
    got = [str(r[0]) for r in df.select(S.coerce_ts(c("x"), S.ISO_SECONDS, S.US_DATE, S.US_STAMP).cast("timestamp_ntz")).collect()]
    assert got == ["2023-11-14 22:13:20", "2023-11-14 22:13:20", "2023-11-14 00:00:00", "2023-11-14 22:13:20", "None", "None", "None"]
    flags = spark.createDataFrame([(x,) for x in ["t", "F", "TRUE", "1", "0", "MAYBE", None]], "x string").coalesce(1)
    assert [r[0] for r in flags.select(S.bool_decode(c("x"))).collect()] == [True, False, True, True, False, None, None]


def test_transforms(spark):
    df = spark.createDataFrame([(1, "x", True, None)], "a int, b string, f boolean, n int")
    out = df.transform(X.chain(X.mask_field("a", "b", "f"), X.insert_field("s", "k"), X.replace_field({"a": "id"}, exclude=["n"]))).first()
    assert out.asDict() == {"id": 0, "b": "", "f": False, "s": "k"}
    nested = spark.createDataFrame([((1, ("x", 2)),)], "a struct<id:int,addr:struct<city:string,no:int>>")
    assert nested.transform(X.flatten()).columns == ["a_id", "a_addr_city", "a_addr_no"]
    kept = spark.createDataFrame([(1,), (None,)], "v int").transform(X.filter_predicate(c("v") == 1))
    assert [r.v for r in kept.collect()] == [None]


# ---- joins

def test_not_in_with_null_gives_nothing(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert J.not_in_subquery(a, "k", b, "k").count() == 0
    assert values(J.anti_join_new(a, b, ["k"]), "k") == [2]


def test_interval_join_bounds_are_inclusive(spark):
    t0 = ts("2024-01-01T10:00:00")
    left = spark.createDataFrame([(1, t0)], "k int, lt timestamp")
    right = spark.createDataFrame([(1, t0 - dt.timedelta(seconds=s), s) for s in (-1, 0, 1800, 3600, 3601)], "j int, rt timestamp, s int")
    assert values(J.interval_join(left, right, [("k", "j")], "lt", "rt", -3600, 0), "s") == [0, 1800, 3600]
    assert values(J.window_join(left, right, [("k", "j")], "lt", "rt", 1), "s") == [-1, 0]


# ---- windows

def test_session_edge(spark):
    rows = [("u", ts(f"2024-01-01T{x}")) for x in ("00:00:00", "00:05:00", "00:10:01")]
    df = spark.createDataFrame(rows, "u string, t timestamp")
    out = W.session(df, "t", 300, ["u"], {"n": ("count", F.lit(1))}).orderBy("session_start").collect()
    assert [(str(r.session_start.time()), str(r.session_end.time()), r.n) for r in out] == [
        ("00:00:00", "00:10:00", 2), ("00:10:01", "00:15:01", 1)]
    last = W.session(df, "t", 300, ["u"], {"n": ("count", F.lit(1))}, end="last_event").orderBy("session_start").collect()
    assert [r.duration_s for r in last] == [300.0, 0.0]


def test_session_across_chunk_borders(spark):
    """A session that runs over midnight stays one, whatever the chunk."""
    t0 = ts("2024-01-01T23:50:00")
    rows = [("u", t0 + dt.timedelta(minutes=4 * i)) for i in range(40)] + [("u", t0 + dt.timedelta(hours=30))]
    df = spark.createDataFrame(rows, "u string, t timestamp")
    for chunk in (1, 3, 7):
        got = values(W.session(df, "t", 300, ["u"], {"n": ("count", F.lit(1))}, chunk=chunk), "n")
        assert got == [1, 40]


# ---- change data

ROW = "id:bigint,status:string"


def test_fold_with_delete_and_tombstone(spark):
    log = [("1", '{"payload":{"op":"c","after":{"id":1,"status":"a"}}}', 0), ("2", '{"op":"r","after":{"id":2,"status":"b"}}', 1),
           ("1", '{"op":"u","before":{"id":1,"status":"a"},"after":{"id":1,"status":"z"}}', 2),
           ("2", '{"op":"d","before":{"id":2,"status":"b"}}', 3), ("2", None, 4)]
    p = C.parse_envelope(spark.createDataFrame(log, "key string, value string, pos int"), ROW)
    assert values(C.apply_changelog(p, "key", ["pos"], ["id", "status"]), "id", "status") == [(1, "z")]
    signed = C.signed_rows(p, ["status"]).groupBy("status").agg(F.sum("sign").alias("n")).where("n != 0")
    assert values(signed, "status", "n") == [("z", 1)]
    assert values(C.diff_before_after(p, ["id", "status"]).select(F.explode("changes").alias("x")).select("x.*"), "field", "old", "new") == [("status", "a", "z")]


def test_envelope_reasons(spark):
    rows = [('{"garbage": "x"}', "no_operation"), ("{oops", "not_json"), ('{"op":"x"}', "unknown_operation:x"),
            ('{"op":"c","after":null}', "no_after_row:c"), ('{"op":"d"}', "no_before_row:d"),
            ('{"op":"u"}', None), (None, None), ('{"payload":{"op":"r","after":{"id":1}}}', None)]
    df = spark.createDataFrame(rows, "value string, want string").coalesce(1)
    assert all(r.error_reason == r.want for r in C.validate_envelope(df).collect())
    strict = C.validate_envelope(df, strict=True).where("want IS NULL AND error_reason IS NOT NULL").collect()
    assert [r.error_reason for r in strict] == ["no_after_row:u"]


def test_row_level_and_field_level_merge(spark):
    east = spark.createDataFrame([(1, "a@x", 5, "Ann", 1)], "id int, email string, email_ts int, name string, name_ts int")
    west = spark.createDataFrame([(1, "a@y", 3, "Anna", 4)], "id int, email string, email_ts int, name string, name_ts int")
    got = C.merge_replicas_lww([("e", east), ("w", west)], "id", "", ["email", "name"], field_level=True).first()
    assert (got.email, got.name, got.lost) == ("a@x", "Anna", 2)


# ---- loads

USERS = T.StructType([T.StructField("UserId", T.StringType(), False), T.StructField("IsActive", T.BooleanType()),
                      T.StructField("CreatedAt", T.TimestampType())])


def bad_users():
    good = "2023-04-15 13:10:07"
    rows = [(f"U-{1000 + i}", "TRUE", good) for i in range(15)]
    rows[3] = ("U-1003", "MAYBE", good)
    rows[6] = ("U-1006", "TRUE", "15/04/2023 13:10:07")
    rows[10] = ("U-1010", "1", good)
    rows[12] = ("U-1012", "FALSE", "NOT-A-DATE")
    return rows


def test_bulk_load(spark, work):
    src, table, ledger = work("src"), work("table"), work("ledger")
    spark.createDataFrame(bad_users(), "UserId string, IsActive string, CreatedAt string").coalesce(1).write.option("header", True).csv(src)
    with pytest.raises(L.LoadAborted):
        L.copy_into(spark, src, table, ledger, USERS)
    assert not hadoop_fs(spark, table)[0].exists(hadoop_fs(spark, table)[1])
    first = L.copy_into(spark, src, table, ledger, USERS, on_error="CONTINUE", load_id="1").collect()
    assert [(r.parsed, r.loaded, r.errors, r.status) for r in first] == [(15, 12, 3, "PARTIALLY_LOADED")]
    assert first[0].first_error == "IsActive=MAYBE"
    rejects = spark.read.parquet(f"{table}_rejects")
    assert values(rejects, "row_number", "column_name") == [(4, "IsActive"), (7, "CreatedAt"), (13, "CreatedAt")]
    again = L.copy_into(spark, src, table, ledger, USERS, on_error="CONTINUE", load_id="2").collect()
    assert [r.status for r in again] == ["LOAD_SKIPPED"] and spark.read.parquet(table).count() == 12
    L.copy_into(spark, src, table, ledger, USERS, on_error="CONTINUE", force=True, load_id="3")
    assert spark.read.parquet(table).count() == 24
    assert L.validate_load(spark, src, USERS).count() == 3
    assert L.validate_load(spark, src, USERS, mode="rows", n=5).count() == 5


def test_merge_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = N.merge_upsert(base, batch, ["k"])
    assert values(once, "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert values(N.merge_upsert(once, batch, ["k"]), "k", "v") == values(once, "k", "v")


def test_merge_only_when_something_changed(spark):
    base = spark.createDataFrame([(1, "a", None, 0), (2, "b", 1, 0)], "k int, v string, w int, run int")
    same = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, "n", 1)], "k int, v string, w int")
    got = N.merge_when_changed(base, same, ["k"], ["v", "w"], {"run": F.lit(1)})
    assert values(got, "k", "run", "merge_action") == [(1, 0, "keep"), (2, 1, "update"), (3, 1, "insert")]


def test_soft_delete_and_return(spark):
    base = spark.createDataFrame([(1, "a", False, None), (2, "b", True, "old"), (3, "c", False, None), (4, "d", True, "old")],
                                 "k int, v string, is_deleted boolean, deleted_ts string")
    snapshot = spark.createDataFrame([(1, "a2"), (2, "b2"), (None, "x")], "k int, v string")
    got = {r.k: (r.v, r.is_deleted, r.deleted_ts) for r in N.merge_soft_delete(base, snapshot.where("k IS NOT NULL"), "k", F.lit("now")).collect()}
    assert got == {1: ("a2", False, None), 2: ("b2", False, None), 3: ("c", True, "now"), 4: ("d", True, "old")}


def test_scd2_intervals_do_not_overlap(spark):
    days = [ts(f"2024-01-{d:02d}T00:00:00") for d in range(1, 9)]
    log = [("k", "ABBACCAA"[i], days[i], i) for i in range(8)]
    hist = N.scd2_history(spark.createDataFrame(log, "k string, v string, at timestamp, n int"), "k", ["v"], "at", "n", chunk=2)
    rows = sorted(hist.collect(), key=lambda r: r.valid_from)
    assert [r.v for r in rows] == ["A", "B", "A", "C", "A"]
    assert all(a.valid_to == b.valid_from for a, b in zip(rows, rows[1:])) and rows[-1].valid_to is None
    assert [r.is_current for r in rows] == [False] * 4 + [True]
    facts = spark.createDataFrame([("k", days[2], 1), ("k", days[0] - dt.timedelta(days=1), 2), ("z", days[3], 3)], "f string, sold timestamp, id int")
    found = N.scd2_lookup(facts, hist, "f", "sold", "id", "k", ["v"])
    assert {r.id: r.v for r in found.collect()} == {1: "B", 2: None, 3: None}


def test_versioned_table(spark, work):
    t = VersionedTable(spark, work("v"), ["k"])
    t.write(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "b0")
    t.upsert(spark.createDataFrame([(3, "C")], "k int, v string"), "b1")
    want = [(1, "a"), (2, "B"), (3, "C")]
    assert values(t.read(), "k", "v") == want and t.has_tag("b1") and not t.has_tag("b2")
    assert values(t.read(2), "k", "v") == [(1, "a"), (2, "B"), (3, "c")] and values(t.read(1), "k", "v") == [(1, "a"), (2, "b")]
    t.compact()
    assert values(t.read(), "k", "v") == want and t.deltas() == 0
    half = f"{t.path}/v00000099"  # a writer that died: no _SUCCESS
    spark.createDataFrame([(9, "x")], "k int, v string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    fs, p = hadoop_fs(spark, half + "/_SUCCESS")
    fs.delete(p, False)
    assert values(t.read(), "k", "v") == want
    t.expire(1)
    assert t.versions() == [4]


def test_incremental_modes(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "id int, ts int")
    state = K.high_water(df.where("id <= 1"), "id", "ts")
    assert state == {"max_ts": 10, "max_id": 1}
    assert values(K.read_increment(df, "timestamp+incrementing", "id", "ts", state), "id") == [2, 3]
    assert values(K.read_increment(df, "timestamp", "id", "ts", state), "id") == [3]
    assert K.read_increment(df, "bulk").count() == 3 and K.high_water(df.where("id > 9"), "id", "ts") == {}


def test_jdbc_options():
    bounds = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 8}
    got = K.jdbc_options("jdbc:x", "SELECT * FROM t", bounds)
    assert got["dbtable"] == "(SELECT * FROM t) q" and got["numPartitions"] == "8" and "query" not in got
    assert K.jdbc_options("jdbc:x", "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        K.jdbc_options("jdbc:x", "t", {"partitionColumn": "id"})


# ---- files

def test_null_tokens_and_bom(spark, work):
    path = work("csv")
    spark.createDataFrame([("﻿ID,NAME",), ("1,null",), ("NULL,b",), ("x,",)], "l string").coalesce(1).write.text(path)
    got = I.read_csv_format(spark, path, T.StructType.fromDDL("id int, name string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, None), (None, "b"), (None, None)], key=str)
    assert I.read_csv_inferred(spark, path).columns == ["ID", "NAME"]


def test_row_numbers(spark, work):
    path = work("lines")
    spark.range(100).coalesce(1).write.option("header", True).csv(path)
    rows = I.with_lineage(spark.read.schema("id int").option("header", True).csv(path), "l1").collect()
    assert all(r.row_number == r.id + 1 for r in rows)


# ---- quality

def people(spark):
    rows = [(1, "Alice", "a@x.com", 30, "2022-01-15", "Female"), (2, "Bob", "b@x.com", 25, "2022-14-01", "Male"),
            (3, "Charlie", "c@x.com", None, "2022-03-01", "Femail"), (4, "Joanna", "j@x.com", 30, "2022-01-15", "Female"),
            (5, "Eve", None, 200, "2022-02-30", "Female"), (None, "Frank", "f@x.com", 28, "2022-05-20", "F")]
    return spark.createDataFrame(rows, "id int, name string, email string, age int, signup_date string, gender string")


PEOPLE_CHECKS = [{"name": "id", "function": "is_not_null", "arguments": {"col": "id"}},
                 {"name": "age", "function": "is_in_range", "arguments": {"col": "age", "lo": 10, "hi": 100}},
                 {"name": "date", "function": "is_valid_date", "arguments": {"col": "signup_date"}},
                 {"name": "gender", "function": "is_in_list", "arguments": {"col": "gender", "allowed": ["Female", "Male"]}}]


def test_quarantine(spark):
    valid, bad = Q.split(people(spark), PEOPLE_CHECKS)
    assert values(valid, "id") == [1, 4]
    assert {r.id for r in bad.collect()} == {2, 3, 5, None}
    checked = Q.apply_checks(people(spark), Q.checks_from_metadata(PEOPLE_CHECKS))
    assert {r.check_name: r.failed_rows for r in Q.failure_summary(checked).collect()} == {"id": 1, "age": 1, "date": 2, "gender": 2}
    with pytest.raises(Q.QualityError, match="'date': 2"):
        Q.validate_or_raise(people(spark), Q.checks_from_metadata(PEOPLE_CHECKS))


def test_custom_check_joins_the_set(spark):
    Q.register_check("is_adult", lambda col: F.coalesce(F.col(col) < 18, F.lit(False)))
    checks = Q.checks_from_metadata([{"name": "adult", "function": "is_adult", "arguments": {"col": "age"}, "criticality": "warn"}])
    assert Q.get_valid(Q.apply_checks(people(spark), checks)).count() == 6


def test_schema_drift_modes(spark):
    v1 = T.StructType.fromDDL("a int, b string")
    v2 = T.StructType.fromDDL("a bigint, c string")
    state = lambda m: {n: ok for n, _, ok in Q.schema_drift(v1, v2, m)}
    assert state("backward") == {"a": True, "b": True, "c": True}
    assert state("forward") == {"a": False, "b": True, "c": True}
    strict = T.StructType([*v1.fields, T.StructField("d", T.StringType(), False)])
    assert dict((n, ok) for n, _, ok in Q.schema_drift(v1, strict, "backward")) == {"d": False}
    assert Q.schema_drift_gate(spark.createDataFrame([(1, "x")], v1), v1).first().change == "none"


def test_audit_raises(spark):
    df = spark.createDataFrame([(-1,)], "id int")
    with pytest.raises(Q.QualityError):
        Q.audit(spark, "SELECT * FROM {d} WHERE id < 0", d=df)
    Q.audit(spark, "SELECT * FROM {d} WHERE id > 0", d=df)


def test_profile_sketch_is_close(spark):
    df = spark.range(5000).withColumn("v", c("id") % 100)
    got = {r.column_name: r.distinct_count for r in Q.profile(df, exact=False).collect()}
    assert abs(got["id"] - 5000) < 500 and abs(got["v"] - 100) < 10


# ---- carts, dashboards, broker, semantic layer

def cart_events(spark):
    t = [ts(f"2024-01-01T00:0{i}:00") for i in range(5)]
    rows = [("C-50", t[0], 1, "cart.created", None, None, None, None, None, None),
            ("C-50", t[1], 2, "cart.item_added", "Blue T-Shirt", 1, 25.0, None, None, None),
            ("C-50", t[2], 3, "cart.item_added", "Black Jeans", 1, 60.0, None, None, None),
            ("C-50", t[3], 4, "cart.item_quantity_changed", "Blue T-Shirt", 3, None, None, None, None),
            ("C-50", t[4], 5, "cart.discount_applied", None, None, None, "SAVE10", "percentage", 10.0)]
    ddl = ("cart string, ts timestamp, id int, type string, product string, quantity int, unit_price double, code string, "
           "discount_type string, discount_value double")
    return spark.createDataFrame(rows, ddl), t


def test_cart_replay(spark):
    events, t = cart_events(spark)
    totals = [P.cart_replay(events, F.lit(x)).first().total for x in t]
    assert totals == [0.0, 25.0, 85.0, 135.0, 121.5]
    end = P.cart_replay(events).first()
    assert (end.item_count, end.unique_items, end.subtotal, end.discount, end.discounts) == (4, 2, 135.0, 13.5, "SAVE10")


def test_alert_states(spark):
    t0 = ts("2024-01-01T00:00:00")
    rows = [(t0 + dt.timedelta(minutes=i), v) for i, v in enumerate([20, 5, 5, 20, 5, 5, 5])]
    periods = spark.createDataFrame(rows, "window_start timestamp, revenue int")
    at = lambda m: P.alert_states(periods, {"low": (c("revenue") < 10, 3)}, [F.lit(t0 + dt.timedelta(minutes=m))]).first().state
    assert [at(1), at(3), at(4), at(6), at(7)] == ["normal", "pending", "normal", "pending", "firing"]


def test_lag_levels(spark):
    ends = spark.createDataFrame([("t", 0, 20_000), ("t", 1, 1500), ("t", 2, 10)], "topic string, part int, end_offset long")
    commits = spark.createDataFrame([("g", "t", 0, 0), ("g", "t", 1, 0), ("g", "t", 2, 50)], "grp string, topic string, part int, committed long")
    got = {r.part: (r.lag, r.level) for r in B.consumer_lag(ends, commits).collect()}
    assert got == {0: (20_000, "high"), 1: (1500, "elevated"), 2: (0, "ok"), -1: (21_500, "high")}


def test_semantic_joins_only_what_is_used(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "k int, v double"), spark.createDataFrame([(1, "x")], "k2 int, n string")
    model = {"base": "a", "joins": {"b": ("k = k2", "many_to_one")}, "dimensions": {"name": ("b", "n"), "key": ("a", "k")}, "measures": {"sum": ("a", "sum", "v")}}
    plan = SM.semantic_query({"a": a, "b": b}, model, ["key"], ["sum"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert SM.semantic_query({"a": a, "b": b}, model, ["name"], ["sum"]).first().sum == 2.0
    with pytest.raises(SM.ModelError):
        SM.semantic_query({"a": a, "b": b}, model, ["nope"], ["sum"])


def test_exact_median(spark):
    rows = [("a", x) for x in (1.0, 2.0, 2.0, 9.0)] + [("b", x) for x in (5.0, 1.0, 3.0)] + [("c", None)]
    got = {r.k: r.median for r in A.exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got["a"] == 2.0 and got["b"] == 3.0


def test_topk_keeps_duplicates_only_when_asked(spark):
    df = spark.createDataFrame([("a", x) for x in (5, 5, 4, 3)], "k string, v int")
    assert A.topk(df, ["k"], "v", 3).first().top == [5, 5, 4]
    assert A.topk(df, ["k"], "v", 3, distinct=True).first().top == [5, 4, 3]


def test_money_sum_is_exact(spark):
    from tidemill.functions.exact import exact_sum
    df = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert df.agg(exact_sum("v", 2)).first()[0] == 1.0
    assert df.select(S.to_money(F.lit(1.005))).first()[0] == Decimal("1.01")
