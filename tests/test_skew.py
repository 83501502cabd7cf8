"""Ordered operators against plain windows, with a key that holds a third of all rows.

The plain form draws each key into one task; the operators must give the same rows while
every window over raw rows is cut by chunk.
"""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import joins as J
from tidemill.operators import ordered as O
from tidemill.operators import relational as R

c = F.col


@pytest.fixture(scope="module")
def data(spark):
    """3000 rows; 'hot' has a third, one row has no key, several share a time."""
    rnd = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 17}"), rnd.randrange(0, 40_000), rnd.randrange(100),
             None if i % 4 == 1 else rnd.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string, s long, v int, w int")
    return df.withColumn("t", F.timestamp_seconds("s")).drop("s").persist()


def rows(df, *cols):
    return sorted((tuple(r[x] for x in cols) for r in df.collect()), key=str)


def plain(inclusive=True):
    return Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


@pytest.mark.parametrize("chunk", [1, 4, 40])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(data, chunk, inclusive):
    got = O.running(data, ["k"], ["t", "id"], {
        "s": ("sum", c("w")), "n": ("count", c("w")), "lo": ("min", c("w")), "hi": ("max", c("w")), "z": ("last", c("w"))}, chunk, inclusive)
    w = plain(inclusive)
    want = data.select("id", F.sum("w").over(w).alias("s"), F.count("w").over(w).alias("n"), F.min("w").over(w).alias("lo"),
                       F.max("w").over(w).alias("hi"), F.last("w", ignorenulls=True).over(w).alias("z"))
    cols = ("id", "s", "n", "lo", "hi", "z")
    assert rows(got, *cols) == rows(want, *cols)


def test_running_without_a_key(data):
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = O.running(data, [], ["t", "id"], {"s": ("sum", c("v"))}, 9)
    assert rows(got, "id", "s") == rows(data.select("id", F.sum("v").over(w).alias("s")), "id", "s")


def test_previous_and_following(data):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = data.select("id", F.lag("w").over(w).alias("p"), F.lead("w").over(w).alias("f"))
    assert rows(O.previous(data, ["k"], ["t", "id"], {"p": "w"}, 5), "id", "p") == rows(want, "id", "p")
    assert rows(O.following(data, ["k"], "t", "id", {"f": "w"}, 5), "id", "f") == rows(want, "id", "f")


@pytest.mark.parametrize("chunk", [2, 13])
@pytest.mark.parametrize("seconds", [10, 700])
def test_trailing_range(data, chunk, seconds):
    w = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-seconds * 1_000_000, 0)
    got = O.trailing_range(data, ["k"], "t", seconds, {"s": ("sum", c("w")), "n": ("count", c("w")), "m": ("count", F.lit(1))}, chunk)
    want = data.select("id", F.sum("w").over(w).alias("s"), F.count("w").over(w).alias("n"), F.count("*").over(w).alias("m"))
    assert rows(got, "id", "s", "n", "m") == rows(want, "id", "s", "n", "m")


@pytest.fixture(scope="module")
def bursts(data):
    """A third of the rows belong to one key and share one time."""
    return data.withColumn("t", F.when(c("k") == "hot", F.timestamp_seconds(F.lit(500))).otherwise(c("t"))).persist()


def test_a_hot_key_spreads_over_ranges(data):
    sizes = O.cut(data, ["k"], ["t", "id"], 30).where("k = 'hot'").groupBy("_chunk").count()
    assert sizes.count() >= 8 and sizes.agg(F.max("count")).first()[0] < 250


def test_rows_of_one_key_and_time_are_split(bursts):
    cut = O.cut(bursts, ["k"], ["t", "id"], 30)
    assert cut.where("k = 'hot'").groupBy("_chunk").count().count() > 7 and cut.count() == bursts.count()
    w = plain()
    want = bursts.select("id", F.sum("w").over(w).alias("s"), F.lag("w").over(Window.partitionBy("k").orderBy("t", "id")).alias("p"))
    got = O.running(bursts, ["k"], ["t", "id"], {"s": ("sum", c("w"))}, 30)
    assert rows(got, "id", "s") == rows(want, "id", "s")
    assert rows(O.previous(bursts, ["k"], ["t", "id"], {"p": "w"}, 30), "id", "p") == rows(want, "id", "p")


@pytest.mark.parametrize("chunk", [None, 30])
def test_sessions_and_ranges_of_bursts(bursts, chunk):
    want = O.sessions(bursts, ["k"], "t", 120, {"s": ("sum", c("v"))}, F.lit(0).cast("long"), "last_event")
    got = O.sessions(bursts, ["k"], "t", 120, {"s": ("sum", c("v"))}, chunk, "last_event")
    assert rows(got, "k", "session_start", "session_end", "s") == rows(want, "k", "session_start", "session_end", "s")
    w = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-700 * 1_000_000, 0)
    got = O.trailing_range(bursts, ["k"], "t", 700, {"s": ("sum", c("w"))}, chunk)
    assert rows(got, "id", "s") == rows(bursts.select("id", F.sum("w").over(w).alias("s")), "id", "s")


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_trailing_rows(data, block):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-20, -1)
    got = O.trailing_rows(data, ["k"], ["t", "id"], 20, {"s": F.sum("v"), "n": F.count("v")}, block, 6)
    assert rows(got, "id", "s", "n") == rows(data.select("id", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n")), "id", "s", "n")


@pytest.mark.parametrize("chunk", [1, 5, 30])
def test_sessions(data, chunk):
    w = Window.partitionBy("k").orderBy("t", "id")
    step = F.unix_micros("t") - F.lag(F.unix_micros("t")).over(w)
    marked = data.withColumn("new", (step.isNull() | (step > 120_000_000)).cast("int")).withColumn("sid", F.sum("new").over(w))
    want = marked.groupBy("k", "sid").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.sum("v").alias("s"))
    got = O.sessions(data, ["k"], "t", 120, {"s": ("sum", c("v"))}, chunk, "last_event")
    assert rows(got, "k", "session_start", "session_end", "s") == rows(want, "k", "a", "b", "s")
    assert rows(O.session_ids(data, ["k"], "t", 120, chunk), "id", "session_no") == rows(marked, "id", "sid")


@pytest.mark.parametrize("chunk", [1, 8])
def test_asof(data, chunk):
    left, right = data.where("id % 2 = 0").select("id", "k", "t"), data.where("id % 2 = 1").select("id", "k", "t", "v")
    got = J.asof_lookup(left, right, "k", "t", "t", {"rid": "id", "rv": "v"}, "id", "id", chunk)
    pairs = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k AND b.t <= a.t"), "left")
    want = pairs.groupBy("a.id").agg(F.max(F.struct("b.t", "b.id", "b.v")).alias("m")).select(
        "id", c("m.id").alias("rid"), c("m.v").alias("rv"))
    assert rows(got, "id", "rid", "rv") == rows(want, "id", "rid", "rv")


def test_no_window_over_raw_rows_of_a_whole_key(spark, data):
    """Windows partitioned by the key alone may only see chunk summaries."""
    for df in (O.running(data, ["k"], ["t", "id"], {"s": ("sum", c("v"))}, 4), O.previous(data, ["k"], ["t", "id"], {"p": "v"}, 4)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if re.search(r"Window \[", line) and "_chunk#" not in line:
                raise AssertionError(line)
        assert " Join " not in plan


def test_top_n_is_cut_before_the_shuffle(spark, data):
    plan = R.top_n_per_group(data, ["k"], [c("v").desc(), c("id")], 3)._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.find("Partial"), plan.find("Exchange")
    assert "WindowGroupLimit" in plan and partial > final > 0  # printed top-down: the partial limit is below the exchange
