"""What the optimizer makes of the queries: pruning, pushdown, and no joins of everything with everything."""

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tidemill import bindings
from tidemill.bindings import Tables
from tidemill.plans import migrate
from tidemill.sinks import files as K
from tidemill.sources import files as R

LAZY = sorted(n for n in bindings.QUERIES if n.startswith(("prj", "jon", "agg", "ana", "win", "set", "srt", "trx", "fun", "dq", "cdc", "dom"))
              and n not in ("agg_17_running_totals",) and not n.endswith("_stream"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product_and_no_python(spark, name):
    plan = plan_of(bindings.QUERIES[name](spark, TESTDATA))
    assert "CartesianProduct" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert "BroadcastNestedLoopJoin" not in plan, plan


def test_column_pruning(spark):
    plan = plan_of(bindings.QUERIES["src_05_read_parquet_cols"](spark, TESTDATA))
    columns = plan.split("FileScan parquet [")[1].split("]")[0]
    assert "l_tax#" not in columns and "l_returnflag#" not in columns and "l_shipdate#" in columns


def test_filter_pushdown(spark):
    plan = plan_of(bindings.QUERIES["prj_03_filter_compare"](spark, TESTDATA))
    assert "GreaterThan(o_tot" in plan.split("PushedFilters: ")[1]


def test_partition_pruning(spark, work):
    path = work("p")
    K.write_partitioned(Tables(spark, TESTDATA).orders, path, ["o_orderstatus"])
    df = R.read_partitioned(spark, path, F.col("o_orderstatus") == "F")
    assert "o_orderstatus#" in plan_of(df).split("PartitionFilters: [")[1].split("]")[0]


def test_layouts_read_less(spark, work):
    path, t = work("layouts"), Tables(spark, TESTDATA)
    migrate.write_three_ways(t.orders, path, "o_orderdate", "o_orderpriority")
    lo, hi = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1998-02-28 00:00:00").cast("timestamp_ntz")
    found, parts = {}, {}
    for layout in ("plain", "partitioned", "clustered"):
        df = migrate.tag_search(spark, path, layout, "o_orderdate", lo, hi, "o_orderpriority", "2-HIGH")
        found[layout] = sorted(r.o_orderkey for r in df.collect())
        parts[layout] = {f.split("month=")[1][:7] for f in df.select("_metadata.file_path").distinct().toPandas()["file_path"] if "month=" in f}
    assert found["plain"] == found["partitioned"] == found["clustered"] and found["plain"]
    assert parts["partitioned"] <= {"1998-01", "1998-02"} and parts["clustered"] <= {"1998-01", "1998-02"}


def test_small_values_share_files_and_rows_survive(spark, work):
    path, t = work("by_type"), Tables(spark, TESTDATA)
    K.write_partitioned(t.part, path, ["p_type"])
    assert spark.read.parquet(path).count() == t.part.count()


def test_alerts_read_the_orders_once(spark):
    """Panels and rules read the stored list of periods, not the joined events."""
    plan = plan_of(bindings.QUERIES["dom_09_alerts"](spark, TESTDATA))
    assert "events.parquet" not in plan and "customer.parquet" not in plan


def test_summary_reads_the_stored_alerts(spark):
    assert "events.parquet" not in plan_of(bindings.QUERIES["dom_24_fraud_summary"](spark, TESTDATA))
