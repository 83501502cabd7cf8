"""How often queries read and stage, over all their executions: the work done while a query is built counts too."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import ROOT, TESTDATA

RUN = """
import sys
sys.path.insert(0, {root!r})
from tidemill import bindings
from tidemill.session import build_session
spark = build_session("scans", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "2g", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": {log!r}, "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.checkpoint.dir": {work!r}}})
for name in {names!r}:
    spark.sparkContext.setJobDescription(name)
    bindings.QUERIES[name](spark, {data!r}).write.format("noop").mode("overwrite").save()
spark.stop()
"""
# Reads of the given tables, and tables staged on the way, at most.
LIMITS = {"dom_07_fraud_rules": (2, 1), "dom_24_fraud_summary": (2, 2), "dom_08_revenue_dashboard": (6, 1), "dom_19_superstore_kpis": (6, 0),
          "dom_02_fire_calls_report": (2, 1), "dom_20_repo_questions": (3, 1), "dom_09_alerts": (2, 1), "ana_06_rolling_sum_range": (3, 1)}


def _walk(node, seen):
    seen.append(node)
    for child in node["children"]:
        _walk(child, seen)


@pytest.fixture(scope="module")
def executions(tmp_path_factory):
    """Per query, the final plans of its executions."""
    log, work = tmp_path_factory.mktemp("events"), tmp_path_factory.mktemp("staged")
    code = RUN.format(root=str(ROOT), log=f"file://{log}", work=f"file://{work}", names=list(LIMITS), data=TESTDATA)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    plans, named = {}, {}
    for line in Path(next(log.iterdir())).open():
        event = json.loads(line)
        if "sparkPlanInfo" in event:
            plans[event["executionId"]] = event["sparkPlanInfo"]  # the last one is the one that ran
            if event.get("description") in LIMITS:
                named[event["executionId"]] = event["description"]
    out = {name: [] for name in LIMITS}
    for number, name in named.items():
        out[name].append(plans[number])
    return out


@pytest.mark.parametrize("name", sorted(LIMITS))
def test_reads_and_staged_tables(executions, name):
    reads = staged = 0
    for plan in executions[name]:
        nodes = []
        _walk(plan, nodes)
        reads += sum(n["nodeName"].startswith("Scan parquet") and TESTDATA in n["simpleString"] + json.dumps(n.get("metadata", {})) for n in nodes)
        staged += any("InsertIntoHadoopFsRelationCommand" in n["nodeName"] + n["simpleString"] for n in nodes)
    assert executions[name] and reads <= LIMITS[name][0] and staged <= LIMITS[name][1], (reads, staged)
