"""Timed headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3, the first counts as cold and the best of the others as warm).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dom_01_experiment_scores", "jon_03_star_join", "jon_14_join_then_window", "win_02_hopping", "win_03_session",
    "agg_02_group_agg", "agg_09_topk", "agg_18_word_count", "ana_06_rolling_sum_range", "jon_08_asof_lookup",
    "cdc_06_apply_changelog", "inc_02_merge_upsert", "inc_10_scd2", "inc_11_dedup_by_key", "dom_07_fraud_rules",
    "dom_10_funnel", "dom_18_semantic_query", "dq_07_split", "str_12_rolling_reduce", "str_01_with_watermark",
    "dom_08_revenue_dashboard", "dom_09_alerts", "dom_19_superstore_kpis", "dom_24_fraud_summary",
]


def main() -> None:
    from tidemill import bindings
    from tidemill.session import build_session, clear_scratch

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false"})
    names = [a for a in sys.argv[1:] if a in bindings.QUERIES] or HEADLINE
    cold, warm = {}, {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            bindings.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        cold[name] = round(times[0], 3)
        warm[name] = round(min(times[1:] or times), 3)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({"metric": "total_warm_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
                      "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
