"""Experiment scores: the flagship batch job, files in, partitioned scores out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.aggregates import min_max_by_group
from tidemill.operators.relational import late_record_filter
from tidemill.sinks.files import write_partitioned


def join_tables(logs: DataFrame, experiments: DataFrame, metrics: DataFrame) -> DataFrame:
    """Log rows with experiment and metric names. Both lookups are small by nature; the
    optimizer broadcasts them from their measured size."""
    return logs.join(metrics, "metric_id").join(experiments, "exp_id")


def experiment_scores(logs: DataFrame, experiments: DataFrame, metrics: DataFrame, hours: float,
                      created: str = "created_at", ingested: str = "ingested_at", value: str = "value") -> DataFrame:
    """Best and worst value per experiment and metric, over rows that arrived on time.

    The lag filter needs no lookup and is taken before the joins, and scores are folded on
    the ids, so names are joined to the few result rows only.
    """
    on_time = late_record_filter(logs, created, ingested, hours, "on_time")
    known = on_time.join(metrics.select("metric_id"), "metric_id", "left_semi").join(
        experiments.select("exp_id"), "exp_id", "left_semi")
    scores = min_max_by_group(known, ["exp_id", "metric_id"], value)
    return join_tables(scores, experiments, metrics).select(
        "exp_id", "exp_name", "metric_id", "metric_name", "min_value", "max_value")


def save_scores(scores: DataFrame, path: str) -> DataFrame:
    write_partitioned(scores, path, ["metric_id"])
    return scores.sparkSession.read.schema(scores.schema).parquet(path)
