"""Ranking, previous values, forward fill and runs. Hot keys are cut as in ``ordered``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exact import total
from tidemill.operators import ordered as O
from tidemill.operators.relational import top_n_per_group


def first_entry(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key; partitions keep one row per key before the shuffle."""
    return top_n_per_group(df, keys, [F.col(o) for o in order], 1).drop("rn")


def changed_from_previous(df: DataFrame, key: str, order: Sequence[str], col: str, chunk: int | Column | None = None) -> DataFrame:
    """Rows whose value differs from the key's row before, with that value."""
    prev = O.previous(df, [key], order, {f"prev_{col}": col}, chunk)
    return prev.where(F.col(f"prev_{col}").isNotNull() & (F.col(f"prev_{col}") != F.col(col)))


def daily_allocation(df: DataFrame, key: str, ts: str, tie: str, group: str) -> DataFrame:
    """One row per key and day from its first day to the table's last, with the group in force.

    Events fold to the newest per (key, day) first. Each such row then fills the days up
    to the key's next one, so no day spine is joined.
    """
    day = F.col(ts).cast("date")
    last = df.groupBy(key, day.alias("day")).agg(F.max_by(group, F.struct(ts, tie)).alias(group))
    end = df.agg(F.max(day).alias("end")).scalar()
    w = Window.partitionBy(key).orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(w), 1), end)
    return (last.withColumn("_until", until)
            .select(key, F.explode(F.expr("sequence(day, _until, interval 1 day)")).alias("day"), group))


def leaderboard(df: DataFrame, player: str, score: str, k: int, scale: int | None = None) -> DataFrame:
    """Top k players by total score (of ``scale`` digits if it is money). Only k rows reach the numbering step."""
    totals = df.groupBy(player).agg(total(score, scale).alias("total_score"))
    best = totals.orderBy(F.col("total_score").desc(), F.col(player)).limit(k)
    w = Window.orderBy(F.col("total_score").desc(), F.col(player))
    return best.withColumn("place", F.row_number().over(w))


def player_rank(df: DataFrame, player: str, score: str, who, scale: int | None = None) -> DataFrame:
    """Rank of one player: one more than the number of players with a higher total; NULL for a stranger."""
    totals = df.groupBy(player).agg(total(score, scale).alias("total_score"))
    own = df.where(F.col(player) == who).agg(total(score, scale).alias("own")).scalar()
    counted = totals.withColumn("own", own).agg(
        F.max("own").alias("own"), F.count_if(F.col("total_score") > F.col("own")).alias("above"), F.count("*").alias("players"))
    return counted.select(F.lit(who).alias(player), F.when(F.col("own").isNotNull(), F.col("above") + 1).alias("place"), "players")


def leaderboard_by_period(df: DataFrame, period: Column, player: str, score: str, k: int, scale: int | None = None) -> DataFrame:
    totals = df.groupBy(period.alias("period"), player).agg(total(score, scale).alias("total_score"))
    return top_n_per_group(totals, ["period"], [F.col("total_score").desc(), F.col(player)], k, "place")


def rolling_sum_range(df: DataFrame, keys: Sequence[str], ts: str, seconds: int, chunk: int | Column | None = None,
                      **specs: tuple[str, Column]) -> DataFrame:
    return O.trailing_range(df, keys, ts, seconds, specs, chunk)


def consecutive_condition(periods: DataFrame, keys: Sequence[str], order: str, condition: Column, n: int, seconds: int) -> DataFrame:
    """Runs of at least n consecutive periods of ``seconds`` each in which the condition held.

    Works on one row per period, i.e. after an aggregate. The number of a period less its row number among those that
    held is constant along a run, so a missing period ends it as one that failed does.
    """
    held = periods.where(condition)
    number = F.floor(O.micros(order) / F.lit(seconds * 1_000_000)).cast("long")
    marked = held.withColumn("_run", number - F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return (marked.groupBy(*keys, "_run")
            .agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count("*").alias("periods"))
            .where(F.col("periods") >= n).drop("_run"))


def windowed_leaderboard(df: DataFrame, ts: str, size: str, player: str, score: str, k: int, scale: int | None = None) -> DataFrame:
    """Top k scorers of each window, next to their all-time score."""
    per = df.groupBy(F.window(ts, size).alias("w"), player).agg(total(score, scale).alias("window_score"))
    per = per.select(F.col("w.start").alias("window_start"), player, "window_score")
    best = top_n_per_group(per, ["window_start"], [F.col("window_score").desc(), F.col(player)], k, "place")
    return best.join(df.groupBy(player).agg(total(score, scale).alias("all_time_score")), player)
