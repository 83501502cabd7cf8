"""Fixed reports over one table. Answers of one report share the layout question, label, value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import dec, mean
from tidemill.operators.relational import top_n
from tidemill.session import materialize


def answer(df: DataFrame, question: str, label: Column, value: Column) -> DataFrame:
    return df.select(F.lit(question).alias("question"), label.cast("string").alias("label"), value.cast("double").alias("value"))


def stack(answers: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), answers)


def fire_calls_report(df: DataFrame, call: str, delay: str, zip_: str, hood: str, city: str, ts: str, *, slow: float,
                      zips: Sequence, year: int, in_city: str, scale: int | None = None) -> DataFrame:
    """Seven questions on call records; ``scale`` if the delays are of so many digits.

    One pass folds the calls to the three grains that the questions need (type and place, week, neighbourhood); these short
    tables are written, and every answer reads them.
    """
    week = F.when(F.year(ts) == year, F.weekofyear(ts)).alias("week")
    rows = df.select(F.col(call).alias("call"), F.col(zip_).alias("zip"), F.col(hood).alias("hood"), week, F.col(delay).alias("delay"),
                     F.col(zip_).isin(*zips).alias("near"), (F.col(city) == in_city).alias("inside"))
    inside = F.when(F.col("inside"), F.col("delay"))
    folded = rows.groupingSets([["call", "zip"], ["week"], ["hood"]], "call", "zip", "week", "hood").agg(
        F.grouping_id().alias("grain"), F.count("*").alias("n"), F.count_if(F.col("delay") > slow).alias("slow"), F.count("delay").alias("timed"),
        F.sum("delay" if scale is None else dec("delay", scale)).alias("total"), F.min("delay").alias("low"), F.max("delay").alias("high"), F.max("near").alias("near"),
        F.max("inside").alias("inside"), mean(inside, scale).alias("mean"))
    folded = materialize(folded, "calls")
    per_type, per_week, per_hood = (folded.where(F.col("grain") == g) for g in (0b0011, 0b1101, 0b1110))
    named = per_type.where(F.col("call").isNotNull())
    commonest = top_n(named, [F.col("n").desc(), F.col("call"), F.col("zip")], 1)
    busiest = top_n(per_week.where(F.col("week").isNotNull()), [F.col("n").desc(), F.col("week")], 1)
    worst = top_n(per_hood.where("inside"), [F.col("mean").desc(), F.col("hood")], 1)
    whole = per_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("calls"), F.sum("slow").alias("slow"), F.sum("total").cast("double").alias("total"),
                         F.sum("timed").alias("timed"), F.min("low").alias("low"), F.max("high").alias("high"))
    whole = whole.withColumn("mean", F.col("total") / F.col("timed"))
    return stack([
        answer(named.select("call").distinct(), "call_types", F.col("call"), F.lit(1)),
        answer(whole, "slow_calls", F.lit(f"over {slow:g}"), F.coalesce("slow", F.lit(0))),
        answer(commonest, "commonest", F.concat_ws("/", "call", F.col("zip").cast("string")), F.col("n")),
        answer(per_hood.where("near"), "neighbourhoods", F.col("hood"), F.lit(1)),
        *[answer(whole, "totals", F.lit(k), F.col(k)) for k in ("calls", "total", "mean", "low", "high")],
        answer(busiest, "busiest_week", F.col("week"), F.col("n")),
        answer(worst, "worst_delay", F.col("hood"), F.col("mean")),
    ])


def location_summary(df: DataFrame, location: str, value: str, n: int = 20) -> DataFrame:
    """Highest value per location, the first n, and how many rows and places the table covers."""
    best = df.where(F.col(location).isNotNull()).groupBy(location).agg(F.max(value).alias("v"))
    cover = df.agg(F.count("*").alias("rows"), F.countDistinct(location).alias("locations"))
    return stack([
        answer(top_n(best, [F.col("v").desc(), F.col(location)], n), "highest", F.col(location), F.col("v")),
        answer(cover, "coverage", F.lit("rows"), F.col("rows")),
        answer(cover, "coverage", F.lit("locations"), F.col("locations"))])


def taxi_summary(df: DataFrame, fare: str, distance: str, tip: str, passengers: str, minutes: Column, *, long_trip: float,
                 high_tip_pct: float, scale: int | None = None) -> DataFrame:
    """One row of trip figures from one pass. Fares and tips are money of ``scale`` digits; distances and minutes are taken as they are."""
    tip_pct = F.col(tip) / F.nullif(fare, F.lit(0.0)) * 100
    return df.agg(mean(fare, scale).alias("mean_fare"), mean(distance).alias("mean_distance"), mean(tip, scale).alias("mean_tip"),
                  F.sum(passengers).alias("passengers"), mean(minutes).alias("mean_duration"),
                  F.count_if(F.col(distance) > long_trip).alias("long_trips"), F.count_if(tip_pct > high_tip_pct).alias("high_tips"))


def zone_stats(df: DataFrame, zone: str, distance: str, fare: str, *, min_distance: float, min_fare: float, scale: int | None = None) -> DataFrame:
    """Mean distance and fare (money of ``scale`` digits) of long, dear trips by zone, most trips first."""
    return (df.where((F.col(distance) > min_distance) & (F.col(fare) > min_fare)).groupBy(zone)
            .agg(mean(distance).alias("mean_distance"), mean(fare, scale).alias("mean_fare"), F.count("*").alias("trips"))
            .orderBy(F.col("trips").desc(), F.col(zone)))


def posts_by_month(df: DataFrame, ts: str, answered: Column) -> DataFrame:
    return df.where(answered).groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(F.count("*").alias("posts"))


def product_cross_counts(df: DataFrame, place: str, colour: str, amount: Column, only: str | None = None) -> DataFrame:
    """Sums by place and colour, largest first; optionally of one place."""
    rows = df if only is None else df.where(F.col(place) == only)
    return (rows.groupBy(place, colour).agg(F.sum(amount).cast("double").alias("total"))
            .orderBy(F.col("total").desc(), F.col(place), F.col(colour)))


def repo_questions(repos: DataFrame, name: str, stars: str, language: str, created: str, owner: str) -> DataFrame:
    """Total, most starred, best per language, newest, language share over time, and repos per owner.

    One pass folds to languages per year and to owners, and these short tables are written; the two lists read the repos.
    """
    rows = repos.select(F.col(name).alias("name"), F.col(stars).alias("stars"), F.col(language).alias("language"), F.col(owner).alias("owner"),
                        F.col(created).alias("created"), F.date_format(created, "yyyy").alias("y"))
    first = F.min_by(F.struct("name", "stars"), F.struct(F.col("stars").isNull(), -F.col("stars"), "name"))
    folded = materialize(rows.groupingSets([["y", "language"], ["owner"]], "y", "language", "owner").agg(
        F.grouping_id().alias("grain"), F.count("*").alias("n"), first.alias("best")), "repos")
    monthly, owners = folded.where("grain = 1"), folded.where("grain = 6")
    top = F.min_by("best", F.struct(F.col("best.stars").isNull(), -F.col("best.stars"), "best.name"))
    per_language = monthly.groupBy("language").agg(top.alias("best"))
    share = monthly.join(monthly.groupBy("y").agg(F.sum("n").alias("all")), "y")
    return stack([
        answer(owners.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "total", F.lit("all"), F.col("n")),
        answer(top_n(rows.select("name", "stars"), [F.col("stars").desc(), F.col("name")], 10), "top_stars", F.col("name"), F.col("stars")),
        answer(per_language, "best_per_language", F.concat_ws("/", "language", F.col("best.name").cast("string")), F.col("best.stars")),
        answer(top_n(rows.select("name", "stars", "created"), [F.col("created").desc(), F.col("name")], 10), "newest", F.col("name"), F.col("stars")),
        answer(share, "language_share", F.concat_ws("/", "y", "language"), F.col("n") * 100.0 / F.col("all")),
        answer(owners, "per_owner", F.col("owner"), F.col("n"))])
