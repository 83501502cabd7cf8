"""Readings of machines: cleaning, daily statistics and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import dec, exact_avg, exact_stddev
from tidemill.operators.aggregates import exact_median
from tidemill.operators.ordered import trailing_rows
from tidemill.session import materialize


def clean_readings(df: DataFrame, unit: str, value: str, lo: float, hi: float) -> DataFrame:
    """Readings outside [lo, hi] are removed, missing ones take the unit's median."""
    kept = df.where(F.col(value).isNull() | F.col(value).between(lo, hi))
    medians = exact_median(kept, [unit], value, "_median")
    return (kept.join(medians, unit, "left").withColumn("imputed", F.col(value).isNull())
            .withColumn(value, F.coalesce(F.col(value), F.col("_median"))).drop("_median"))


def _mean(value: str, scale: int | None) -> Column:
    return F.avg(value) if scale is None else exact_avg(value, scale)


def daily_stats(clean: DataFrame, unit: str, ts: str, value: str, scale: int | None = None) -> DataFrame:
    """Lowest, highest and mean reading per day. With ``scale`` sums are of DECIMALs of so many digits, else of the values as they are."""
    return (clean.groupBy(F.window(ts, "1 day").alias("w"), unit)
            .agg(F.min(value).alias("lowest"), F.max(value).alias("highest"), _mean(value, scale).alias("mean"))
            .select(F.col("w.start").alias("day"), unit, "lowest", "highest", "mean"))


def flag_units(stats: DataFrame, clean: DataFrame, ts: str, value: str, sigmas: float = 2.0, scale: int | None = None) -> DataFrame:
    """Units whose daily mean lies outside the day's fleet mean plus or minus ``sigmas`` deviations."""
    fleet = (clean.groupBy(F.window(ts, "1 day").alias("w"))
             .agg(_mean(value, scale).alias("fleet_mean"),
                  (F.stddev_samp(value) if scale is None else exact_stddev(value, scale)).alias("fleet_sd"))
             .select(F.col("w.start").alias("day"), "fleet_mean", "fleet_sd"))
    far = F.abs(F.col("mean") - F.col("fleet_mean")) > sigmas * F.col("fleet_sd")
    return stats.join(fleet, "day").withColumn("anomaly", F.coalesce(far, F.lit(False)))


def turbine_pipeline(df: DataFrame, unit: str, ts: str, value: str, lo: float, hi: float,
                     scale: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned readings, daily statistics with flags). The cleaned table is stored, then read."""
    clean = materialize(clean_readings(df, unit, value, lo, hi), "clean_readings")
    return clean, flag_units(daily_stats(clean, unit, ts, value, scale), clean, ts, value, scale=scale)


def sensor_anomalies(df: DataFrame, device: str, order: list[str], value: str, lo: Column, hi: Column, rows: int = 20,
                     sigmas: float = 5.0, block: int = 100_000, chunk: int | Column | None = None,
                     scale: int | None = None) -> DataFrame:
    """Dropouts (no reading), readings out of the type's range, and spikes against the rows before.

    A spike lies more than ``sigmas`` deviations from the mean of the device's last ``rows``
    readings.
    """
    d = F.col(value) if scale is None else dec(value, scale)
    recent = trailing_rows(df, [device], order, rows, {"_n": F.count(value), "_s": F.sum(d), "_q": F.sum(d * d)}, block, chunk)
    n, s, q = F.col("_n"), F.col("_s").cast("double"), F.col("_q").cast("double")
    mean, sd = s / n, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0)))
    kind = (F.when(F.col(value).isNull(), "dropout").when(~F.col(value).between(lo, hi), "out_of_range")
            .when((n >= rows) & (F.abs(F.col(value) - mean) > sigmas * sd), "spike"))
    return recent.withColumn("anomaly", kind).where("anomaly IS NOT NULL").drop("_n", "_s", "_q", "rn")
