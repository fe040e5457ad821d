"""Watching forecasts in use: rolling error against a baseline, and the age of the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtide.config import KEYS, TIME

# Window in days, allowed excess over the baseline, age at which to retrain.
WINDOW_DAYS = 30
TOLERANCE = 1.2
MAX_AGE_MONTHS = 6


def rolling_rmse(long: DataFrame, days: int = WINDOW_DAYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """RMSE of the last ``days`` days per series, horizon and day.

    Errors are first added up per day, so the window sees one row per day however many
    observations a day has.
    """
    e = F.col("y") - F.col("pred")
    by_day = (
        long.where(e.isNotNull())
        .groupBy(*keys, "horizon", F.col(TIME).cast("date").alias("day"))
        .agg(F.sum(e * e).alias("_se"), F.count(F.lit(1)).alias("_n"))
    )
    w = Window.partitionBy(*keys, "horizon").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return by_day.select(
        *keys, "horizon", "day", F.sqrt(F.sum("_se").over(w) / F.sum("_n").over(w)).alias("rolling_rmse")
    )


def drift(rolling: DataFrame, baseline: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Days on which the rolling error exceeds the baseline of its horizon by more than allowed.

    ``baseline`` has one row per horizon: a bounded broadcast.
    """
    base = baseline.select("horizon", F.col("rmse").alias("baseline_rmse"))
    return rolling.join(F.broadcast(base), "horizon").withColumn(
        "drifted", F.col("rolling_rmse") > tolerance * F.col("baseline_rmse")
    )


def too_old(day: Column, trained_on: Column, months: int = MAX_AGE_MONTHS) -> Column:
    return F.add_months(trained_on, months) <= day


def retrain_days(drifted: DataFrame, trained_on: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series and day: any horizon has drifted, or the models are too old."""
    daily = drifted.groupBy(*keys, "day").agg(F.bool_or("drifted").alias("any_drift"))
    old = too_old(F.col("day"), trained_on)
    return daily.withColumns({"too_old": old, "retrain": F.col("any_drift") | old})
