"""Derived inputs the registered queries share: splits, features, naive forecasts, their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.config import DAILY, DAILY_HORIZONS, HOURLY, target_name
from leadtide.operators.blocks import SeriesLayout, lay_out
from leadtide.operators.evaluate import evaluate
from leadtide.operators.features import targets_and_features
from leadtide.operators.splits import split_by_time
from leadtide.operators.windows import lead_targets, trailing_mean
from leadtide.operators.blocks import over_series
from leadtide.sources.adapters import at_most_rows, obs_daily, obs_hourly

HORIZONS = DAILY_HORIZONS
NAIVE = ("last_value", "lag_mean_24", "half_way")


def hourly(spark: SparkSession, sf: str, block_rows: int | None = None) -> tuple[DataFrame, SeriesLayout]:
    df = obs_hourly(spark, sf)
    if block_rows:
        return df, lay_out(df, block_rows=block_rows, unique=True)
    return df, lay_out(df, at_most=at_most_rows(spark, sf, "events"), unique=True)


def daily(spark: SparkSession, sf: str, block_rows: int | None = None) -> tuple[DataFrame, SeriesLayout]:
    df = obs_daily(spark, sf)
    if block_rows:
        return df, lay_out(df, block_rows=block_rows, unique=True)
    return df, lay_out(df, at_most=at_most_rows(spark, sf, "lineitem"), unique=True)


def split_hourly(spark: SparkSession, sf: str, block_rows: int | None = None) -> tuple[DataFrame, SeriesLayout]:
    """Hourly rows with targets and split label."""
    df, layout = hourly(spark, sf, block_rows)
    return split_by_time(lead_targets(df, layout, HORIZONS), layout), layout


def split_daily(spark: SparkSession, sf: str, block_rows: int | None = None) -> tuple[DataFrame, SeriesLayout]:
    df, layout = daily(spark, sf, block_rows)
    return split_by_time(lead_targets(df, layout, HORIZONS), layout), layout


def fit_part() -> dict:
    """Training works on train and val together, the test part stands alone."""
    return {"part": F.when(F.col("split") == "test", "test").otherwise("fit")}


def feature_table(spark: SparkSession, sf: str, variant: str = "hourly", block_rows: int | None = None) -> DataFrame:
    """Features with targets, windows restarting between the fit and the test part."""
    df, layout = (hourly if variant == "hourly" else daily)(spark, sf, block_rows)
    return targets_and_features(df, layout, HOURLY if variant == "hourly" else DAILY, HORIZONS, ["temp"])


def naive_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Long predictions of three naive forecasts: model, series, time, split, horizon, y, pred."""
    df, layout = split_hourly(spark, sf)
    df = over_series(df, layout, lambda d, w: d.withColumn("m24", trailing_mean("temp", 24, w)), back=24)
    temp, mean = F.col("temp"), F.col("m24")
    preds = dict(zip(NAIVE, (temp, mean, 0.5 * temp + 0.5 * mean)))
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.lit(h).alias("horizon"), F.col(target_name(h)).alias("y"), p.alias("pred")
            )
            for m, p in preds.items()
            for h in HORIZONS
        ]
    )
    return df.select("series_id", "datetime", "split", F.inline(rows))


def naive_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metric table: model, metric_type (Train / Test), horizon, rmse, mae, r2, mape."""
    long = naive_forecasts(spark, sf).where(F.col("y").isNotNull())
    kind = F.when(F.col("split") == "test", "Test").otherwise("Train")
    return evaluate(long.withColumn("metric_type", kind), ["model", "metric_type", "horizon"])


def wide_naive(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Per row one prediction column per horizon: a blend that leans to the trailing mean."""
    from leadtide.config import pred_name

    df = over_series(df, layout, lambda d, w: d.withColumn("m24", trailing_mean("temp", 24, w)), back=24)
    blend = {
        pred_name(h): (1 - 0.1 * h) * F.col("temp") + 0.1 * h * F.col("m24") for h in HORIZONS
    }
    return df.withColumns(blend).drop("m24")
