"""Registered queries: sources, scalar expressions, windows, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.catalog import worked
from leadtide.catalog.rounding import rounded
from leadtide.catalog.worked import HORIZONS
from leadtide.config import DAILY, HOURLY, MEASURES, target_name
from leadtide.functions.calendar import add_ahead, calendar_parts, hour_cycle, season, year_cycle
from leadtide.functions.labels import decimals, horizon_of, metric_label, percent, relative_gap, title
from leadtide.functions.weather import row_features, temperature_band
from leadtide.operators.blocks import SeriesLayout, over_series, row_index
from leadtide.operators.features import build_features, final_columns
from leadtide.operators.splits import assign_folds, fold_gaps, leaks, range_report, split_by_time
from leadtide.operators.windows import (
    centred_band, difference, fill_gaps, lagged, lead_targets, trailing_mean, trailing_sum,
)
from leadtide.sources.observations import numeric_columns, parse_time, parse_time_or_null
from leadtide.sources.stores import read_split, write_splits, read_series, write_series
from leadtide.session import scratch_table

KEY = ("series_id", "datetime")
TARGETS = [target_name(h) for h in HORIZONS]
BLOCK = 200  # forces the cut of long series on the small test tables
COLUMNS = ["temp", "tempmax", "tempmin", "dew", "humidity", "sealevelpressure", "cloudcover", "solarradiation",
           "solarenergy", "visibility", "windspeed", "windgust", "precip"]


# Sources


def a1_read_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.hourly(spark, sf)[0])


def a1_read_daily_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.daily(spark, sf)[0])


def a2_read_split(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_daily(spark, sf)
    path = scratch_table(spark, "splits")
    write_splits(df, path)
    return rounded(read_split(spark, path, "train", "val").select(*KEY, "split", "temp", *TARGETS))


def a3_write_splits(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_hourly(spark, sf)
    path = scratch_table(spark, "splits")
    write_splits(df, path)
    return read_split(spark, path).groupBy("series_id", "split").agg(F.count(F.lit(1)).alias("n_rows"))


def _stored_series(blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        """Lead targets from a table stored by series and time, without a shuffle."""
        df, layout = worked.hourly(spark, sf, BLOCK if blocked else None)
        path = scratch_table(spark, "series")
        name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
        write_series(df, layout, name, path, ahead=max(HORIZONS))
        rows, known = read_series(spark, name, path)
        return rounded(lead_targets(rows, known, HORIZONS).select(*KEY, *TARGETS))

    return query


def a8_parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    text = events.select("event_id", F.col("ts").cast("string").alias("datetime"))
    return parse_time(text).groupBy(F.date_format("datetime", "yyyy-MM-dd").alias("day")).agg(
        F.min("datetime").alias("first_time"), F.max("datetime").alias("last_time"), F.count(F.lit(1)).alias("n_rows")
    )


def a9_parse_or_null(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return parse_time_or_null(df, "sunrise", "sunset").select(*KEY, "sunrise", "sunset")


# Scalar expressions


def b1_calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return calendar_parts(df).select(*KEY, "year", "month", "day_of_year", "day_of_week", "hour")


def b2_cyclic_year(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return rounded(df.select(*KEY, *[c.alias(n) for n, c in year_cycle().items()]))


def b3_cyclic_hour(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return rounded(df.select(*KEY, *[c.alias(n) for n, c in hour_cycle().items()]))


def b4_season(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return df.select(*KEY, season(F.month("datetime")).alias("season"))


def _row_feature(column: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, _ = worked.daily(spark, sf)
        return rounded(row_features(df).select(*KEY, column))

    return query


def b9_select_features(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    derived = row_features(df).drop("windgust")
    return rounded(derived.select(*KEY, *final_columns(derived.columns, DAILY)))


def b10_drop_helpers(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    helpers = ["year", "month", "day_of_year", "day_of_week"]
    return rounded(calendar_parts(df).drop(*helpers, "sunrise", "sunset"))


def b11_fill_zero(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return rounded(df.select(*KEY, F.coalesce("windspeed", F.lit(0.0)).alias("windspeed")))


def b12_drop_any_missing(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return rounded(row_features(df).select(*KEY, "temp", "windspeed", "daylight_hours").dropna("any"))


def b13_drop_missing_target(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.hourly(spark, sf)
    targets = lead_targets(df, layout, HORIZONS)
    return rounded(targets.where(F.col("target_t7").isNotNull()).select(*KEY, "target_t7"))


def b14_filter_test_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.naive_metrics(spark, sf).where(F.col("metric_type") == "Test"))


def b16_numeric_columns(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return df.agg(*[F.count(c).alias(c) for c in numeric_columns(df)])


def b17_horizon_from_name(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.hourly(spark, sf)
    wide = lead_targets(df, layout, (24, 48, 168)).select(*KEY, "target_t24", "target_t48", "target_t168")
    long = wide.unpivot(list(KEY), ["target_t24", "target_t48", "target_t168"], "target", "y")
    return rounded(
        long.groupBy("target", horizon_of(F.col("target")).alias("steps"), horizon_of(F.col("target"), "hour").alias("n_days"))
        .agg(F.count("y").alias("n_known"), F.avg("y").alias("mean_y"))
    )


def b20_forecast_date(spark: SparkSession, sf: str) -> DataFrame:
    last = _last_forecasts(spark, sf)
    return last.select(
        "series_id",
        "horizon",
        add_ahead("datetime", F.col("horizon"), "day").alias("day_ahead"),
        add_ahead("datetime", F.col("horizon"), "hour").alias("hour_ahead"),
    )


def _last_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    from leadtide.operators.report import forecast_rows, last_row

    df, layout = worked.split_hourly(spark, sf)
    return forecast_rows(last_row(worked.wide_naive(df, layout)), HORIZONS)


def b21_trend_sign(spark: SparkSession, sf: str) -> DataFrame:
    from leadtide.operators.report import forecast_cards

    cards = forecast_cards(_last_forecasts(spark, sf), "hour")
    return rounded(cards.select("series_id", "horizon", "delta", "trend"))


def b22_temperature_band(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return rounded(df.select(*KEY, "temp", temperature_band(F.col("temp")).alias("band")))


def _clean(x: Column) -> Column:
    """Without the noise that the order of a sum leaves in a double's last digits."""
    return F.round(x, 9)


def b23_round_tenth(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return df.select(*KEY, *[F.round(_clean(F.col(c)), 1).alias(name) for c, name in (("temp", "temp_plot"), ("windspeed", "wind_plot"))])


def b24_number_text(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf)
    return m.select(
        "model", "metric_type", "horizon", decimals(_clean(F.col("rmse"))).alias("rmse"),
        decimals(_clean(F.col("mae")), 3).alias("mae"), percent(_clean(F.col("mape"))).alias("mape"),
    )


def b25_map_labels(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf)
    labels = {"Train": "Train R²", "Test": "Test R²"}
    return m.select(
        F.upper("model").alias("model_upper"), title(F.col("model")).alias("model_title"), "horizon",
        metric_label(F.col("metric_type"), labels).alias("label"),
    )


def b27_label_columns(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return df.groupBy(F.year("datetime").alias("year")).agg(F.count(F.lit(1)).alias("n_rows")).withColumns(
        {"model_type": F.lit("Linear"), "metric_type": F.lit("Train")}
    )


def b28_rename(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf).select("model", "metric_type", "horizon", "n_rows")
    return m.withColumnRenamed("horizon", "Horizon").withColumnRenamed("model", "Model").toDF(
        "Model", "Kind", "Horizon", "N"
    )


def b29_date_text(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.daily(spark, sf)
    return df.select(
        *KEY, F.date_format("datetime", "EEEE").alias("day_name"), F.date_format("datetime", "dd MMM yyyy").alias("day_text"),
        F.date_format("datetime", "MMM dd").alias("short_text"),
    )


# Windows


def _w1(blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = worked.hourly(spark, sf, BLOCK if blocked else None)
        return rounded(lead_targets(df, layout, HORIZONS).select(*KEY, *TARGETS))

    return query


def w1_lead_targets_weekly(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.hourly(spark, sf)
    horizons = (24, 48, 72, 96, 120, 144, 168)
    return rounded(lead_targets(df, layout, horizons).select(*KEY, *[target_name(h) for h in horizons]))


def w1_lead_targets_next_day(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.hourly(spark, sf)
    horizons = range(1, 25)
    return rounded(lead_targets(df, layout, horizons).select(*KEY, *[target_name(h) for h in horizons]))


def _over(name: str, make, column: str, back: int, variant: str = "hourly", blocked: bool = False):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = getattr(worked, variant)(spark, sf, BLOCK if blocked else None)
        out = over_series(df, layout, lambda d, w: d.withColumn(name, make(column, w)), back=back)
        return rounded(out.select(*KEY, name))

    return query


def _mean24(c, w):
    return trailing_mean(c, 24, w)


def _sum24(c, w):
    return trailing_sum(c, 24, w)


def _lag24(c, w):
    return lagged(c, 24, w)


FILLED = ["windspeed", "daylight_hours", "solar_per_hour"]


def _w6(blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = worked.hourly(spark, sf, BLOCK if blocked else None)
        filled = fill_gaps(df.select(*KEY, "windspeed"), layout, ["windspeed"], last_resort=None, backward=False)
        return rounded(filled.select(*KEY, "windspeed"))

    return query


def _w7(variant: str, blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = getattr(worked, variant)(spark, sf, BLOCK if blocked else None)
        narrow = row_features(df).select(*KEY, *FILLED)
        return rounded(fill_gaps(narrow, layout, FILLED))

    return query


def _w8(variant: str, blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = getattr(worked, variant)(spark, sf, BLOCK if blocked else None)
        band = centred_band(df, layout)
        return rounded(band.select(*KEY, "rolling_mean", "rolling_std", "upper_bound", "lower_bound"))

    return query


def _w11(variant: str, blocked: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = getattr(worked, variant)(spark, sf, BLOCK if blocked else None)
        return row_index(df, layout, "idx", "n_series").select(*KEY, "idx", "n_series")

    return query


# Splits and folds


def _d1(variant: str, blocked: bool = False):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = getattr(worked, variant)(spark, sf, BLOCK if blocked else None)
        return split_by_time(df, layout).select(*KEY, "split")

    return query


def folded(spark: SparkSession, sf: str, blocked: bool = False) -> tuple[DataFrame, SeriesLayout]:
    """Purged folds over the train and val rows of the hourly series, gap 7 rows."""
    df, layout = worked.split_hourly(spark, sf)
    kept = df.where((F.col("split") != "test") & F.col("target_t1").isNotNull())
    if blocked:
        from leadtide.operators.blocks import lay_out

        layout = lay_out(kept, block_rows=BLOCK, unique=True)
    return assign_folds(kept, layout, gap=7), layout


def _d2(blocked: bool = False):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return folded(spark, sf, blocked)[0].select(*KEY, "idx", "fold", "role")

    return query


def d3_leakage_check(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(folded(spark, sf)[0])


def d4_split_ranges(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_hourly(spark, sf)
    return range_report(df, ["series_id", "split"])


def d4_fold_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return range_report(folded(spark, sf)[0], ["series_id", "fold", "role"])


def d4_fold_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return fold_gaps(folded(spark, sf)[0])


# Whole feature jobs


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Lead targets and all hourly features of the whole table, rows with a known target."""
    df, layout = worked.hourly(spark, sf)
    ready = build_features(lead_targets(df, layout, HORIZONS), layout, HOURLY, keep=["temp", *TARGETS])
    return rounded(ready.where(F.col("target_t7").isNotNull()))


def _m1(variant: str, blocked: bool = False):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(worked.feature_table(spark, sf, variant, BLOCK if blocked else None))

    return query


QUERIES = {
    "a1_read_observations": a1_read_observations,
    "a1_read_daily_observations": a1_read_daily_observations,
    "a2_read_split": a2_read_split,
    "a3_write_splits": a3_write_splits,
    "a3_stored_series": _stored_series(False),
    "a3_stored_series_blocked": _stored_series(True),
    "a8_parse_timestamps": a8_parse_timestamps,
    "a9_parse_or_null": a9_parse_or_null,
    "b1_calendar_parts": b1_calendar_parts,
    "b2_cyclic_year": b2_cyclic_year,
    "b3_cyclic_hour": b3_cyclic_hour,
    "b4_season": b4_season,
    "b5_daylight_hours": _row_feature("daylight_hours"),
    "b6_solar_per_hour": _row_feature("solar_per_hour"),
    "b7_temp_range": _row_feature("temp_range"),
    "b8_dewpoint_depression": _row_feature("dewpoint_depression"),
    "b9_select_features": b9_select_features,
    "b10_drop_helpers": b10_drop_helpers,
    "b11_fill_zero": b11_fill_zero,
    "b12_drop_any_missing": b12_drop_any_missing,
    "b13_drop_missing_target": b13_drop_missing_target,
    "b14_filter_test_metrics": b14_filter_test_metrics,
    "b16_numeric_columns": b16_numeric_columns,
    "b17_horizon_from_name": b17_horizon_from_name,
    "b20_forecast_date": b20_forecast_date,
    "b21_trend_sign": b21_trend_sign,
    "b22_temperature_band": b22_temperature_band,
    "b23_round_tenth": b23_round_tenth,
    "b24_number_text": b24_number_text,
    "b25_map_labels": b25_map_labels,
    "b27_label_columns": b27_label_columns,
    "b28_rename": b28_rename,
    "b29_date_text": b29_date_text,
    "w1_lead_targets": _w1(False),
    "w1_lead_targets_blocked": _w1(True),
    "w1_lead_targets_weekly": w1_lead_targets_weekly,
    "w1_lead_targets_next_day": w1_lead_targets_next_day,
    "w2_difference": _over("sealevelpressure_change", difference, "sealevelpressure", 1),
    "w3_lag_24": _over("temp_lag_24h", _lag24, "temp", 24),
    "w3_lag_24_humidity": _over("humidity_lag_24h", _lag24, "humidity", 24),
    "w4_trailing_mean": _over("temp_rolling_avg_24h", _mean24, "temp", 24),
    "w4_trailing_mean_blocked": _over("temp_rolling_avg_24h", _mean24, "temp", 24, "daily", True),
    "w5_trailing_sum": _over("precip_rolling_sum_24h", _sum24, "precip", 24),
    "w6_forward_fill": _w6(False),
    "w6_forward_fill_blocked": _w6(True),
    "w7_fill_both_ways": _w7("hourly", False),
    "w7_fill_both_ways_blocked": _w7("daily", True),
    "w8_w9_centred_band": _w8("daily", False),
    "w8_w9_centred_band_blocked": _w8("daily", True),
    "w11_row_index": _w11("hourly", False),
    "w11_row_index_blocked": _w11("daily", True),
    "d1_split_by_time": _d1("hourly"),
    "d1_split_daily_blocked": _d1("daily", True),
    "d2_purged_folds": _d2(),
    "d2_purged_folds_blocked": _d2(True),
    "d3_leakage_check": d3_leakage_check,
    "d4_split_ranges": d4_split_ranges,
    "d4_fold_ranges": d4_fold_ranges,
    "d4_fold_gaps": d4_fold_gaps,
    "m1_features_hourly": _m1("hourly"),
    "m1_features_hourly_blocked": _m1("hourly", True),
    "m1_features_daily": _m1("daily"),
    "m1_features_daily_blocked": _m1("daily", True),
    "m1_features_whole_table": flagship,
}
