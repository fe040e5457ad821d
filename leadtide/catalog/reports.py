"""Registered queries: joins, aggregates, sorting, reshaping, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.catalog import worked
from leadtide.catalog.basics import KEY, TARGETS, folded
from leadtide.catalog.rounding import rounded
from leadtide.catalog.worked import HORIZONS
from leadtide.operators import explore, monitor, report
from leadtide.operators.evaluate import evaluate, to_wide
from leadtide.operators.windows import trailing_mean
from leadtide.operators.blocks import over_series
from leadtide.session import stored
from leadtide.sources.observations import numeric_columns
from leadtide.sources.stores import (
    METRICS, PARAMETERS, PREDICTIONS, nested_to_rows, parameter_rows, read_table, write_table,
)
from leadtide.session import scratch_table

BLENDS = (1, 2, 3, 4, 5)


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.split_hourly(spark, sf)
    return report.forecast_rows(report.last_row(worked.wide_naive(df, layout)), HORIZONS)


def blend_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Trial scores on the validation folds: trial t leans by 0.2 t to the mean of 24 rows."""
    parts, _ = folded(spark, sf)
    df, layout = worked.hourly(spark, sf)
    mean = over_series(df, layout, lambda d, w: d.withColumn("m24", trailing_mean("temp", 24, w)), back=24)
    val = parts.where(F.col("role") == "val").join(mean.select(*KEY, "m24"), list(KEY))
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("trial"), F.lit(h).alias("horizon"), F.col(f"target_t{h}").alias("y"),
                     ((1 - 0.2 * t) * F.col("temp") + 0.2 * t * F.col("m24")).alias("pred"))
            for t in BLENDS for h in HORIZONS
        ]
    )
    long = val.select("fold", F.inline(rows)).where(F.col("y").isNotNull())
    e = F.col("y") - F.col("pred")
    return long.groupBy("trial", "horizon", "fold").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.count_if(F.abs(e) < 20).alias("best_iteration")
    )


# Joins


def j1_actual_with_predicted(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_hourly(spark, sf)
    naive = worked.naive_forecasts(spark, sf)
    pred = naive.where((F.col("model") == "half_way") & (F.col("horizon") == 1) & (F.col("split") == "test"))
    return rounded(report.residuals(df, pred.select(*KEY, F.col("pred").alias("pred_target_t1")), "target_t1", "pred_target_t1"))


def j2_train_beside_test(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.train_beside_test(worked.naive_metrics(spark, sf)))


def b15_keys_in_both(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf).where((F.col("metric_type") == "Train") | (F.col("horizon") <= 4))
    return rounded(report.train_beside_test(m, "inner").select("model", "horizon", "mae_train", "mae_test", "r2_train", "r2_test"))


def b18_overfit_gap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.with_gap(report.train_beside_test(worked.naive_metrics(spark, sf))).select("model", "horizon", "gap_pct"))


def b19_residual(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf).where(F.col("y").isNotNull())
    return rounded(naive.select("model", *KEY, "horizon", (F.col("y") - F.col("pred")).alias("residual")))


def b26_band(spark: SparkSession, sf: str) -> DataFrame:
    from leadtide.operators.windows import centred_band

    df, layout = worked.hourly(spark, sf)
    return rounded(centred_band(df, layout).select(*KEY, "upper_bound", "lower_bound").dropna("any"))


def j3_align_features_target(spark: SparkSession, sf: str) -> DataFrame:
    ready = worked.feature_table(spark, sf, "daily")
    return rounded(ready.where(F.col("part") == "fit").select(*KEY, "target_t3", "humidity", "windspeed", "precip").dropna("any"))


def j4_align_prediction(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf).where(F.col("split") == "test")
    return rounded(naive.select("model", *KEY, "horizon", "y", "pred").dropna("any"))


def j5_labels_by_time(spark: SparkSession, sf: str) -> DataFrame:
    # Features and labels of a time are columns of one row: no join.
    df, _ = worked.split_hourly(spark, sf)
    val = df.where((F.col("split") == "val") & F.col("target_t7").isNotNull())
    return rounded(val.select(*KEY, "humidity", "target_t7"))


def j6_fixed_categories(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.mean_by_season(explore.with_calendar(worked.hourly(spark, sf)[0])))


def j7_parameters_with_defaults(spark: SparkSession, sf: str) -> DataFrame:
    best = report.best_trial(report.mean_over_folds(blend_scores(spark, sf)))
    tuned = best.where(F.col("horizon") % 2 == 1).select("horizon", (F.col("trial") * 0.2).alias("alpha"),
                                                         F.when(F.col("trial") > 1, F.col("trial") * 0.1).alias("l1_ratio"))
    wanted = worked.naive_metrics(spark, sf).select("horizon").distinct()
    return rounded(report.with_default_parameters(wanted, tuned, {"alpha": 1.0, "l1_ratio": 0.5}, ["horizon"]))


# Aggregates


def _mean(by: str, columns=("temp",)):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(explore.mean_by(explore.with_calendar(worked.daily(spark, sf)[0]), by, columns))

    return query


def g5_correlations(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.hourly(spark, sf)
    return rounded(explore.correlations(df, numeric_columns(df)))


def g6_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.histogram(worked.daily(spark, sf)[0]))


def g7_density(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.density(worked.daily(spark, sf)[0]))


def g8_overall_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.daily(spark, sf)[0].agg(F.avg("temp").alias("mean_temp")))


def g8_mean_residual(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf).where(F.col("split") == "test")
    return rounded(naive.groupBy("model", "horizon").agg(F.avg(F.col("y") - F.col("pred")).alias("mean_residual")))


MEASURES = ["temp", "humidity", "precip"]


def _box(small: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df, layout = worked.daily(spark, sf)
        return rounded(explore.box_statistics(explore.with_calendar(df), MEASURES, at_most=layout.rows if small else None))

    return query


def g9_outliers(spark: SparkSession, sf: str) -> DataFrame:
    df, layout = worked.daily(spark, sf)
    return rounded(explore.outliers(explore.with_calendar(df), "precip", keep=["datetime"], at_most=layout.rows))


def g10_lines(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [("temp", "precip"), ("solarradiation", "temp"), ("temp", "humidity")]
    return rounded(explore.lines(worked.hourly(spark, sf)[0], pairs))


def g11_point_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.point_pairs(worked.hourly(spark, sf)[0], "humidity", "precip"))


def g12_g15_metrics(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf)
    return rounded(evaluate(naive.where(F.col("y").isNotNull()), ["model", "split", "horizon"]))


def m13_evaluate_per_horizon(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf)
    return rounded(evaluate(naive.where((F.col("model") == "last_value") & (F.col("split") == "test") & F.col("y").isNotNull())))


def g17_mean_over_folds(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.mean_over_folds(blend_scores(spark, sf)).drop("avg_best_iteration"))


def g18_mean_best_iteration(spark: SparkSession, sf: str) -> DataFrame:
    return report.mean_over_folds(blend_scores(spark, sf)).select("trial", "horizon", "avg_best_iteration")


def g19_mean_metric_per_model(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf)
    return rounded(m.where(F.col("metric_type") == "Test").groupBy("model").agg(
        *[F.avg(c).alias(f"mean_{c}") for c in ("rmse", "mae", "r2", "mape")]))


def g20_forecast_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.forecast_summary(forecasts(spark, sf), "day"))


def g21_missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_hourly(spark, sf)
    return report.missing_counts(df, ["windspeed", *TARGETS], ["series_id", "split"])


# Sorting


def s1_sort_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.daily(spark, sf)[0].select(*KEY, "temp").orderBy("datetime", "series_id"))


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf).where((F.col("horizon") == 1) & F.col("y").isNotNull())
    e = F.col("y") - F.col("pred")
    return naive.groupBy("model").agg(
        *[F.sqrt(F.avg(F.when(F.col("split") == s, e * e))).alias(f"{s}_rmse") for s in ("train", "val", "test")]
    )


def s2_rank_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.rank_benchmark(benchmark(spark, sf)))


def s3_sort_by_horizon(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(worked.naive_metrics(spark, sf).select("model", "metric_type", "horizon", "mae").orderBy("horizon", "model", "metric_type"))


def s4_last_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.last_rows(worked.hourly(spark, sf)[0].select(*KEY, "temp"), 40))


def s4_last_row(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.last_row(worked.hourly(spark, sf)[0].select(*KEY, "temp", "windspeed")))


def s5_first_horizons(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.first_horizons(forecasts(spark, sf), 3))


def s6_best_trial(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.best_trial(report.mean_over_folds(blend_scores(spark, sf))))


def s7_order_models(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.order_models(worked.naive_metrics(spark, sf), "r2", True))


# Reshaping


def u1_union_fit_parts(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = worked.split_hourly(spark, sf)
    cols = df.select(*KEY, "split", "temp")
    return rounded(cols.where("split = 'train'").unionByName(cols.where("split = 'val'")))


def u2_union_metric_tables(spark: SparkSession, sf: str) -> DataFrame:
    m = stored(worked.naive_metrics(spark, sf), "metrics")  # a few rows, computed once for all six tables
    tables = []
    for model in worked.NAIVE:
        for kind in ("Train", "Test"):
            t = m.where((F.col("model") == model) & (F.col("metric_type") == kind)).drop("n_rows")
            tables.append(t.drop("mape") if kind == "Train" else t)
    return rounded(report.union_metrics(tables))


def u3_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.unpivot_metric(report.train_beside_test(worked.naive_metrics(spark, sf))))


def u4_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.pivot_metric(worked.naive_metrics(spark, sf)))


def u5_nested_to_rows(spark: SparkSession, sf: str) -> DataFrame:
    m = worked.naive_metrics(spark, sf).where(F.col("metric_type") == "Test")
    inner = F.create_map(F.lit("RMSE"), F.col("rmse"), F.lit("MAE"), F.col("mae"), F.lit("R2"), F.col("r2"))
    nested = m.groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("target_t"), F.col("horizon")), inner))).alias("metrics")
    )
    return rounded(nested_to_rows(nested, "metrics", "target", "metric", "score"))


def u6_forecast_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecasts(spark, sf))


# Stored tables


def a4_predictions_table(spark: SparkSession, sf: str) -> DataFrame:
    naive = worked.naive_forecasts(spark, sf).where((F.col("model") == "half_way") & (F.col("split") == "test"))
    path = scratch_table(spark, "predictions")
    write_table(naive.select(*KEY, "horizon", "y", "pred"), path)
    return rounded(to_wide(read_table(spark, path, PREDICTIONS), (1, 7), KEY))


def a5_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_table(spark, "metrics")
    write_table(worked.naive_metrics(spark, sf).drop("n_rows"), path, "json")
    return rounded(read_table(spark, path, METRICS, "json"))


def a6_parameters_table(spark: SparkSession, sf: str) -> DataFrame:
    best = report.best_trial(report.mean_over_folds(blend_scores(spark, sf))).select(
        F.lit("Blend").alias("model"), "horizon", "trial", F.when(F.col("trial") > 1, "lean").alias("kind"))
    path = scratch_table(spark, "parameters")
    write_table(parameter_rows(best, ["trial", "kind"]), path, "csv")
    return read_table(spark, path, PARAMETERS, "csv")


def a10_small_table(spark: SparkSession, sf: str) -> DataFrame:
    records = [r.asDict() for r in benchmark(spark, sf).collect()]  # one row per model
    return rounded(spark.createDataFrame(records, "model string, train_rmse double, val_rmse double, test_rmse double"))


# Monitoring


def _rolling(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    naive = worked.naive_forecasts(spark, sf).where((F.col("model") == "half_way") & F.col("y").isNotNull())
    base = evaluate(naive.where(F.col("split") == "train"))
    return monitor.rolling_rmse(naive.where(F.col("split") != "train"), days=30), base


def w10_rolling_rmse(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = _rolling(spark, sf)
    return rounded(out.withColumn("day", F.col("day").cast("timestamp_ntz")))


def w10_drift(spark: SparkSession, sf: str) -> DataFrame:
    rolling, base = _rolling(spark, sf)
    out = monitor.drift(rolling, base, 1.2)
    return rounded(out.withColumn("day", F.col("day").cast("timestamp_ntz")))


def w10_retrain_days(spark: SparkSession, sf: str) -> DataFrame:
    rolling, base = _rolling(spark, sf)
    trained_on = F.lit("2023-07-27").cast("date")
    out = monitor.retrain_days(monitor.drift(rolling, base, 1.2), trained_on)
    return out.withColumn("day", F.col("day").cast("timestamp_ntz"))


QUERIES = {
    "a4_predictions_table": a4_predictions_table,
    "a5_metrics_table": a5_metrics_table,
    "a6_parameters_table": a6_parameters_table,
    "a10_small_table": a10_small_table,
    "b15_keys_in_both": b15_keys_in_both,
    "b18_overfit_gap": b18_overfit_gap,
    "b19_residual": b19_residual,
    "b26_band": b26_band,
    "j1_actual_with_predicted": j1_actual_with_predicted,
    "j2_train_beside_test": j2_train_beside_test,
    "j3_align_features_target": j3_align_features_target,
    "j4_align_prediction": j4_align_prediction,
    "j5_labels_by_time": j5_labels_by_time,
    "j6_fixed_categories": j6_fixed_categories,
    "j7_parameters_with_defaults": j7_parameters_with_defaults,
    "g1_mean_by_month": _mean("month"),
    "g2_mean_by_year": _mean("year"),
    "g3_mean_by_season": _mean("season"),
    "g4_climograph": _mean("month", ("temp", "precip", "humidity")),
    "g5_correlations": g5_correlations,
    "g6_histogram": g6_histogram,
    "g7_density": g7_density,
    "g8_overall_mean": g8_overall_mean,
    "g8_mean_residual": g8_mean_residual,
    "g9_box_statistics": _box(True),
    "g9_box_statistics_bracketed": _box(False),
    "g9_outliers": g9_outliers,
    "g10_lines": g10_lines,
    "g11_point_pairs": g11_point_pairs,
    "g12_g15_metrics": g12_g15_metrics,
    "m13_evaluate_per_horizon": m13_evaluate_per_horizon,
    "g17_mean_over_folds": g17_mean_over_folds,
    "g18_mean_best_iteration": g18_mean_best_iteration,
    "g19_mean_metric_per_model": g19_mean_metric_per_model,
    "g20_forecast_summary": g20_forecast_summary,
    "g21_missing_counts": g21_missing_counts,
    "s1_sort_by_time": s1_sort_by_time,
    "s2_rank_benchmark": s2_rank_benchmark,
    "s3_sort_by_horizon": s3_sort_by_horizon,
    "s4_last_rows": s4_last_rows,
    "s4_last_row": s4_last_row,
    "s5_first_horizons": s5_first_horizons,
    "s6_best_trial": s6_best_trial,
    "s7_order_models": s7_order_models,
    "u1_union_fit_parts": u1_union_fit_parts,
    "u2_union_metric_tables": u2_union_metric_tables,
    "u3_unpivot": u3_unpivot,
    "u4_pivot": u4_pivot,
    "u5_nested_to_rows": u5_nested_to_rows,
    "u6_forecast_rows": u6_forecast_rows,
    "w10_rolling_rmse": w10_rolling_rmse,
    "w10_drift": w10_drift,
    "w10_retrain_days": w10_retrain_days,
}
