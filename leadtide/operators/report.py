"""Tables behind the forecast cards, comparison charts and parameter pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtide.config import KEYS, TIME, pred_name
from leadtide.functions.calendar import add_ahead
from leadtide.functions.labels import relative_gap
from leadtide.functions.weather import temperature_band


def last_rows(df: DataFrame, rows: int, keys: Sequence[str] = KEYS, time: str = TIME) -> DataFrame:
    """The last ``rows`` rows per series. Spark cuts every task to its own last rows before the
    shuffle, so a long series does not arrive whole anywhere."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= rows).drop("_rank")


def last_row(df: DataFrame, keys: Sequence[str] = KEYS, time: str = TIME) -> DataFrame:
    """The last row per series, by an aggregate with partial results in every task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_r")).select(*keys, "_r.*")


def forecast_rows(last: DataFrame, horizons: Sequence[int], value: str = "temp") -> DataFrame:
    """The prediction columns of the last row as one row per horizon; absent columns are skipped."""
    there = [h for h in horizons if pred_name(h) in last.columns]
    rows = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(pred_name(h)).alias("pred")) for h in there])
    return last.select(*KEYS, TIME, F.col(value).alias("last_value"), F.inline(rows))


def first_horizons(forecasts: DataFrame, k: int, keys: Sequence[str] = KEYS) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("horizon")
    return forecasts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def forecast_cards(forecasts: DataFrame, unit: str) -> DataFrame:
    """Date, change against the last value, trend, band and texts for every forecast."""
    delta = F.col("pred") - F.col("last_value")
    date = F.col("forecast_date")
    return forecasts.withColumn("forecast_date", add_ahead(TIME, F.col("horizon"), unit)).withColumns(
        {
            "delta": delta,
            "trend": F.when(delta >= 0, "up").when(delta < 0, "down"),
            "band": temperature_band(F.col("pred")),
            "day_name": F.date_format(date, "EEEE"),
            "date_text": F.date_format(date, "dd MMM yyyy"),
        }
    )


def forecast_summary(forecasts: DataFrame, unit: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean, warmest and coolest forecast with their dates; ties go to the nearest horizon."""
    known = forecasts.where(F.col("pred").isNotNull())
    h = F.col("horizon")
    out = known.groupBy(*keys).agg(
        F.avg("pred").alias("mean_pred"),
        F.max("pred").alias("max_pred"),
        F.min("pred").alias("min_pred"),
        F.max_by(h, F.struct("pred", -h)).alias("warmest_horizon"),
        F.min_by(h, F.struct("pred", h)).alias("coolest_horizon"),
        F.max(TIME).alias(TIME),
    )
    text = "MMM dd"
    return out.withColumns(
        {
            "spread": F.col("max_pred") - F.col("min_pred"),
            "warmest_date": F.date_format(add_ahead(TIME, F.col("warmest_horizon"), unit), text),
            "coolest_date": F.date_format(add_ahead(TIME, F.col("coolest_horizon"), unit), text),
        }
    ).drop(TIME)


def residuals(actual: DataFrame, predicted: DataFrame, y: str, pred: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Join actual and predicted values on series and time; residual = actual - predicted."""
    on = [*keys, TIME]
    joined = actual.select(*on, y).join(predicted.select(*on, pred), on, "inner")
    return joined.withColumn("residual", F.col(y) - F.col(pred))


def train_beside_test(metrics: DataFrame, how: str = "left") -> DataFrame:
    """Train metrics with test metrics of the same model and horizon; mape exists for test only.

    ``metrics`` has one row per model, horizon and kind, so one conditional aggregate replaces a join.
    """
    aggs = []
    for kind in ("Train", "Test"):
        own = F.col("metric_type") == kind
        aggs += [F.max(F.when(own, F.col(m))).alias(f"{m}_{kind.lower()}") for m in ("rmse", "mae", "r2")]
    test = F.col("metric_type") == "Test"
    aggs += [F.max(F.when(test, F.col("mape"))).alias("mape"), F.count_if(F.col("metric_type") == "Train").alias("_train"),
             F.count_if(test).alias("_test")]
    both = metrics.groupBy("model", "horizon").agg(*aggs)
    return both.where("_train > 0" if how == "left" else "_train > 0 AND _test > 0").drop("_train", "_test")


def with_gap(beside: DataFrame) -> DataFrame:
    """Overfit gap: how much larger the test RMSE is, in percent."""
    return beside.withColumn("gap_pct", relative_gap(F.col("rmse_train"), F.col("rmse_test")))


def pivot_metric(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """One row per model and horizon with the mean metric of Train and Test side by side."""
    wide = metrics.groupBy("horizon", "model").pivot("metric_type", ["Train", "Test"]).agg(F.avg(metric))
    return wide.withColumn("gap_pct", relative_gap(F.col("Train"), F.col("Test")))


def unpivot_metric(beside: DataFrame, metric: str = "r2") -> DataFrame:
    """Train and test column of a metric as rows (metric name, value)."""
    return beside.unpivot(["model", "horizon"], [f"{metric}_train", f"{metric}_test"], "metric", "score")


def union_metrics(tables: Sequence[DataFrame]) -> DataFrame:
    """Metric tables under each other; a column one of them lacks becomes NULL there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def order_models(metrics: DataFrame, metric: str = "rmse", higher_is_better: bool = False) -> DataFrame:
    """Models by their mean test metric, best first."""
    mean = metrics.where(F.col("metric_type") == "Test").groupBy("model").agg(F.avg(metric).alias("mean_metric"))
    best = F.col("mean_metric").desc() if higher_is_better else F.col("mean_metric").asc()
    return mean.orderBy(best, "model")


def fill_categories(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """All listed categories in the result, with NULL where a category has no row."""
    listed = df.sparkSession.createDataFrame([(n,) for n in names], f"{column} string")
    return listed.join(df, column, "left")


def mean_over_folds(scores: DataFrame) -> DataFrame:
    """Validation score and truncated mean best iteration per trial and horizon."""
    cols = [F.avg("rmse").alias("val_rmse"), F.count("rmse").alias("n_folds")]
    if "best_iteration" in scores.columns:
        cols.append(F.floor(F.avg("best_iteration")).cast("int").alias("avg_best_iteration"))
    return scores.groupBy("trial", "horizon").agg(*cols)


def best_trial(trials: DataFrame, by: Sequence[str] = ("horizon",), score: str = "val_rmse") -> DataFrame:
    """The trial with the lowest score per horizon; the first one wins a tie."""
    rest = [c for c in trials.columns if c not in by]
    order = F.struct(F.col(score), F.col("trial"))
    known = trials.where(F.col(score).isNotNull())
    return known.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_b")).select(*by, "_b.*")


def with_default_parameters(wanted: DataFrame, best: DataFrame, defaults: dict[str, object], on: Sequence[str]) -> DataFrame:
    """Parameters per wanted row, with defaults for missing rows and missing values."""
    joined = wanted.join(best.select(*on, *defaults), list(on), "left")
    return joined.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def rank_benchmark(results: DataFrame) -> DataFrame:
    """Relative gaps to the train error, sorted by test error."""
    out = results.withColumns(
        {
            "gap_val_pct": relative_gap(F.col("train_rmse"), F.col("val_rmse")),
            "gap_test_pct": relative_gap(F.col("train_rmse"), F.col("test_rmse")),
        }
    )
    return out.orderBy("test_rmse", "model")


def missing_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and missing count per column."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns]
    )
