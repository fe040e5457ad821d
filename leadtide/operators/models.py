"""One regression model per horizon on Spark ML, and scoring of all horizons together."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.config import DEFAULT_ALPHA, DEFAULT_L1_RATIO, pred_name, target_name
from leadtide.operators.sums import one_label, product_sums, solve_many

FEATURES = "features"


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)


@dataclass(frozen=True)
class LinearParams:
    """Model kind and penalties in their textbook scale: penalties on the sum (Ridge) or on the
    mean (Lasso, ElasticNet) of squared errors."""

    kind: str = "LinearRegression"
    alpha: float = DEFAULT_ALPHA
    l1_ratio: float = DEFAULT_L1_RATIO


def linear_estimator(params: LinearParams, label: str, n: int, label_std: float) -> LinearRegression:
    """The Spark estimator with the same optimum.

    Spark minimizes squares / 2n + regParam * (l1 * |w| + (1 - l1) / 2 * w^2 / label_std), so both
    penalties are rescaled. The normal solver needs one pass over the data for any of them.
    """
    a, l1 = params.alpha, params.l1_ratio
    if params.kind == "LinearRegression":
        reg, mix = 0.0, 0.0
    elif params.kind == "Ridge":
        reg, mix = a * label_std / n, 0.0
    elif params.kind == "Lasso":
        reg, mix = a, 1.0
    elif params.kind == "ElasticNet":
        reg = a * l1 + label_std * a * (1 - l1)
        mix = a * l1 / reg if reg else 0.0
    else:
        raise ValueError(f"unknown linear model {params.kind}")
    return LinearRegression(
        featuresCol=FEATURES, labelCol=label, solver="normal", standardization=False,
        regParam=reg, elasticNetParam=mix, maxIter=2000, tol=1e-10,
    )


def label_statistics(df: DataFrame, labels: Sequence[str]) -> dict[str, tuple[int, float]]:
    """Count and population deviation of every label, in one pass."""
    row = df.agg(
        *[F.count(y).alias(f"n_{y}") for y in labels], *[F.stddev_pop(y).alias(f"s_{y}") for y in labels]
    ).first()
    return {y: (row[f"n_{y}"], row[f"s_{y}"] or 0.0) for y in labels}


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]], threads: int = 4) -> list:
    """Submit independent Spark jobs from a few driver threads; each job runs on the executors.

    If one fails, or the wait is interrupted, what waits is dropped and what runs is cancelled.
    """
    tag = f"side-by-side-{uuid.uuid4().hex}"
    context = spark.sparkContext

    def tagged(job: Callable[[], object]) -> object:
        context.addJobTag(tag)
        try:
            return job()
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(lambda j=j: tagged(j))) for j in jobs]
        try:
            done, _ = wait(running, return_when=FIRST_EXCEPTION)
            for f in done:
                f.result()  # raises what failed, before any wait for the others
            return [f.result() for f in running]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            while not all(f.done() for f in running):  # a job may be sent off after the first call
                context.cancelJobsWithTag(tag)
                wait(running, timeout=0.5)
            raise


def fit_linear_per_horizon(
    df: DataFrame,
    columns: Sequence[str],
    params: dict[int, LinearParams],
    threads: int = 4,
) -> dict[int, Model]:
    """Fit one linear model per horizon on rows with a known target. ``df`` should be cached."""
    stats = label_statistics(df, [target_name(h) for h in params])
    ready = assemble(df, columns)

    def job(h: int, p: LinearParams):
        y = target_name(h)
        n, s = stats[y]
        return lambda: linear_estimator(p, y, n, s).fit(ready.where(F.col(y).isNotNull()).select(FEATURES, y))

    return dict(zip(params, side_by_side(df.sparkSession, [job(h, p) for h, p in params.items()], threads)))


def horizons_by_rows(df: DataFrame, horizons: Sequence[int]) -> list[list[int]]:
    """Horizons in groups with the same known rows; each group needs one pass only.

    Targets are missing at the end of a series, in the test part, so for the rows before it this
    is mostly one group.
    """
    known = {h: F.col(target_name(h)).isNotNull() for h in horizons}
    every = F.lit(True)
    for k in known.values():
        every = every & k
    row = df.agg(
        F.count_if(every).alias("every"), *[F.count_if(k).alias(f"n{h}") for h, k in known.items()]
    ).first()
    shared = [h for h in horizons if row[f"n{h}"] == row["every"]]
    return ([shared] if shared else []) + [[h] for h in horizons if h not in shared]


@dataclass(frozen=True)
class LinearModel:
    """A fitted line of one horizon."""

    intercept: float
    weights: tuple[float, ...]


def fit_linear_by_sums(
    df: DataFrame, columns: Sequence[str], params: dict[int, LinearParams]
) -> dict[int, LinearModel]:
    """Linear models of all horizons from one pass over the data.

    The sums that reach the driver are one matrix as wide as columns and labels together.
    """
    fitted: dict[int, LinearModel] = {}
    for group in horizons_by_rows(df, list(params)):
        sums, centre = product_sums(df, columns, [target_name(h) for h in group])
        row = sums.first()
        for i, h in enumerate(group):
            p = params[h]
            b0, w = solve_many(one_label(row["sums"], len(group), i), [p.kind], [p.alpha], [p.l1_ratio])
            fitted[h] = LinearModel(float(b0[0]) + centre[i], tuple(w[:, 0].tolist()))
    return {h: fitted[h] for h in params}


def as_linear_model(model: Model | LinearModel) -> LinearModel:
    if isinstance(model, LinearModel):
        return model
    return LinearModel(float(model.intercept), tuple(model.coefficients.toArray().tolist()))


def linear_model_rows(spark: SparkSession, models: dict[int, LinearModel], columns: Sequence[str]) -> DataFrame:
    """Fitted lines as a small table: horizon, name (or ``intercept``), weight."""
    rows = []
    for h, m in models.items():
        rows += [(h, "intercept", m.intercept), *[(h, c, w) for c, w in zip(columns, m.weights)]]
    return spark.createDataFrame(rows, "horizon int, name string, weight double")


def linear_models_from_rows(table: DataFrame) -> tuple[dict[int, LinearModel], list[str]]:
    """The inverse of ``linear_model_rows``; a row per horizon and feature reaches the driver."""
    found: dict[int, dict[str, float]] = {}
    for r in table.collect():
        found.setdefault(r["horizon"], {})[r["name"]] = r["weight"]
    columns = sorted({n for w in found.values() for n in w} - {"intercept"})
    return {
        h: LinearModel(w["intercept"], tuple(w.get(c, 0.0) for c in columns)) for h, w in sorted(found.items())
    }, columns


def linear_prediction(intercept: float, weights: Sequence[float], columns: Sequence[str]) -> Column:
    """The dot product as a plain expression."""
    out = F.lit(float(intercept))
    for w, c in zip(weights, columns):
        out = out + F.lit(float(w)) * F.col(c)
    return out


def score_linear(df: DataFrame, models: dict[int, Model | LinearModel], columns: Sequence[str]) -> DataFrame:
    """Predictions of all horizons in one projection, without vectors or Python."""
    lines = {h: as_linear_model(m) for h, m in models.items()}
    return df.withColumns(
        {pred_name(h): linear_prediction(m.intercept, m.weights, columns) for h, m in lines.items()}
    )


def score_models(df: DataFrame, models: dict[int, Model], columns: Sequence[str]) -> DataFrame:
    """Predictions of any models: one pass, one prediction column per horizon."""
    out = assemble(df, columns)
    for h, m in models.items():
        out = m.copy({m.getParam("predictionCol"): pred_name(h)}).transform(out)
    return out.drop(FEATURES)


# Trees


def decision_tree(label: str, max_depth: int = 30, max_bins: int = 256) -> DecisionTreeRegressor:
    """Grown as deep as Spark allows."""
    return DecisionTreeRegressor(
        featuresCol=FEATURES, labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=42, maxMemoryInMB=1024
    )


def random_forest(label: str, trees: int = 100, max_depth: int = 10, leaf: int = 5, max_bins: int = 256) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=max_depth, minInstancesPerNode=leaf,
        featureSubsetStrategy="all", maxBins=max_bins, seed=42, maxMemoryInMB=1024,
    )
