"""The whole jobs: prepare, train, score and evaluate, and the model bake-off."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtide.config import LEAST_LEAF_ROWS, LEAVES, PATIENCE, FeatureSpec, pred_name, target_name
from leadtide.operators.boosting import Boost, Fitted, boost, boost_per_horizon, score_boosted
from leadtide.operators.blocks import BLOCK_ROWS, SeriesLayout, lay_out
from leadtide.operators.evaluate import evaluate, to_long
from leadtide.operators.features import build_features, targets_and_features
from leadtide.operators.models import (
    FEATURES, LinearModel, LinearParams, assemble, decision_tree, fit_linear_by_sums, label_statistics,
    linear_estimator, random_forest, score_linear, side_by_side,
)
from leadtide.operators.report import rank_benchmark
from leadtide.operators.scaling import apply_robust_scaler, fit_robust_scaler
from leadtide.operators.splits import split_by_time
from leadtide.operators.windows import lead_targets
from leadtide.session import stored


def prepare(df: DataFrame, layout: SeriesLayout, horizons: Sequence[int]) -> DataFrame:
    """Targets over the whole table, then the split label."""
    return split_by_time(lead_targets(df, layout, horizons), layout)


@dataclass
class Trained:
    """A fitted job: feature columns, scaler constants, and a line or boosted trees per horizon."""

    columns: list[str]
    scaler: dict[str, tuple[float, float]]
    models: dict[int, Model | LinearModel | Fitted]


def prepared_features(
    df: DataFrame, layout: SeriesLayout, spec: FeatureSpec, horizons: Sequence[int]
) -> tuple[DataFrame, list[str]]:
    """Targets, split and features of observations, and the names of the feature columns."""
    ready = targets_and_features(df, layout, spec, horizons)
    front = {*layout.keys, layout.time, "part", "split", *[target_name(h) for h in horizons]}
    return ready, [c for c in ready.columns if c not in front]


def train(
    ready: DataFrame, columns: Sequence[str], params: dict[int, LinearParams | dict], at_most: int | None = None,
    by: Sequence[str] = ("series_id", "datetime"),
) -> Trained:
    """Scaler and one model per horizon on the fit part; ``ready`` should be a stored table.

    ``LinearParams`` ask for a line, a dict of arguments of ``Boost`` for boosted trees.
    """
    fit = ready.where(F.col("part") == "fit")
    scaler = fit_robust_scaler(fit, columns, at_most)
    scaled = apply_robust_scaler(fit, scaler)
    lines = {h: p for h, p in params.items() if isinstance(p, LinearParams)}
    trees = {h: p for h, p in params.items() if not isinstance(p, LinearParams)}
    models: dict = fit_linear_by_sums(scaled, columns, lines) if lines else {}
    if trees:
        models |= boost_per_horizon(scaled, columns, trees, by=by)
    return Trained(list(columns), scaler, {h: models[h] for h in params})


def score(ready: DataFrame, trained: Trained) -> DataFrame:
    """A prediction column per horizon. A horizon that no label was known for has NULL."""
    lines = {h: m for h, m in trained.models.items() if m is not None and not isinstance(m, Fitted)}
    trees = {pred_name(h): m for h, m in trained.models.items() if isinstance(m, Fitted)}
    out = score_linear(apply_robust_scaler(ready, trained.scaler), lines, trained.columns)
    if trees:
        out = score_boosted(out, trees, trained.columns)
    return out.withColumns({pred_name(h): F.lit(None).cast("double") for h, m in trained.models.items() if m is None})


def forecast_metrics(
    df: DataFrame,
    layout: SeriesLayout,
    spec: FeatureSpec,
    params: dict[int, LinearParams | dict],
) -> tuple[DataFrame, DataFrame, Trained]:
    """Prepare, train, score, evaluate. Returns long predictions, metrics and the models."""
    horizons = list(params)
    ready, columns = prepared_features(df, layout, spec, horizons)
    ready = stored(ready, "features")
    trained = train(ready, columns, params, layout.rows, [*layout.keys, layout.time])
    long = to_long(score(ready, trained), horizons, [*layout.keys, layout.time, "split"])
    kind = F.when(F.col("split") == "test", "Test").otherwise("Train")
    # A horizon without known labels keeps its row, with n_rows 0 and NULL metrics.
    metrics = evaluate(long.withColumn("metric_type", kind), ["metric_type", "horizon"])
    return long, metrics, trained


def linear_parameters(table: DataFrame, horizons: Sequence[int]) -> dict[int, LinearParams]:
    """Parameters per horizon from rows (horizon, name, value); what is missing takes its default."""
    said: dict[int, dict[str, str]] = {}
    for r in table.collect():  # a few names per horizon
        said.setdefault(r["horizon"], {})[r["name"]] = r["value"]
    plain = LinearParams()
    return {
        h: LinearParams(
            p.get("kind", plain.kind), float(p.get("alpha", plain.alpha)), float(p.get("l1_ratio", plain.l1_ratio))
        )
        for h, p in ((h, said.get(h, {})) for h in horizons)
    }


# Bake-off


def bake_off_table(
    df: DataFrame,
    spec: FeatureSpec,
    horizon: int,
    block_rows: int = BLOCK_ROWS,
    at_most: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """Rows with a known target; features restart in each of the three splits, scaled on train."""
    y = target_name(horizon)
    known = df.where(F.col(y).isNotNull())
    layout = lay_out(known, block_rows=block_rows, at_most=at_most, unique=True)  # rows that had a layout before
    ready = build_features(known, layout, spec, scope=["split"], keep=[y])
    columns = [c for c in ready.columns if c not in {*layout.keys, layout.time, "split", y}]
    ready = stored(ready, "features")
    scaler = fit_robust_scaler(ready.where(F.col("split") == "train"), columns, layout.rows)
    return apply_robust_scaler(ready, scaler), columns


def bake_off(
    table: DataFrame,
    columns: Sequence[str],
    horizon: int,
    boost_rounds: int = 1000,
    patience: int = PATIENCE,
    forest_trees: int = 100,
    threads: int = 3,
) -> DataFrame:
    """Six models on one horizon: RMSE on train, val and test, gaps, sorted by test RMSE.

    The boosted models grow by depth and by best leaf, with the defaults of the two kinds. Both stop
    early on the validation part.
    """
    y = target_name(horizon)
    keys = [c for c in table.columns if c not in {*columns, "split", y}]
    rows = stored(table.select("split", F.xxhash64(*keys).alias("id"), *[F.col(f"`{c}`") for c in columns], y), "bake-off")
    data = assemble(rows, columns).select("split", FEATURES, *columns, y)
    train_part = data.where(F.col("split") == "train").select(FEATURES, y)
    n, s = label_statistics(train_part, [y])[y]
    jobs = {
        "LinearRegression": lambda: linear_estimator(LinearParams("LinearRegression"), y, n, s).fit(train_part),
        "Ridge": lambda: linear_estimator(LinearParams("Ridge", 1.0), y, n, s).fit(train_part),
        "DecisionTree": lambda: decision_tree(y).fit(train_part),
        "RandomForest": lambda: random_forest(y, forest_trees).fit(train_part),
    }
    models = dict(zip(jobs, side_by_side(table.sparkSession, list(jobs.values()), threads)))
    scored = data
    for name, m in models.items():
        scored = m.copy({m.getParam("predictionCol"): f"p_{name}"}).transform(scored)
    seen = rows.where(F.col("split") != "test").withColumns({"group": F.lit(0), "train": F.col("split") == "train"})
    common = {"rounds": boost_rounds, "patience": patience, "learning_rate": 0.05}
    kinds = {
        "BoostedByDepth": Boost(y, max_depth=6, **common),
        "BoostedByLeaf": Boost(y, max_depth=LEAVES, num_leaves=LEAVES, least_rows=LEAST_LEAF_ROWS, reg_lambda=0.0, **common),
    }
    boosted = dict(zip(kinds, boost(seen, columns, list(kinds.values()))))
    scored = score_boosted(scored, {f"p_{k}": m for k, m in boosted.items()}, columns)
    models |= boosted
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("pred")) for m in models])
    e = F.col(y) - F.col("pred")
    errors = scored.select("split", y, F.inline(rows)).groupBy("model").agg(
        *[
            F.sqrt(F.avg(F.when(F.col("split") == part, e * e))).alias(f"{part}_rmse")
            for part in ("train", "val", "test")
        ]
    )
    return rank_benchmark(errors)
