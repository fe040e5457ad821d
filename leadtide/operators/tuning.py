"""Search over model parameters on purged expanding folds.

The linear family needs no pass over the data per trial: sums of products per fold part hold all
that a fit and its validation error depend on. The trials are then solved as Spark tasks over a
grid of (horizon, fold), each a system as small as the number of features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.config import (
    ALPHA_RANGE, FOLDS, L1_RATIO_RANGE, LEAST_LEAF_ROWS, LINEAR_MODELS, MAX_ROUNDS, PATIENCE, TIME, FeatureSpec, target_name,
)
from leadtide.operators.blocks import BLOCK_ROWS, lay_out
from leadtide.operators.features import build_features
from leadtide.operators.boosting import Boost, boost
from leadtide.operators.models import horizons_by_rows, side_by_side
from leadtide.operators.report import mean_over_folds
from leadtide.operators.scaling import scale_per_group
from leadtide.operators.splits import assign_folds, check_no_leak
from leadtide.operators.sums import one_label, product_sums, solve_many, squared_errors
from leadtide.session import cut_lineage, stored


CHUNKS = 4


# Drawing parameters


def uniform(seed: int, name: str, *ids: str) -> Column:
    """A number in [0, 1) that depends only on seed, name and ids: the same on every run and engine."""
    said = F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[F.col(i).cast("string") for i in ids])
    return F.conv(F.substring(F.sha2(said, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def draw(u: Column, low: float, high: float, scale: str = "uniform") -> Column:
    """Uniform, log-uniform or integer (both ends included) in a range."""
    if scale == "log":
        return F.exp(F.lit(math.log(low)) + u * F.lit(math.log(high) - math.log(low)))
    if scale == "int":
        return F.least(F.floor(F.lit(float(low)) + u * (high - low + 1)), F.lit(high)).cast("int")
    return F.lit(float(low)) + u * F.lit(float(high) - float(low))


def draw_choice(u: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.floor(u * len(names)) + 1).cast("int"))


def with_trials(studies: DataFrame, n_trials: int) -> DataFrame:
    """Every study (one search per row, for example a horizon) with its trial numbers."""
    return studies.withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(n_trials))))


def draw_linear(studies: DataFrame, n_trials: int, seed: int, ids: Sequence[str]) -> DataFrame:
    """Model kind, alpha (log scale) and mixing ratio; NULL where the kind does not use them."""
    by = [*ids, "trial"]
    trials = with_trials(studies, n_trials).withColumn(
        "kind", draw_choice(uniform(seed, "kind", *by), LINEAR_MODELS)
    )
    alpha = draw(uniform(seed, "alpha", *by), *ALPHA_RANGE, "log")
    ratio = draw(uniform(seed, "l1_ratio", *by), *L1_RATIO_RANGE)
    return trials.withColumns(
        {
            "alpha": F.when(F.col("kind") != "LinearRegression", alpha),
            "l1_ratio": F.when(F.col("kind") == "ElasticNet", ratio),
        }
    )


def draw_trees(studies: DataFrame, n_trials: int, seed: int, ids: Sequence[str], ranges: dict) -> DataFrame:
    by = [*ids, "trial"]
    cols = {name: draw(uniform(seed, name, *by), *r) for name, r in ranges.items()}
    return with_trials(studies, n_trials).withColumns(cols)


# Folds with features fitted inside them


def fold_features(
    df: DataFrame,
    spec: FeatureSpec,
    targets: Sequence[str],
    gap: int,
    folds: int = FOLDS,
    block_rows: int = BLOCK_ROWS,
    at_most: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """Train + val rows with known targets, cut into folds; features restart in each fold part
    and are scaled with constants of the training part alone. A fold that leaks fails the job."""
    known = df.where(F.col("split") != "test").dropna("any", subset=list(targets))
    layout = lay_out(known, block_rows=block_rows, at_most=at_most, unique=True)  # rows that had a layout before
    parts = assign_folds(known, layout, gap, folds)
    ready = build_features(parts, layout, spec, scope=["fold", "role"], keep=targets)
    front = {*layout.keys, layout.time, "fold", "role", *targets}
    columns = [c for c in ready.columns if c not in front]
    ready = stored(ready, "folds")  # read by the check, by the scaler, twice, and by the sums
    check_no_leak(ready, layout.keys, layout.time)
    copies = None if layout.rows is None else layout.rows * folds
    return scale_per_group(ready, columns, ["fold"], F.col("role") == "train", copies), columns


# Trials


def score_trials(sums: DataFrame, trials: DataFrame) -> DataFrame:
    """Validation RMSE per (horizon, fold, trial), solved in parallel per horizon and fold.

    ``sums`` has one row per (horizon, fold, role) with ``label``, the position of the label of
    the horizon, and ``labels``, their number; ``trials`` has one row per (horizon, trial).
    """
    role = F.col("role")
    parts = sums.groupBy("horizon", "fold", "label", "labels").agg(
        F.first(F.when(role == "train", F.col("sums")), ignorenulls=True).alias("train"),
        F.first(F.when(role == "val", F.col("sums")), ignorenulls=True).alias("val"),
    ).where(F.col("train").isNotNull() & F.col("val").isNotNull())
    # Trials of a horizon are dealt into CHUNKS bundles, solved side by side; a set number of
    # partitions keeps these small but slow rows from being put into one task.
    sets = trials.groupBy("horizon", (F.col("trial") % CHUNKS).alias("chunk")).agg(
        F.collect_list(F.struct("trial", "kind", "alpha", "l1_ratio")).alias("sets")
    )
    tasks = max(sums.sparkSession.sparkContext.defaultParallelism, 1)
    grid = parts.join(sets, "horizon").repartition(tasks, "horizon", "fold", "chunk")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                fit, val = (one_label(s, r.labels, r.label) for s in (r.train, r.val))
                kinds = [s["kind"] for s in r.sets]
                alphas, ratios = ([s[k] or 0.0 for s in r.sets] for k in ("alpha", "l1_ratio"))
                errors = squared_errors(val, *solve_many(fit, kinds, alphas, ratios))
                yield pd.DataFrame({
                    "horizon": r.horizon, "fold": r.fold, "trial": [s["trial"] for s in r.sets],
                    "rmse": np.sqrt(errors / val[0, 0]),
                })

    return grid.mapInPandas(solve, "horizon int, fold int, trial int, rmse double")


def search_linear(
    df: DataFrame,
    spec: FeatureSpec,
    horizons: Sequence[int],
    gap: int,
    n_trials: int,
    seed: int = 42,
    folds: int = FOLDS,
    block_rows: int = BLOCK_ROWS,
    at_most: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Trials with their mean validation RMSE over the folds, and the scores per fold.

    ``df`` has ``split`` and target columns. The data is read for the sums only, once per group of
    horizons; the sums are cut from their lineage, as all trials read them.
    """
    found = []
    for group in horizons_by_rows(df.where(F.col("split") != "test"), horizons):
        labels = [target_name(h) for h in group]
        ready, columns = fold_features(df, spec, labels, gap, folds, block_rows, at_most)
        which = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(i).alias("label")) for i, h in enumerate(group)]))
        sums = product_sums(ready, columns, labels, ["fold", "role"])[0].withColumn("_h", which)
        found.append(sums.select("_h.*", F.lit(len(group)).alias("labels"), F.col("fold").cast("int"), "role", "sums"))
    all_sums = found[0]
    for sums in found[1:]:
        all_sums = all_sums.unionByName(sums)
    all_sums = cut_lineage(all_sums)
    trials = draw_linear(all_sums.select("horizon").distinct(), n_trials, seed, ["horizon"])
    scores = cut_lineage(score_trials(all_sums, trials))
    mean = scores.groupBy("horizon", "trial").agg(
        F.avg("rmse").alias("val_rmse"), F.count(F.lit(1)).cast("int").alias("n_folds")
    )
    return trials.join(mean, ["horizon", "trial"]), scores


def search_trees(
    df: DataFrame,
    spec: FeatureSpec,
    horizons: Sequence[int],
    gap: int,
    n_trials: int,
    ranges: dict,
    max_rounds: int = MAX_ROUNDS,
    patience: int | None = PATIENCE,
    seed: int = 42,
    folds: int = FOLDS,
    at_most: int | None = None,
) -> DataFrame:
    """Trials of boosted trees with mean validation RMSE and mean best round over the folds.

    With ``patience`` each fit stops early on the validation part; without it the rounds are drawn
    like the other parameters (``n_estimators`` in ``ranges``). ``num_leaves`` in ``ranges`` grows the
    best leaf first. All trials and folds of the horizons with the same rows are fitted together, and such
    groups side by side; a score per fit comes back.
    """
    spark = df.sparkSession
    studies = spark.createDataFrame([(h,) for h in horizons], "horizon int")
    trials = draw_trees(studies, n_trials, seed, ["horizon"], ranges)
    drawn = [r.asDict() for r in trials.collect()]  # horizons * n_trials parameter sets

    def fitted(group: list[int]) -> list[tuple]:
        labels = [target_name(h) for h in group]
        ready, columns = fold_features(df, spec, labels, gap, folds, at_most=at_most)
        data = ready.select(
            F.col("fold").cast("int").alias("group"), F.xxhash64("series_id", TIME).alias("id"), (F.col("role") == "train").alias("train"),
            *[F.col(f"`{c}`") for c in [*columns, *labels]],
        )
        parts = [r["fold"] for r in ready.select("fold").distinct().orderBy("fold").collect()]  # at most ``folds`` rows
        fits = [(t, f) for t in drawn if t["horizon"] in group for f in parts]
        models = boost(data, columns, [_tree_model(t, f, max_rounds, patience) for t, f in fits], trees=False)
        return [(t["horizon"], t["trial"], int(f), m.rmse, m.best) for (t, f), m in zip(fits, models) if m and m.rmse is not None]

    groups = horizons_by_rows(df.where(F.col("split") != "test"), horizons)
    scores = [s for found in side_by_side(spark, [lambda g=g: fitted(g) for g in groups]) for s in found]
    table = spark.createDataFrame(scores, "horizon int, trial int, fold int, rmse double, best_iteration int")
    return trials.join(mean_over_folds(table), ["horizon", "trial"])


def _tree_model(trial: dict, fold: int, max_rounds: int, patience: int | None) -> Boost:
    leaves = trial.get("num_leaves") or 0
    return Boost(
        target_name(trial["horizon"]), int(fold), rounds=max_rounds if patience else trial["n_estimators"], patience=patience,
        learning_rate=trial["learning_rate"], max_depth=trial["max_depth"], subsample=trial["subsample"],
        colsample=trial["colsample_bytree"], reg_alpha=trial["reg_alpha"], reg_lambda=trial["reg_lambda"], num_leaves=leaves,
        least_rows=LEAST_LEAF_ROWS if leaves else 1, seed=42,
    )
