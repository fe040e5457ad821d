from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from leadtide.config import ALPHA_RANGE, DAILY, LINEAR_MODELS, TREE_RANGES, target_name
from leadtide.operators.blocks import lay_out
from leadtide.operators.features import build_features, feature_pipeline
from leadtide.operators.models import (
    LinearParams, fit_linear_by_sums, fit_linear_per_horizon, horizons_by_rows, score_linear, score_models,
)
from leadtide.operators.sums import one_label, product_sums, solve_many, squared_errors
from leadtide.operators.tuning import draw_linear, draw_trees, fold_features, search_linear
from leadtide.plans.chain import prepare

P = 5
COLUMNS = [f"x{i}" for i in range(P)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, P))
    x[:, 1] = 0.95 * x[:, 0] + 0.05 * x[:, 1]
    w = np.array([1.5, 0.0, -2.0, 0.0, 0.3])
    y1 = 20 + x @ w + rng.normal(size=600)
    y2 = 20 + x @ w[::-1] + rng.normal(size=600)
    rows = [tuple(map(float, (*a, b, c))) for a, b, c in zip(x, y1, y2)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*COLUMNS, "target_t1", "target_t2"])).persist()
    return df, x, {1: y1, 2: y2}


def objective(kind, x, y, b0, w, alpha, ratio):
    e = y - b0 - x @ w
    if kind == "Ridge":
        return e @ e + alpha * w @ w
    mix = 1.0 if kind == "Lasso" else ratio
    return e @ e / (2 * len(y)) + alpha * mix * np.abs(w).sum() + alpha * (1 - mix) / 2 * w @ w


@pytest.mark.parametrize("kind, alpha", [("LinearRegression", 0.0), ("Ridge", 25.0), ("Lasso", 0.2), ("ElasticNet", 0.3)])
def test_both_fits_reach_the_optimum(data, kind, alpha):
    df, x, ys = data
    params = {h: LinearParams(kind, alpha, 0.4) for h in (1, 2)}
    by_sums = fit_linear_by_sums(df, COLUMNS, params)
    by_ml = fit_linear_per_horizon(df, COLUMNS, params)
    for h, y in ys.items():
        a, b = by_sums[h], by_ml[h]
        assert np.allclose(a.weights, b.coefficients.toArray(), atol=2e-5)
        assert a.intercept == pytest.approx(b.intercept, abs=2e-5)
        if kind in ("LinearRegression", "Ridge"):
            c = x - x.mean(0)
            w = np.linalg.solve(c.T @ c + alpha * np.eye(P), c.T @ (y - y.mean()))
            assert np.allclose(a.weights, w, atol=1e-9)
        else:
            best = objective(kind, x, y, a.intercept, np.array(a.weights), alpha, 0.4)
            rng = np.random.default_rng(1)
            for _ in range(200):
                other = np.array(a.weights) + rng.normal(scale=1e-3, size=P)
                assert objective(kind, x, y, y.mean() - x.mean(0) @ other, other, alpha, 0.4) >= best - 1e-12


def test_scores_agree(data):
    df, _, _ = data
    models = fit_linear_per_horizon(df, COLUMNS, {1: LinearParams(), 2: LinearParams("Ridge", 3.0)})
    a, b = score_linear(df, models, COLUMNS), score_models(df, models, COLUMNS)
    for h in (1, 2):
        p = f"pred_target_t{h}"
        assert np.allclose([r[0] for r in a.select(p).collect()], [r[0] for r in b.select(p).collect()], atol=1e-9)


def test_errors_from_sums(data):
    df, x, ys = data
    sums, centre = product_sums(df.repartition(6), COLUMNS, ["target_t1", "target_t2"])
    row = sums.first()["sums"]
    for i, h in enumerate((1, 2)):
        m = one_label(row, 2, i)
        b0, w = solve_many(m, ["Ridge", "Lasso"], [1.0, 0.1], [0.0, 0.0])
        for k in range(2):
            e = ys[h] - centre[i] - b0[k] - x @ w[:, k]
            assert squared_errors(m, b0, w)[k] == pytest.approx(e @ e, rel=1e-10)


def test_rows_with_other_gaps_make_other_groups(data):
    df, _, _ = data
    holes = df.withColumn("target_t2", F.when(F.col("x0") > 0, F.col("target_t2")))
    assert horizons_by_rows(df, [1, 2]) == [[1, 2]]
    assert horizons_by_rows(holes, [1, 2]) == [[2], [1]]


def daily_series(spark, n=400):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        t = dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
        rows.append(("s", t, float(25 + 3 * np.sin(i / 58) + rng.normal()), float(rng.uniform(40, 90)),
                     None if i % 17 == 0 else float(rng.gamma(2)), float(max(rng.normal(), 0)), float(1010 + rng.normal())))
    return spark.createDataFrame(
        rows, "series_id string, datetime timestamp_ntz, temp double, humidity double, windspeed double, precip double, sealevelpressure double")


def test_search_equals_fold_by_fold_fits(spark):
    df = daily_series(spark)
    layout = lay_out(df)
    ready = prepare(df, layout, (1, 3)).persist()
    trials, scores = search_linear(ready, DAILY, (1, 3), gap=7, n_trials=8)
    params = {(r["horizon"], r["trial"]): r for r in trials.collect()}
    folded, columns = fold_features(ready, DAILY, ["target_t1", "target_t3"], 7)
    pdf = folded.toPandas()
    checked = 0
    for s in scores.collect():
        r = params[(s["horizon"], s["trial"])]
        part = pdf[pdf.fold == s["fold"]]
        fit, val = part[part.role == "train"], part[part.role == "val"]
        y = target_name(s["horizon"])
        x, t = fit[columns].to_numpy(), fit[y].to_numpy()
        c = np.hstack([np.ones((len(x), 1)), x, (t - t.mean())[:, None]])
        b0, w = solve_many(c.T @ c, [r["kind"]], [r["alpha"] or 0.0], [r["l1_ratio"] or 0.0])
        e = val[y].to_numpy() - t.mean() - b0[0] - val[columns].to_numpy() @ w[:, 0]
        assert s["rmse"] == pytest.approx(np.sqrt(np.mean(e * e)), rel=1e-6)
        checked += 1
    assert checked == 2 * 8 * 4  # the fifth fold does not fit
    assert {r["n_folds"] for r in params.values()} == {4}


def test_draws(spark):
    studies = spark.range(20).select(F.col("id").alias("horizon"))
    a = draw_linear(studies, 50, 1, ["horizon"])
    rows = a.orderBy("horizon", "trial").collect()
    assert rows == draw_linear(studies.repartition(3), 50, 1, ["horizon"]).orderBy("horizon", "trial").collect()
    assert {r["kind"] for r in rows} == set(LINEAR_MODELS)
    alphas = [r["alpha"] for r in rows if r["kind"] != "LinearRegression"]
    assert all(ALPHA_RANGE[0] <= x <= ALPHA_RANGE[1] for x in alphas)
    assert 0.3 < np.mean([x < np.sqrt(ALPHA_RANGE[0] * ALPHA_RANGE[1]) for x in alphas]) < 0.7
    assert all((r["l1_ratio"] is not None) == (r["kind"] == "ElasticNet") for r in rows)
    depths = {r["max_depth"] for r in draw_trees(studies, 50, 1, ["horizon"], TREE_RANGES).collect()}
    assert depths == set(range(3, 11))


def test_pipeline_can_be_saved(spark, tmp_path):
    df = daily_series(spark, 120)
    model = feature_pipeline(DAILY).fit(df)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    want = build_features(df, lay_out(df), DAILY)
    for m in (model, again):
        got = m.transform(df).select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert again.stages[-1].getOrDefault("columns") == [
        "humidity", "sealevelpressure", "windspeed", "precip", "month_sin", "month_cos", "day_sin", "day_cos",
        "sealevelpressure_change",
    ]
