"""Cases that once gave a wrong answer or failed."""

from __future__ import annotations

import warnings

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from leadtide.catalog import worked
from leadtide.operators.blocks import over_series
from leadtide.operators.explore import density
from leadtide.operators.quantiles import exact_quantiles
from leadtide.operators.sums import solve_many

SF = "/root/testdata/sf0.001"


def test_a_cut_series_refuses_unbounded_frames(spark):
    df, layout = worked.hourly(spark, SF, 100)
    assert layout.blocked
    with pytest.raises(ValueError, match="block border"):
        over_series(df, layout, lambda d, w: d.withColumn("x", F.sum("temp").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    with pytest.raises(ValueError, match="block border"):
        over_series(df, layout, lambda d, w: d.withColumn("x", F.sum("temp").over(w.rowsBetween(-5, 0))), back=4)


@pytest.mark.parametrize("case", range(12))
def test_penalized_fits_meet_their_optimality_conditions(case):
    rng = np.random.default_rng(case)
    n, p = [(60, 8), (12, 20), (40, 15)][case % 3]
    x = rng.normal(size=(n, p))
    if case % 4 == 0:
        x[:, 1] = x[:, 0] + 1e-7 * rng.normal(size=n)
    if case % 4 == 1:
        x[:, 0] = 3.0  # no variance: its entry may come out below zero
    y = x @ rng.normal(size=p) + rng.normal(size=n)
    full = np.column_stack([np.ones(n), x, y - y.mean()])
    alphas, ratios = [0.001, 0.01, 0.1, 0.05], [1.0, 1.0, 1.0, 0.5]
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        _, w = solve_many(full.T @ full, ["Lasso"] * 3 + ["ElasticNet"], alphas, ratios)
    c = x - x.mean(axis=0)
    for k, (alpha, ratio) in enumerate(zip(alphas, ratios)):
        slope = c.T @ (c @ w[:, k] - (y - y.mean())) / n + alpha * (1 - ratio) * w[:, k]
        on = w[:, k] != 0
        assert np.abs(slope[on] + alpha * ratio * np.sign(w[on, k])).max(initial=0) < 1e-6
        assert (np.abs(slope[~on]) - alpha * ratio).max(initial=0) < 1e-6


def test_penalized_fits_with_columns_of_very_different_spread():
    rng = np.random.default_rng(0)
    n, p = 400, 6
    x = rng.normal(size=(n, p))
    x[:, 0] *= 70.0
    x[:, 2] = x[:, 1] + 2e-5 * x[:, 2]
    y = x @ np.array([0.5, 1.0, 0.0, -1.0, 0.2, 0.0]) + 200 * (x[:, 2] - x[:, 1]) + rng.normal(size=n)
    full = np.column_stack([np.ones(n), x, y - y.mean()])
    alphas = [1.1e-5, 1.5e-5, 3e-5]
    _, w = solve_many(full.T @ full, ["Lasso"] * 3, alphas, [1.0] * 3)
    c = x - x.mean(axis=0)
    for k, alpha in enumerate(alphas):
        slope = c.T @ (c @ w[:, k] - (y - y.mean())) / n
        on = w[:, k] != 0
        assert np.abs(slope[on] + alpha * np.sign(w[on, k])).max(initial=0) < 1e-7
        assert (np.abs(slope[~on]) - alpha).max(initial=0) < 1e-7


def test_density_without_spread_has_no_rows(spark):
    for rows in ([], [(1.0,)], [(2.0,), (2.0,)], [(None,), (None,)]):
        assert density(spark.createDataFrame(rows, "temp double"), "temp").count() == 0


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    frame = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, 3.0, inf, inf, inf]], "x double")
    got = exact_quantiles(frame, ["x"], [0.0, 0.25, 0.5, 1.0]).first()
    assert got["quantiles"] == [-inf, 1.5, 3.0, inf]
