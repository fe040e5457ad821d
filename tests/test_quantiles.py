from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtide.operators.quantiles import QUARTILES, exact_quantiles


@pytest.mark.parametrize("n", [1, 2, 3, 99, 101, 5000, 90_000])
@pytest.mark.parametrize("kind", ["normal", "ties", "heavy"])
def test_against_numpy(spark, n, kind):
    rng = np.random.default_rng(n)
    x = {"normal": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float), "heavy": rng.standard_cauchy(n)}[kind]
    g = rng.integers(0, 2, n)
    df = spark.createDataFrame([(int(a), None if i % 10 == 3 else float(b)) for i, (a, b) in enumerate(zip(g, x))], "g int, x double")
    known = np.array([i % 10 != 3 for i in range(n)])
    got = exact_quantiles(df.repartition(7), ["x"]).first()
    assert got["n"] == known.sum()
    assert np.allclose(got["quantiles"], np.percentile(x[known], [25, 50, 75]), rtol=1e-12, atol=1e-12)
    for r in exact_quantiles(df, ["x"], QUARTILES, ["g"]).collect():
        part = x[known & (g == r["g"])]
        assert np.allclose(r["quantiles"], np.percentile(part, [25, 50, 75]), rtol=1e-12, atol=1e-12)


def test_both_ways_agree(spark):
    df = spark.range(30_000).select((F.rand(3) * 100).alias("a"), F.when(F.rand(4) < 0.7, 0.0).otherwise(F.rand(5)).alias("b"))
    df = df.persist()
    slow = {r["feature"]: r["quantiles"] for r in exact_quantiles(df, ["a", "b"]).collect()}
    fast = {r["feature"]: r["quantiles"] for r in exact_quantiles(df, ["a", "b"], at_most=30_000).collect()}
    for c in ("a", "b"):
        assert np.allclose(slow[c], fast[c], rtol=1e-12)


def test_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert [r["feature"] for r in exact_quantiles(df, ["a", "b"]).collect()] == ["a"]
