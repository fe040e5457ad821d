"""Hand-sized cases with known answers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadtide.functions.calendar import season
from leadtide.functions.labels import horizon_of, relative_gap
from leadtide.functions.weather import temperature_band
from leadtide.operators.blocks import lay_out, over_series
from leadtide.operators.evaluate import evaluate
from leadtide.operators.report import forecast_summary
from leadtide.operators.scaling import apply_robust_scaler, fit_robust_scaler
from leadtide.operators.splits import assign_folds, split_by_time
from leadtide.operators.windows import centred_band, difference, fill_gaps, lead_targets, trailing_mean
from leadtide.sources.observations import parse_time, parse_time_or_null, read_observations, require_columns

START = dt.datetime(2024, 1, 1)


def series(spark, values, name="s"):
    rows = [(name, START + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, datetime timestamp_ntz, temp double")


def column(df, name):
    return [r[name] for r in df.orderBy("series_id", "datetime").collect()]


def test_lead(spark):
    df = series(spark, [1, 2, 3, 4])
    assert column(lead_targets(df, lay_out(df), [2]), "target_t2") == [3, 4, None, None]


def test_difference(spark):
    df = series(spark, [5, 7, None, 9])
    out = over_series(df, lay_out(df), lambda d, w: d.withColumn("x", difference("temp", w)), back=1)
    assert column(out, "x") == [0, 2, 0, 0]


def test_trailing_mean(spark):
    df = series(spark, [None, 1, 2, None, 4, 5])
    out = over_series(df, lay_out(df), lambda d, w: d.withColumn("x", trailing_mean("temp", 3, w)), back=3)
    assert column(out, "x") == [0, 0, 1, 1.5, 1.5, 3]


@pytest.mark.parametrize("values, wanted", [([None, None, 3, None, 5], [3, 3, 3, 3, 5]), ([None, None], [0, 0])])
def test_fill(spark, values, wanted):
    df = series(spark, values)
    assert column(fill_gaps(df, lay_out(df), ["temp"]), "temp") == wanted


def test_centred_band(spark):
    df = series(spark, range(60))
    got = column(centred_band(df, lay_out(df)), "rolling_mean")
    assert [i for i, v in enumerate(got) if v is not None] == list(range(15, 46))


@pytest.mark.parametrize("n, sizes", [(3934, (2753, 590, 591)), (90, (62, 13, 15))])
def test_split_sizes(spark, n, sizes):
    df = series(spark, range(n))
    counts = {r["split"]: r["count"] for r in split_by_time(df, lay_out(df)).groupBy("split").count().collect()}
    assert (counts["train"], counts["val"], counts["test"]) == sizes


def test_purged_folds(spark):
    df = series(spark, range(3343))
    parts = assign_folds(df, lay_out(df), gap=7).groupBy("fold", "role").agg(F.min("idx").alias("a"), F.max("idx").alias("b"))
    got = {(r["fold"], r["role"]): (r["a"], r["b"] + 1) for r in parts.collect()}
    assert got == {
        (1, "train"): (0, 557), (1, "val"): (564, 1121), (2, "train"): (0, 1114), (2, "val"): (1121, 1678),
        (3, "train"): (0, 1671), (3, "val"): (1678, 2235), (4, "train"): (0, 2228), (4, "val"): (2235, 2792),
    }


@pytest.mark.parametrize(
    "values, wanted", [([0, 0, 0, 0, 9], [0, 0, 0, 0, 9]), ([1, 2, 3, 4, 6], [-1, -0.5, 0, 0.5, 1.5])]
)
@pytest.mark.parametrize("at_most", [None, 5])
def test_robust_scale(spark, values, wanted, at_most):
    df = series(spark, values)
    assert column(apply_robust_scaler(df, fit_robust_scaler(df, ["temp"], at_most)), "temp") == wanted


def test_r2(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 2.0), (1, 3.0, 4.0)], "horizon int, y double, pred double")
    assert evaluate(df).first()["r2"] == pytest.approx(0.5)


def test_summary_ties(spark):
    rows = [("s", START, 1, 5.0), ("s", START, 2, 5.0), ("s", START, 3, 4.0)]
    df = spark.createDataFrame(rows, "series_id string, datetime timestamp_ntz, horizon int, pred double")
    r = forecast_summary(df, "day").first()
    assert (r["warmest_horizon"], r["coolest_horizon"], r["spread"]) == (1, 3, 1.0)


def test_scalars(spark):
    months = spark.createDataFrame([(4,), (5,), (11,), (12,)], "m int").select(season(F.col("m")).alias("s"))
    assert [r["s"] for r in months.collect()] == ["Dry", "Rainy", "Rainy", "Dry"]
    temps = spark.createDataFrame([(t,) for t in (35.0, 34.9, 31.0, 28.0, 25.0, 22.0, 21.9)], "t double")
    assert [r["b"] for r in temps.select(temperature_band(F.col("t")).alias("b")).collect()] == [1, 2, 2, 3, 4, 5, 6]
    names = spark.createDataFrame([("target_t24",), ("target_t168",)], "n string")
    assert [r["h"] for r in names.select(horizon_of(F.col("n"), "hour").alias("h")).collect()] == [1, 7]
    gap = spark.createDataFrame([(0.7745655440523078, 0.8199720875652244), (0.0, 1.0)], "a double, b double")
    got = [r["g"] for r in gap.select(relative_gap(F.col("a"), F.col("b")).alias("g")).collect()]
    assert got[0] == pytest.approx(5.862195118486994) and got[1] is None


def test_parsing(spark):
    df = spark.createDataFrame([("2024-01-01 05:30:00",), ("n/a",)], "datetime string")
    assert [r[0] is None for r in parse_time_or_null(df, "datetime").collect()] == [False, True]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_time(df).collect()


def test_csv_source_and_nan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("series_id,datetime,temp\ns,2024-01-01 00:00:00,NaN\ns,2024-01-01 01:00:00,2.5\n")
    schema = "series_id string, datetime timestamp_ntz, temp double"
    df = read_observations(spark, str(tmp_path / "a.csv"), "csv", spark.createDataFrame([], schema).schema)
    assert column(df, "temp") == [None, 2.5]


def test_missing_column(spark):
    with pytest.raises(KeyError):
        require_columns(series(spark, [1]), "datetime", "target_t1")
