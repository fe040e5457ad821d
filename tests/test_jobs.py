"""Whole jobs: stored and loaded again, leaks inside a search, failures side by side."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from leadtide.config import DAILY
from leadtide.operators import tuning
from leadtide.operators.blocks import lay_out
from leadtide.operators.models import LinearParams, side_by_side
from leadtide.operators.tuning import search_linear, search_trees
from leadtide.plans.chain import forecast_metrics, linear_parameters, prepare, prepared_features, score, train
from leadtide.plans.jobs import load_job, save_job, score_stored
from leadtide.session import stored
from tests.test_models import daily_series

TREES = {"rounds": 8, "max_depth": 3, "subsample": 0.7, "reg_alpha": 0.5}


@pytest.fixture(scope="module")
def series(spark):
    df = daily_series(spark)
    return df, lay_out(df)


def test_a_stored_job_scores_like_the_fitted_one(spark, series, tmp_path):
    df, layout = series
    ready, columns = prepared_features(df, layout, DAILY, (1, 3))
    ready = stored(ready, "features")
    trained = train(ready, columns, {1: LinearParams("Ridge", 2.0), 3: TREES}, layout.rows)
    path = str(tmp_path / "job")
    save_job(spark, trained, path)
    again = load_job(spark.newSession(), path)
    assert again.columns == trained.columns and again.scaler == trained.scaler
    assert again.models[3].boost == trained.models[3].boost and again.models[3].best == 8
    want = sorted(map(tuple, score(ready, trained).select("datetime", "pred_target_t1", "pred_target_t3").collect()))
    got = sorted(map(tuple, score_stored(spark, ready, path).select("datetime", "pred_target_t1", "pred_target_t3").collect()))
    assert got == want and all(p is not None for r in got for p in r)
    spark.createDataFrame([(99, "line", 1)], "version int, kind string, horizon int").write.mode("overwrite").parquet(f"{path}/notes")
    with pytest.raises(ValueError, match="version"):
        load_job(spark, path)


def test_a_horizon_without_labels_is_stored_and_scores_null(spark, series, tmp_path):
    df, layout = series
    ready = stored(prepared_features(df, layout, DAILY, (1, 3))[0].withColumn("target_t3", F.lit(None).cast("double")), "features")
    trained = train(ready, ["humidity"], {1: TREES, 3: TREES}, layout.rows)
    assert trained.models[3] is None
    save_job(spark, trained, str(tmp_path / "job"))
    out = score_stored(spark, ready, str(tmp_path / "job"))
    assert out.where("pred_target_t3 is not null").isEmpty() and out.where("pred_target_t1 is null").isEmpty()


def test_searched_parameters_and_defaults(spark):
    table = spark.createDataFrame([("m", 1, "kind", "Lasso"), ("m", 1, "alpha", "0.25")], "model string, horizon int, name string, value string")
    assert linear_parameters(table, (1, 2)) == {1: LinearParams("Lasso", 0.25, 0.5), 2: LinearParams()}


def test_trees_in_the_whole_chain(spark, series):
    df, layout = series
    metrics = forecast_metrics(df, layout, DAILY, {1: TREES, 2: {**TREES, "num_leaves": 4}})[1].collect()
    assert {(r["metric_type"], r["horizon"]) for r in metrics} == {(t, h) for t in ("Train", "Test") for h in (1, 2)}
    assert all(r["rmse"] > 0 for r in metrics)


def test_tree_search_scores_are_those_of_single_fits(spark, series):
    from leadtide.operators.boosting import boost

    df, layout = series
    ready = stored(prepare(df, layout, (1, 3)), "split")
    ranges = {**tuning_ranges(), "max_depth": (2, 3, "int")}
    found = {(r["horizon"], r["trial"]): r for r in search_trees(ready, DAILY, (1, 3), 7, 2, ranges, max_rounds=6, patience=2).collect()}
    assert len(found) == 4 and {r["n_folds"] for r in found.values()} == {4}
    folded, columns = tuning.fold_features(ready, DAILY, ["target_t1", "target_t3"], 7)
    data = folded.select(F.col("fold").cast("int").alias("group"), F.xxhash64("series_id", "datetime").alias("id"), (F.col("role") == "train").alias("train"), *columns, "target_t1", "target_t3")
    for (h, t), r in found.items():
        singles = [boost(data, columns, [tuning._tree_model(r.asDict(), f, 6, 2)], trees=False)[0] for f in (1, 2, 3, 4)]
        assert r["val_rmse"] == pytest.approx(sum(m.rmse for m in singles) / 4, rel=1e-9)


def tuning_ranges():
    from leadtide.config import TREE_RANGES

    return TREE_RANGES


def test_a_leak_inside_a_search_raises(spark, series, monkeypatch):
    df, layout = series
    ready = stored(prepare(df, layout, (1,)), "split")
    honest = tuning.assign_folds

    def leaky(*args, **kwargs):
        parts = honest(*args, **kwargs)
        return parts.unionByName(parts.where("role = 'val'").limit(1).withColumn("role", F.lit("train")))

    monkeypatch.setattr(tuning, "assign_folds", leaky)
    with pytest.raises(AssertionError, match="leaks"):
        search_linear(ready, DAILY, (1,), gap=7, n_trials=2)
    with pytest.raises(AssertionError, match="leaks"):
        search_trees(ready, DAILY, (1,), 7, 2, tuning_ranges(), max_rounds=2)


def test_a_failure_side_by_side_cancels_the_rest(spark):
    def fails():
        raise RuntimeError("no")

    def long():
        def wait(batches):
            time.sleep(25)
            yield from batches

        return spark.range(4).mapInArrow(wait, "id bigint").count()

    begun = time.time()
    with pytest.raises(RuntimeError, match="no"):
        side_by_side(spark, [long, fails, long, long, long], threads=2)
    assert time.time() - begun < 20 and spark.range(5).count() == 5
