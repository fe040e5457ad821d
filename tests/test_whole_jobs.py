"""Registered queries hand the whole job to their operators; the fits themselves are replaced."""

from __future__ import annotations

import inspect

import pytest

from leadtide.catalog import learning
from leadtide.config import DAILY_HORIZONS, HOURLY
from leadtide.operators.boosting import boost_per_horizon
from leadtide.operators.models import random_forest
from leadtide.operators.tuning import search_trees
from leadtide.plans.chain import bake_off, forecast_metrics

SF = "/root/testdata/sf0.001"


class Called(Exception):
    pass


def arguments(monkeypatch, spark, query: str, operator: str, like) -> dict:
    """What ``query`` gives to ``operator``, with the defaults of ``like``."""
    def stop(*args, **kwargs):
        bound = inspect.signature(like).bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called(bound.arguments)

    monkeypatch.setattr(learning, operator, stop)
    with pytest.raises(Called) as said:
        learning.QUERIES[query](spark, SF)
    return said.value.args[0]


def test_searches_draw_all_trials(spark, monkeypatch):
    got = arguments(monkeypatch, spark, "m15_linear_search", "search_linear", learning.search_linear)
    assert got["n_trials"] == 300 and tuple(got["horizons"]) == DAILY_HORIZONS
    got = arguments(monkeypatch, spark, "m15_tree_search", "search_trees", search_trees)
    assert (got["n_trials"], got["max_rounds"], got["patience"]) == (50, 2000, 100)
    assert tuple(got["horizons"]) == DAILY_HORIZONS


def test_trees_grow_all_rounds(spark, monkeypatch):
    got = arguments(monkeypatch, spark, "m14_bake_off", "bake_off", bake_off)
    assert (got["boost_rounds"], got["patience"], got["forest_trees"]) == (1000, 100, 100)
    got = arguments(monkeypatch, spark, "m8_random_forest", "random_forest", random_forest)
    assert (got["trees"], got["max_depth"], got["leaf"]) == (100, 10, 5)
    got = arguments(monkeypatch, spark, "m9_boosted_trees", "boost_per_horizon", boost_per_horizon)
    assert got["params"] == {1: {"rounds": 1000, "learning_rate": 0.05}} and tuple(got["columns"]) == HOURLY.columns
    got = arguments(monkeypatch, spark, "m10_early_stopping", "boost_per_horizon", boost_per_horizon)
    assert got["params"][1]["rounds"] == 1000 and got["params"][1]["patience"] == 100
    got = arguments(monkeypatch, spark, "m11_trees_per_horizon", "forecast_metrics", forecast_metrics)
    assert tuple(got["params"]) == DAILY_HORIZONS and all(p["rounds"] == 100 for p in got["params"].values())
    got = arguments(monkeypatch, spark, "m11_next_day_chain", "forecast_metrics", forecast_metrics)
    assert tuple(got["params"]) == tuple(range(1, 25)) and got["params"][24]["num_leaves"] == 31


def test_hourly_jobs_have_their_gap_and_horizons(spark, monkeypatch):
    for query, operator, like in (
        ("m15_linear_search_hourly", "search_linear", learning.search_linear), ("m15_tree_search_hourly", "search_trees", search_trees),
        ("m15_leaf_search_hourly", "search_trees", search_trees),
    ):
        got = arguments(monkeypatch, spark, query, operator, like)
        assert got["gap"] == 168 and tuple(got["horizons"]) == tuple(range(24, 169, 24)) and got["spec"] is HOURLY
    assert got["patience"] is None and got["ranges"]["num_leaves"] == (20, 150, "int") and got["n_trials"] == 50


def test_trees_read_all_features(spark, monkeypatch):
    got = arguments(monkeypatch, spark, "m7_decision_tree", "assemble", learning.assemble)
    assert tuple(got["columns"]) == HOURLY.columns


def test_models_of_all_horizons_are_saved(spark, monkeypatch):
    got = arguments(monkeypatch, spark, "a7_saved_models", "fit_linear_per_horizon", learning.fit_linear_per_horizon)
    assert tuple(got["params"]) == DAILY_HORIZONS
