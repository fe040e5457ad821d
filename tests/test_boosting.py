"""Boosted trees: two plans and one result, early stopping, penalties, draws, against a plain version."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtide.operators import boosting
from leadtide.operators.boosting import Boost, boost, score_boosted

COLUMNS = ["a", "b", "c d", "e"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(500):
        a, b, c, e = rng.normal(), float(rng.integers(0, 9)), rng.exponential(), rng.normal()
        y = 3 * (a > 0.3) + b * 0.2 + (c if e > 0 else -c) + rng.normal() * 0.3
        rows.append((i % 2, i, i % 5 != 0, a, b, None if i % 31 == 0 else c, e, float(y), None if i % 11 == 0 else float(-y)))
    schema = "group int, id bigint, train boolean, a double, b double, `c d` double, e double, y double, z double"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def plain(rows, p, cuts):
    """A round at a time, with every split tried: leaves by depth, no draws."""
    def bins(r):
        return [sum(c < (-np.inf if v is None else v) for c in cs) for v, cs in zip(r, cuts)]

    xs = [bins([r[c] for c in COLUMNS]) for r in rows]
    ys, train = [r[p.label] for r in rows], [r["train"] for r in rows]
    fit = [i for i in range(len(rows)) if train[i] and ys[i] is not None]
    base = np.mean([ys[i] for i in fit])
    pred = [base] * len(rows)

    def score(g):
        s = np.sign(sum(g)) * max(abs(sum(g)) - p.reg_alpha, 0)
        return s * s / (len(g) + p.reg_lambda)

    def grow(members, grads, depth):
        best = (1e-9, None)
        if depth < p.max_depth:
            for f in range(len(COLUMNS)):
                for cut in sorted({xs[i][f] for i in members}):
                    left, right = [i for i in members if xs[i][f] <= cut], [i for i in members if xs[i][f] > cut]
                    if min(len(left), len(right)) < max(1, p.least_rows):
                        continue
                    gain = score([grads[i] for i in left]) + score([grads[i] for i in right]) - score([grads[i] for i in members])
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut))
        if best[1] is None:
            g = [grads[i] for i in members]
            weight = -p.learning_rate * np.sign(sum(g)) * max(abs(sum(g)) - p.reg_alpha, 0) / (len(g) + p.reg_lambda)
            return lambda x: weight
        f, cut = best[1]
        left = grow([i for i in members if xs[i][f] <= cut], grads, depth + 1)
        right = grow([i for i in members if xs[i][f] > cut], grads, depth + 1)
        return lambda x: left(x) if x[f] <= cut else right(x)

    for _ in range(p.rounds):
        grads = {i: pred[i] - ys[i] for i in fit}
        tree = grow(fit, grads, 0)
        pred = [v + tree(x) for v, x in zip(pred, xs)]
    return pred


@pytest.mark.parametrize("p", [
    Boost("y", 0, rounds=3, max_depth=3), Boost("z", 1, rounds=2, max_depth=4, reg_alpha=2.5, reg_lambda=7.0, least_rows=4),
])
def test_like_a_plain_version(spark, table, p):
    (model,) = boost(table, COLUMNS, [p])
    rows = [r.asDict() for r in table.where(F.col("group") == p.group).collect()]
    want = plain(rows, p, model.cuts)
    got = {r.id: r.pred for r in score_boosted(table.where(F.col("group") == p.group), {"pred": model}, COLUMNS).collect()}
    assert max(abs(got[r["id"]] - w) for r, w in zip(rows, want)) < 1e-5


MANY = [
    Boost("y", 0, rounds=12, learning_rate=0.9, max_depth=3, patience=2), Boost("z", 1, rounds=6, max_depth=5, subsample=0.7, colsample=0.5),
    Boost("y", 1, rounds=5, max_depth=8, num_leaves=6, least_rows=5, reg_lambda=0.0), Boost("z", 0, rounds=4, max_depth=2, reg_alpha=3.0, reg_lambda=50.0),
]


def same(a, b):
    assert (a.best, a.grown, a.loss, a.base) == (b.best, b.grown, b.loss, b.base)
    for name in ("sizes", "feature", "value"):
        assert np.array_equal(getattr(a, name), getattr(b, name)), name
    inner = a.feature >= 0
    assert np.array_equal(a.cut[inner], b.cut[inner]) and np.array_equal(a.left[inner], b.left[inner])


def test_spread_out_rows_give_the_same_models(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP_EVERY", 3)
    for a, b in zip(boost(table, COLUMNS, MANY), boost(table, COLUMNS, MANY, cells=0)):
        same(a, b)


def test_many_models_equal_single_fits_over_any_partitioning(spark, table):
    together = boost(table, COLUMNS, MANY)
    for k, p in enumerate(MANY):
        same(together[k], boost(table.repartition(2 + k), COLUMNS, [p])[0])


def test_stops_after_patience_and_goes_on_without_regrowing(spark, table, monkeypatch):
    p = Boost("y", 0, rounds=400, learning_rate=0.5, max_depth=4, patience=5)
    stopped, whole = boost(table, COLUMNS, [p, replace(p, rounds=400, patience=None)])
    assert stopped.grown == stopped.best + 5 < 400 and len(stopped.sizes) == stopped.best
    n = int(stopped.sizes.sum())
    assert np.array_equal(stopped.value, whole.value[:n]) and whole.grown == 400


def test_each_parameter_changes_the_model(spark, table):
    base = Boost("y", 0, rounds=4, max_depth=5)
    others = [replace(base, **c) for c in (
        {"reg_alpha": 5.0}, {"reg_lambda": 30.0}, {"colsample": 0.5}, {"subsample": 0.6}, {"num_leaves": 5}, {"least_rows": 30}, {"seed": 7, "subsample": 0.6},
    )]
    found = boost(table, COLUMNS, [base, *others])
    assert len({m.value.tobytes() for m in found}) == len(found)
    assert max(found[5].sizes) <= 2 * 5 - 1 and max(found[0].sizes) > 9


def test_best_first_takes_the_best_leaf(spark, table):
    """With as many leaves as growth by depth makes, both are the same tree."""
    deep = boost(table, COLUMNS, [Boost("y", 0, rounds=1, max_depth=3)])[0]
    leaves = int((deep.feature < 0).sum())
    first = boost(table, COLUMNS, [Boost("y", 0, rounds=1, max_depth=3, num_leaves=leaves), Boost("y", 0, rounds=1, max_depth=3, num_leaves=2)])
    assert sorted(first[0].value[first[0].feature < 0]) == sorted(deep.value[deep.feature < 0])
    two = first[1]
    taken = [f for f in two.feature if f >= 0]
    assert len(taken) == 1 and taken[0] == deep.feature[0]


def test_odd_tables(spark, table):
    assert boost(table, COLUMNS, []) == []
    none = boost(table.limit(0), COLUMNS, [Boost("y")])
    assert none == [None]
    flat = table.withColumn("y", F.lit(2.5))
    (model,) = boost(flat, COLUMNS, [Boost("y", rounds=3)])
    assert model.base == 2.5 and set(model.value) == {0.0}
    hidden = table.withColumn("y", F.lit(None).cast("double"))
    assert boost(hidden, COLUMNS, [Boost("y")]) == [None]


@pytest.mark.parametrize("slices", [1 << 12, 64])
def test_models_of_a_task_grow_side_by_side(monkeypatch, slices):
    """A round of all models is one pass, in groups below and above a slice; the splits are those of single trees."""
    monkeypatch.setattr(boosting, "_SLICE", slices)
    rng = np.random.default_rng(1)
    bins = rng.integers(0, [40, 1, 5, 64], size=(300, 4)).astype(np.uint8)
    y = bins[:, 0] / 10 + (bins[:, 3] > 30) * bins[:, 2] + rng.normal(size=300)
    y[::17] = np.nan
    train, ids, scale = np.arange(300) % 4 > 0, rng.integers(0, 1 << 60, 300), boosting.Scale(3.0, 12.0)
    models = [
        Boost("y", rounds=5 + k % 2, max_depth=k, num_leaves=[0, 4, 40][k % 3], least_rows=1 + 3 * (k % 2), subsample=1 - k / 20,
              colsample=[1.0, 0.5][k % 2], reg_alpha=k / 3) for k in range(8)
    ]
    passes, grow = [], boosting.Grove.grow
    monkeypatch.setattr(boosting.Grove, "grow", lambda self, *a: passes.append(len(self.models)) or grow(self, *a))
    found = boosting._grow_in_task(models, [scale] * 8, bins, ids, [y] * 8, train, True)
    assert passes == [8] * 5 + [4]
    keys, step = bins + (np.arange(4, dtype=np.int32) * boosting.MAX_BINS)[None, :], scale.reach / boosting.GRID
    fit = np.flatnonzero(train & ~np.isnan(y))
    for p, done in zip(models, found):
        pred = np.full(300, scale.base)
        for turn, got in enumerate(done.trees):
            tree = boosting.Tree(p, boosting.drawn_columns(p, turn, 4), 4, step)
            rows, at = fit[boosting.drawn_rows(p, turn, ids[fit])], np.zeros(300, np.int64)
            while len(tree.open):
                tree.learn(*boosting.histogram(tree, at[rows], keys[np.ix_(rows, tree.columns)], boosting.residuals(pred[rows], y[rows], step)))
                if not tree.expand():
                    break
                at = tree.moved(at, bins)
            want = tree.finish()
            pred += want.value[want.kept[at]]
            inner = want.feature >= 0
            assert np.array_equal(got.feature, want.feature) and np.array_equal(got.value, want.value)
            assert np.array_equal(got.left, want.left) and np.array_equal(got.cut[inner], want.cut[inner])
        assert done.turn == p.rounds and done.best == boosting._loss((pred - y)[~train & ~np.isnan(y)], scale) / (~train & ~np.isnan(y)).sum()
