"""Cut series give the same results as whole ones, whatever the shape of the data."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leadtide.config import HOURLY
from leadtide.operators.blocks import lay_out, over_series, row_index
from leadtide.operators.features import build_features, targets_and_features
from leadtide.operators.splits import assign_folds, split_by_time
from leadtide.operators.windows import centred_band, fill_gaps, lead_targets, trailing_mean

START = dt.datetime(2020, 1, 1)


def rows_of(kind: str, seed: int = 7):
    """One series with most of the rows beside short ones; times are even, bursty or sparse."""
    rng = random.Random(seed)
    rows = []
    for name, n in (("hot", 3000), ("mid", 400), ("a", 30), ("b", 1)):
        t = START
        for _ in range(n):
            if kind == "even":
                t += dt.timedelta(hours=1)
            elif kind == "bursty":
                t += dt.timedelta(microseconds=rng.randint(1, 50)) if rng.random() < 0.95 else dt.timedelta(days=rng.randint(1, 400))
            else:
                t += dt.timedelta(minutes=rng.randint(1, 10_000))
            value = None if rng.random() < 0.1 else round(rng.gauss(20, 5), 2)
            gap = None if rng.random() < 0.98 else float(rng.randint(0, 9))
            rows.append((name, t, value, gap, float(rng.randint(0, 100))))
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=["even", "bursty", "sparse"], scope="module")
def frames(request, spark):
    schema = "series_id string, datetime timestamp_ntz, temp double, windspeed double, humidity double"
    df = spark.createDataFrame(rows_of(request.param), schema).repartition(5).persist()
    plain, cut = lay_out(df), lay_out(df, block_rows=128)
    assert not plain.blocked and cut.blocked
    return df, plain, cut


def same(a, b):
    # sums may be added in another order
    def rows(df):
        cols = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
        return sorted(map(repr, df.select(*cols).collect()))

    assert rows(a) == rows(b)


def test_row_index(frames):
    df, plain, cut = frames
    same(row_index(df, plain, "i", "n"), row_index(df, cut, "i", "n"))


def test_leads(frames):
    df, plain, cut = frames
    same(lead_targets(df, plain, [1, 7, 48]), lead_targets(df, cut, [1, 7, 48]))


def test_trailing(frames):
    df, plain, cut = frames

    def add(d, w):
        return d.withColumn("m", trailing_mean("temp", 24, w)).withColumn("l", F.lag("temp", 24).over(w))

    same(over_series(df, plain, add, back=24), over_series(df, cut, add, back=24))


def test_centred(frames):
    df, plain, cut = frames
    same(centred_band(df, plain), centred_band(df, cut))


def test_fill(frames):
    df, plain, cut = frames
    same(fill_gaps(df, plain, ["temp", "windspeed"]), fill_gaps(df, cut, ["temp", "windspeed"]))


def test_split_then_features_in_scope(frames):
    df, plain, cut = frames
    got = []
    for layout in (plain, cut):
        s = split_by_time(df, layout)
        got.append(build_features(s, layout, HOURLY, scope=["split"]))
    same(*got)


def test_folds_then_features_in_scope(frames):
    df, plain, cut = frames
    got = [build_features(assign_folds(df, x, 7), x, HOURLY, scope=["fold", "role"]) for x in (plain, cut)]
    same(*got)


def test_targets_split_and_features_in_one_go(frames):
    df, plain, cut = frames
    once = [targets_and_features(df, x, HOURLY, (1, 7, 30), ["temp"]) for x in (plain, cut)]
    same(*once)
    stepwise = split_by_time(lead_targets(df, plain, (1, 7, 30)), plain).withColumn(
        "part", F.when(F.col("split") == "test", "test").otherwise("fit")
    )
    same(once[1], build_features(stepwise, plain, HOURLY, ["part"], ["split", "temp", "target_t1", "target_t7", "target_t30"]))


def test_no_task_holds_a_long_series(frames):
    df, _, cut = frames
    from leadtide.operators.blocks import BLOCK, enter

    largest = enter(df, cut, back=24, ahead=7).groupBy("series_id", BLOCK).count().agg(F.max("count")).first()[0]
    assert largest <= 128 * 2


def test_time_that_does_not_order_is_refused(spark):
    df = spark.createDataFrame([("s", START, float(i)) for i in range(500)], "series_id string, datetime timestamp_ntz, temp double")
    with pytest.raises(ValueError, match="order"):
        lay_out(df, block_rows=100)


def test_row_order_does_not_matter(spark):
    schema = "series_id string, datetime timestamp_ntz, temp double, windspeed double, humidity double"
    rows = rows_of("even")
    a, b = (spark.createDataFrame(r, schema) for r in (rows, sorted(rows, key=lambda r: repr(r))))
    same(lead_targets(a, lay_out(a), [3]), lead_targets(b, lay_out(b), [3]))


def test_folds_keep_their_gap(frames):
    df, plain, _ = frames
    parts = assign_folds(df, plain, 7).groupBy("series_id", "fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("idx"))).alias("a"),
        F.min(F.when(F.col("role") == "val", F.col("idx"))).alias("b"),
    )
    assert parts.where(F.col("b") - F.col("a") <= 7).isEmpty() and not parts.isEmpty()


TIED = "series_id string, datetime timestamp_ntz, sensor int, temp double, humidity double"


def tied_rows():
    rng = random.Random(11)
    rows = []
    for name, n in (("hot", 900), ("a", 20)):
        for i in range(n):
            t = START + dt.timedelta(hours=i // 3)
            rows.append((name, None if i == 0 and name == "a" else t, i % 3, None if rng.random() < 0.3 else rng.gauss(0, 1), float(i % 7)))
    return rows


@pytest.mark.parametrize("parts", [1, 2, 3, 5, 8])
def test_tied_times_are_ordered_alike_cut_and_uncut(spark, parts):
    rows = [r for r in tied_rows() if r[1] is not None]
    df = spark.createDataFrame(rows, TIED).repartition(parts)
    plain, cut = lay_out(df, ties=["sensor"]), lay_out(df, block_rows=64, ties=["sensor"])
    assert cut.blocked and not plain.blocked
    for job in (
        lambda x: row_index(df, x, "i", "n"), lambda x: lead_targets(df, x, [1, 4]),
        lambda x: over_series(df, x, lambda d, w: d.withColumn("m", trailing_mean("humidity", 5, w)), back=5), lambda x: fill_gaps(df, x, ["temp"]),
    ):
        same(job(plain), job(cut))
    want = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    got = row_index(df, cut, "i").orderBy("series_id", "i").collect()
    assert [tuple(r)[:3] for r in got] == [r[:3] for r in want]


@pytest.mark.parametrize("block_rows", [64, 4_000_000])
def test_tied_times_without_an_order_are_refused_at_every_size(spark, block_rows):
    df = spark.createDataFrame(tied_rows(), TIED)
    with pytest.raises(ValueError, match="does not order"):
        lay_out(df, block_rows=block_rows)
    with pytest.raises(ValueError, match="does not order"):
        lay_out(df.unionByName(df.limit(1)), block_rows=block_rows, ties=["sensor"])
    with pytest.raises(ValueError, match="does not order"):
        lay_out(df, block_rows=block_rows, at_most=10_000)


def test_a_cut_window_cannot_be_widened(frames):
    df, _, cut = frames
    for change in (lambda w: w.rangeBetween(-10, 0), lambda w: w.orderBy("temp"), lambda w: w.partitionBy("series_id")):
        with pytest.raises(ValueError, match="frames of rows"):
            over_series(df, cut, lambda d, w, c=change: d.withColumn("x", F.max("temp").over(c(w))), back=3)
