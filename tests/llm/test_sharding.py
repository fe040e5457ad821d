from __future__ import annotations

import zlib
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from leadtide.llm import sharding
from tests.llm.frames import ROWS, crowded, none, odd


@pytest.mark.parametrize("bits,dims", [(1, 3), (2, 3), (4, 3), (3, 2), (2, 4)])
def test_the_curve_visits_all_cells_by_single_steps(bits, dims):
    path = sorted(product(range(1 << bits), repeat=dims), key=lambda c: sharding.hilbert(c, bits))
    assert sorted(sharding.hilbert(c, bits) for c in path) == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(path, path[1:]))


def brute(rows, n_shards, bits=4):
    """(doc_id, size, crc, shard, slot): bins by rank, cells by the curve, runs of the order."""
    own = [(r[2], r[3], len((r[1] or "").encode()) + 1, r[0], zlib.crc32((r[1] or "").encode())) for r in rows]

    def low(v):
        return (v is not None, v if v is not None else 0)

    bins = []
    for d in range(3):
        values = sorted((r[d] for r in own), key=lambda v: (v is not None, v if v is not None else ""))
        bins.append({v: values.index(v) * (1 << bits) // len(own) for v in values})
    own.sort(key=lambda r: (sharding.hilbert(tuple(bins[d][r[d]] for d in range(3)), bits), *[low(v) for v in r]))
    out, slots = [], Counter()
    for k, r in enumerate(own):
        shard = k * n_shards // len(own)
        out.append((r[3], r[2], r[4], shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr)


@pytest.mark.parametrize("n_shards", [1, 3, 8, 40])
def test_odd_rows_like_brute_force(spark, n_shards):
    assert got(sharding.shards(crowded(spark), n_shards=n_shards)) == brute(ROWS, n_shards)


def test_a_hot_source_and_repeated_rows(spark):
    rows = [(i % 90, "same text" if i % 3 else f"text {i} " * (i % 41), "en", "src0" if i % 3 else f"s{i % 29}", 0) for i in range(1003)]
    frame = spark.createDataFrame(rows, odd(spark).schema).repartition(6)
    found = sharding.shards(frame)
    assert got(found) == brute(rows, 8)
    sizes = Counter(r[3] for r in got(found))
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1


def test_empty_table(spark, tmp_path):
    assert sharding.shards(none(spark)).count() == 0
    sharding.write_shards(none(spark), str(tmp_path / "out"))


def test_files_prune_by_every_column(spark, tmp_path):
    """Shards hold all columns, and their ranges leave out most shards for any of the three."""
    rows = [(i, "x" * (i * 7 % 1000), f"l{i % 16:02}", f"s{i * 31 // 16 % 16:02}", i) for i in range(4096)]
    frame = spark.createDataFrame(rows, odd(spark).schema).selectExpr("*", "1 AS shard", "2 AS c_text")
    folder = str(tmp_path / "shards")
    sharding.write_shards(frame, folder, n_shards=64)
    back = spark.read.parquet(folder)
    assert sorted(tuple(r) for r in back.select(frame.columns).collect()) == sorted(tuple(r) for r in frame.collect())
    kept = back.selectExpr("_shard", "lang", "source", "length(text) AS n")
    both = [f(c).alias(f"{c}_{f.__name__}") for c in ("lang", "source", "n") for f in (F.min, F.max)]
    ranges = kept.groupBy("_shard").agg(*both).collect()
    for column, value in (("lang", "l07"), ("source", "s11"), ("n", 500)):
        hit = sum(r[f"{column}_min"] <= value <= r[f"{column}_max"] for r in ranges)
        assert 1 <= hit <= 24, (column, hit)
