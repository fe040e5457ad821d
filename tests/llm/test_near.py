from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from leadtide.llm import near
from leadtide.llm.common import documents
from tests.llm.frames import SF, crowded, near_classes, none, odd


def test_classes_like_brute_force(spark):
    docs = documents(spark, SF)
    want = near_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = near.classes(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    assert sum(r.kept for r in got) == len(set(want.values()))


def test_chains_of_links_form_one_class(spark):
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 10**9)}" for _ in range(200)]
    rows = []
    for i in range(30):  # each differs from the one before in two words
        rows.append((i, " ".join(words)))
        words[rng.randrange(200)] = f"n{i}"
        words[rng.randrange(200)] = f"m{i}"
    rows += [(100 + i, " ".join(f"u{i}-{k}" for k in range(60))) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(frame).collect()} == near_classes(rows)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_a_large_bucket_in_blocks(spark, monkeypatch, block):
    """Without pivots every link comes from the comparison inside buckets."""
    monkeypatch.setattr(near, "ROUNDS", 0)
    rng = random.Random(6)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.choice([1, 2, 9])):
            words[rng.randrange(120)] = f"n{i}-{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(frame, block=block).collect()} == near_classes(rows)


def test_a_pair_just_at_the_threshold(spark):
    rows = []
    for i in range(6):  # 80,000 shingles in common of 100,000: a collision of two would lose the pair
        words = [f"w{i}-{k}" for k in range(90_000)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[10_000:] + [f"y{i}-{k}" for k in range(10_004 - 8)]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(frame).collect()} == near_classes(rows)


def test_a_part_repeated_in_one_copy_hides_no_pair(spark):
    rows = []
    for i in range(12):  # sets at 100 of 124, whatever the line is repeated
        words = [f"w{i}-{k}" for k in range(104)]
        line = [f"r{i}-{k}" for k in range(20)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + line * 200))]
    want = near_classes(rows)
    assert len(set(want.values())) == 12
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.classes(frame).collect()} == want


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 2**63, 900).astype(np.uint64))
    a, b = hashes[:700], hashes[200:]
    m = 2000
    bounds = np.array([0, len(a), len(a) + len(b), len(a) + len(b) + 1])
    sign = near.signatures(np.concatenate([a, b, a[:1]]), np.ones(len(a) + len(b) + 1), bounds, m)
    assert abs((sign[0] == sign[1]).mean() - 500 / 900) < 5 * (0.25 / m) ** 0.5
    assert (sign[2] == a[0]).all()


def test_weights_count():
    a = np.array([1, 2], np.uint64)
    sign = near.signatures(a, np.array([9.0, 1.0]), np.array([0, 2]), 4000)
    assert abs((sign[0] == 1).mean() - 0.9) < 0.03


def test_short_and_empty_texts():
    hashes, counts, bounds = near.shingle_sets(pa.array(["", None, "a b", "a  b", "b a", "a b c d e", "a b c d e a b c d e"]))
    sets = [hashes[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    assert sets[0] == sets[1] == [] and sets[2] == sets[3] != sets[4] and len(sets[5]) == 1 and len(sets[6]) == 5
    assert counts[bounds[6] :].sum() == 6


def test_odd_rows(spark):
    docs = crowded(spark)
    got = near.classes(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault((r.class_id, r.class_size), []).append(r.kept)
    # Id 9 stands for two texts, each a class of its own.
    assert all(sum(kept) == 1 and len(kept) == size for (i, size), kept in by.items() if i != 9) and by[9, 1] == [True, True]
    kept = near.drop_near(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert near.classes(none(spark)).count() == near.drop_near(none(spark)).count() == 0
    assert near.classes(odd(spark).filter("doc_id = 6")).count() == 1


@pytest.mark.parametrize("most", [1, 5, 40, 10_000])
def test_a_long_text_in_parts_has_the_same_set(monkeypatch, most):
    rng = random.Random(most)
    text = "".join(rng.choice(["ab", "é", "longer-word", " ", "\t", "\n ", "日本", " x "]) for _ in range(400))
    want = near.shingle_sets(pa.array([text]))
    assert "".join(p[0].as_py() for p in near._parts(pa.array([text]), most)) == text
    whole = near._parts
    monkeypatch.setattr(near, "_parts", lambda texts: whole(texts, most))
    for got, w in zip(near.shingle_sets(pa.array([text])), want):
        assert np.array_equal(got, w)


def test_a_very_long_text_needs_little_memory():
    text = " ".join(f"w{i % 50_000}" for i in range(3_000_000))
    tracemalloc.start()
    hashes, counts, bounds = near.shingle_sets(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 20_000_000 and len(hashes) == 50_000 and counts.sum() == 3_000_000 - 4 and peak < 250e6
