"""The audit against running all 120 orders row by row."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from leadtide.llm import audit
from leadtide.llm.queries import ORACLES
from tests.llm.frames import ROWS, crowded, none, odd

LABELS = [(1, 1, 0), (1, 1, 1), (2, None, 1), (7, 1, None), (9, 0, 1), (None, 1, 1), (5, None, None), (77, 1, 1)]


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def fails(rows):
    """The letters each row fails."""
    ids = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            ids[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        text = r[1] or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        said = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        said += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        out.append(said + "E" * (r[0] is not None and any(i < r[0] for i in ids[text])))
    return out


def brute(rows, said):
    failed = fails(rows)
    good = {i for i, q, _ in said if q == 1 and i is not None}
    toxic = {i for i, _, t in said if t == 1 and i is not None}
    out, sums = [], Counter()
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed) if (r[3] or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                sums[part, letter] += len(gone)
                out.append([
                    part, "".join(order), step, len(left), len(gone), sum(letter in f for _, f in mine) - len(gone),
                    sum(f == letter for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ])
    return sorted((*r, sums[r[0], r[1][r[2] - 1]]) for r in out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("how", [{}, {"salt_rows": 1, "most_broadcast": 0}])
def test_odd_rows_like_brute_force(spark, how):
    assert rows_of(audit.audit(crowded(spark), labels(spark), **how)) == brute(ROWS, LABELS)


@pytest.mark.parametrize("salt_rows", [1, 7, 256])
def test_a_large_group_of_copies(spark, salt_rows):
    shared = "one two THREE four $ " * 30
    rows = [(i, shared if i % 3 == 0 else f"own {i} " * (i % 60), "en", f"s{i % 2}", 0) for i in range(400)]
    rows += [(3, shared, "en", "s0", 0), (None, shared, "en", "s0", 0), (401, shared + " ", "en", "s1", 0)]
    frame = spark.createDataFrame(rows, odd(spark).schema).repartition(7)
    assert rows_of(audit.audit(frame, labels(spark), salt_rows=salt_rows)) == brute(rows, LABELS)


def test_equal_hashes_are_not_equal_texts(spark, monkeypatch):
    """With a hash that says nothing the exact text still decides."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(audit, "_names", lambda text: [F.lit(1).cast("bigint").alias("h1"), F.length(text).cast("bigint").alias("h2")])
    rows = [(1, "ab", "en", "s", 2), (2, "cd", "en", "s", 2), (3, "ab", "en", "s", 2), (4, "", "en", "s", 0), (5, None, "en", "s", 0)]
    frame = spark.createDataFrame(rows, odd(spark).schema)
    failed = audit.failures(frame)
    assert sorted(r.doc_id for r in audit.repeated(frame, failed).collect()) == [3, 5]


def test_empty_tables(spark):
    assert audit.audit(none(spark), labels(spark)).count() == 0
    assert rows_of(audit.audit(odd(spark), labels(spark).limit(0))) == brute(ROWS, [])


def test_registered_with_sql():
    assert "op11_filter_audit" in ORACLES
