from __future__ import annotations

import re
from collections import defaultdict

import pytest

from leadtide.llm import exact
from tests.llm.frames import ROWS, crowded, none, odd


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", r[1] or "")].append(r)
    best = {c: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0])) for c, g in groups.items()}
    return sorted(((r[0], best[c][0], len(g)) for c, g in groups.items() for r in g), key=repr), len(groups)


@pytest.mark.parametrize("table_bytes", [exact.TABLE_BYTES, 30_000])
def test_copies_like_brute_force(spark, table_bytes):
    got = exact.copies(odd(spark), table_bytes=table_bytes).collect()
    want, groups = brute(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_dropping_keeps_one_row_of_each_text_and_all_columns(spark):
    docs = crowded(spark)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == brute(ROWS)[1]
    assert {r.doc_id for r in kept.filter("text like '%alpha%'").collect()} == {2}


def test_empty_table(spark):
    assert exact.copies(none(spark)).count() == exact.drop_copies(none(spark)).count() == 0
