"""Operators against plain Python versions, and texts that are far longer than a part."""

from __future__ import annotations

import random
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadtide.llm import arrays, language, order, secret_scan, tokens, toxicity
from leadtide.llm.common import documents
from tests.llm.frames import SF, odd


def words_of(text):
    return ["".join(g) for letter, g in groupby((text or "").lower(), str.isalpha) if letter]


# Language ID
def grams_of(text):
    out = Counter()
    for w in words_of(text):
        out.update(w)
        padded = f"\1{w}\1"
        for k in (2, 3):
            out.update(padded[i : i + k] for i in range(len(padded) - k + 1))
    return out


def packed(gram):
    """The order of ties: by the letters from the last to the first, a blank before every letter."""
    return tuple(ord(c) for c in reversed(gram.ljust(3, "\0")))


def top_of(counts, top):
    return sorted(counts, key=lambda g: (-counts[g], packed(g)))[:top]


def plain_languages(rows, top):
    learned = {}
    for i, text, lang in rows:
        if i is not None and text is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            learned.setdefault(lang, Counter()).update(grams_of(text))
    places = {name: {g: k for k, g in enumerate(top_of(c, top))} for name, c in learned.items() if c}
    out = []
    for i, text, _ in rows:
        own = top_of(grams_of(text), top)
        far = {n: sum(abs(p[g] - k) if g in p else top for k, g in enumerate(own)) for n, p in places.items()}
        best = min(sorted(far), key=far.get) if far and own else "und"
        out.append((i, best, 0.0 if best == "und" else 1 - far[best] / (top * len(own))))
    return out


@pytest.mark.parametrize("top", [30, language.TOP])
def test_language_like_out_of_place_distance_in_plain_python(spark, top):
    docs = documents(spark, SF)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, top=top).collect())
    for g, w in zip(got, sorted(plain_languages(rows, top)), strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-12)


def test_languages_that_tie_go_by_name(spark):
    rows = [(i, "same words here", lang, "s", 0) for i, lang in enumerate(["b", "a", "c", "a", "b", "c"] * 4)]
    got = language.identify(spark.createDataFrame(rows, odd(spark).schema)).collect()
    assert {r.lang_pred for r in got} == {"a"}


@pytest.mark.parametrize("most", [7, 50, 1000])
def test_parts_of_a_text_count_like_the_whole(most):
    rng = random.Random(most)
    text = "".join(rng.choice(["abcdefghij", "é", "ß", " ", ". ", "日本", "x" * 30, "\n", "7"]) for _ in range(300))
    assert "".join(p for p, _ in arrays.pieces(text, most)) == text
    grams, counts = language.counted(text, most)
    want, n = np.unique(language.ngrams(pa.array([text]))[0], return_counts=True)
    assert np.array_equal(grams, want) and np.array_equal(counts, n)
    words = "".join(rng.choice(["alpha", "bet", "gam-ma", "é", " ", ".\n"]) + " " for _ in range(300))
    assert np.array_equal(toxicity.long_features(words, max(most, 20)), np.unique(toxicity.features(pa.array([words]))[1]))


def test_a_very_long_text_is_held_in_parts():
    text = "the quick ónion of eared thing is red and thin to the edge " * 500_000
    tracemalloc.start()
    grams, counts = language.counted(text)
    hashes = toxicity.long_features(text, toxicity.LONG)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6 and len(text) > 29_000_000
    short, n = np.unique(language.ngrams(pa.array([text[:59]]))[0], return_counts=True)
    assert np.array_equal(grams, short) and np.array_equal(counts, n * 500_000)
    assert np.array_equal(hashes, np.unique(toxicity.features(pa.array([text[:59]]))[1]))


def test_more_languages_than_can_be_sent_are_refused(spark):
    rows = [(i, f"text {i}", f"l{i}", "s", 0) for i in range(1600)]
    with pytest.raises(ValueError, match="languages"):
        language.identify(spark.createDataFrame(rows, odd(spark).schema))


# Toxicity
def plain_features(text):
    out = set()
    for w in words_of(text):
        out.add((0, w))
        out |= {(k, w[:n]) for k, n in enumerate(toxicity.STARTS, 1) if len(w) >= n}
    return out


def test_features_are_words_and_their_beginnings():
    texts = ["Grüße an alle", "grüße AN, grün!", "", None, "a ab abc abcd abcdefgh", "日本語 x"]
    rows, hashes = toxicity.features(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        mine = set(hashes[rows == i].tolist())
        assert len(mine) == len(plain_features(text))
        for j in range(i):
            both = len(mine & set(hashes[rows == j].tolist()))
            assert both == len(plain_features(text) & plain_features(texts[j]))


def test_a_link_is_at_its_optimum_and_the_chain_adds_up(spark):
    """Probabilities from weights row by row; the gradient of each link's loss is zero where it ended."""
    docs = documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = toxicity.train(docs, labels)
    weights = [dict(zip(chain.vocabulary.tolist(), link.weights)) for link in chain.links]
    rows = docs.limit(150).collect()
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    for r in rows:
        mine = set(toxicity.features(pa.array([r.text or ""]))[1].tolist())
        earlier = []
        for link, w in zip(chain.links, weights):
            z = link.intercept + sum(w.get(h, 0.0) for h in mine) + sum(a * p for a, p in zip(link.earlier, earlier))
            earlier.append(1 / (1 + np.exp(-z)))
        assert [got[r.doc_id][f"p_{c}"] for c in chain.categories] == pytest.approx(earlier, abs=1e-9)
        assert got[r.doc_id].rejected == (got[r.doc_id][f"p_{chain.categories[-1]}"] >= 0.5)

    rng = np.random.default_rng(2)
    x = rng.random((400, 12)) < 0.3
    y = (x[:, 0] | (rng.random(400) < 0.2)).astype(float)
    at, columns = np.nonzero(x)
    dense = np.column_stack([np.ones(400), rng.random(400)])
    w = toxicity.logistic(at, columns, 12, dense, y)
    p = 1 / (1 + np.exp(-(np.hstack([dense, x]) @ w)))
    ridge = np.array([1e-6, *[0.02] * 13])
    assert np.abs(np.hstack([dense, x]).T @ (p - y) + ridge * w).max() < 0.02


# Training order
def plain_feistel(i, key, size):
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low, word = (1 << half) - 1, (1 << 64) - 1
    while True:
        left, right = i >> half, i & low
        for turn in range(order.ROUNDS):
            f = (right + key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & word
            f = (f * 0xBF58476D1CE4E5B9) & word
            f = ((f ^ (f >> 29)) * 0x94D049BB133111EB) & word
            left, right = right, left ^ ((f ^ (f >> 32)) & low)
        i = left << half | right
        if i < size:
            return i


def test_slots_are_the_order_of_a_plain_feistel_network(spark, tmp_path):
    docs = documents(spark, SF).repartition(3, "doc_id").sortWithinPartitions("doc_id")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    folder = f"file://{tmp_path}/out"
    made = order.materialise(docs, folder, shard_bytes=1 << 17).collect()
    encode = tokens.encoder()
    size = order.PARTITIONS * order.PER_PARTITION
    want, parts = [], {}
    for r in docs.select("doc_id", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).collect():
        parts.setdefault(r.part, []).append((r["at"], r.text or ""))
    for part, rows in parts.items():
        flat = np.concatenate([np.append(encode(t), 50256) for _, t in sorted(rows)]).astype("<u2")
        flat = np.append(flat, np.full(-len(flat) % 1024, 50256, "<u2")).reshape(-1, 1024)
        want += [(plain_feistel(part * order.PER_PARTITION + i, 1, size), zlib.crc32(x.tobytes())) for i, x in enumerate(flat)]
    want = [c for _, c in sorted(want)]
    assert [r.crc32 for r in sorted(made, key=lambda r: r.slot)] == want
    read = np.concatenate(list(order.read_slots(spark, folder, 5, len(want) - 9)))
    assert [zlib.crc32(x.tobytes()) for x in read] == want[5:-4]
    manifest = sorted(spark.read.parquet(f"{folder}/{order.MANIFEST}").collect())
    assert sum(r.records for r in manifest) == len(want) and [r["first"] for r in manifest] == list(np.cumsum([0, *[r.records for r in manifest]])[:-1])
    assert not [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith(".")]


def test_a_folder_without_scheme_is_named_by_the_default_file_system(spark, tmp_path):
    store, name = order._named(spark, str(tmp_path / "x"))
    assert name == f"file://{tmp_path}/x"
    with pytest.raises(Exception, match="share"):
        rows = spark.createDataFrame([(0, b"ab")], "shard int, tokens binary")
        rows.mapInArrow(order._write(f"file://{tmp_path}/unseen", ".mark"), "shard int, record bigint").collect()


# Tokens
def test_both_libraries_give_the_same_ids():
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.encoder()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(points[i : i + 500]) + "".join(points[i : i + 500]) for i in range(0, 0x30000, 500)]
    rng = random.Random(8)
    bits = [" ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "a", "Word", "é", "ß", "日", "🙂", "́", "7", "²", "_", "-", "<|endoftext|>", " ", "\x00", "١", "‍"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(20_000)]
    for text in texts:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, text


# Secret scan
def test_small_classes_are_written_out():
    query = secret_scan.trigram_query
    rules = {r.kind: query(r.pattern) for r in secret_scan.BASE + secret_scan.MORE}
    assert {k for k, q in rules.items() if q is None} == {"hex"}
    assert rules["github"] == sorted((frozenset({f"gh{c}", f"h{c}_"}) for c in "pousr"), key=sorted)
    assert query("a[bc]d") == [frozenset({"abd"}), frozenset({"acd"})] and query("a[^b]cd") is None
    assert query("(xy){3}") == [frozenset({"xyx", "yxy"})] and query("[a-z]bc") is None and query("ab[0-9a]+") is None


def test_every_match_has_its_trigrams():
    """Random expressions: a text that matches always holds all trigrams of some clause."""
    rng = random.Random(3)

    def make(depth):
        kind = rng.randrange(7 if depth else 3)
        if kind < 2:
            return rng.choice("abc")
        if kind == 2:
            return rng.choice(["[ab]", "[a-c]", "[^a]", "."])
        if kind == 3:
            return f"({make(depth - 1)}|{make(depth - 1)})"
        if kind == 4:
            return f"({make(depth - 1)}){rng.choice(['?', '*', '+', '{2}', '{2,}', '{0,2}', '{5}'])}"
        return make(depth - 1) + make(depth - 1)

    for _ in range(400):
        pattern = "".join(make(2) for _ in range(rng.randint(1, 5)))
        query = secret_scan.trigram_query(pattern)
        if query is None:
            continue
        for _ in range(30):
            m = re.search(pattern, "".join(rng.choice("abcd") for _ in range(30)))
            assert m is None or any(all(t in m[0] for t in clause) for clause in query), (pattern, m[0])
