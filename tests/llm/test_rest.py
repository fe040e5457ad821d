from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtide.llm import language, lines, mixing, order, quality, secret_scan, toxicity
from leadtide.llm.common import documents
from tests.llm.frames import ROWS, SF, crowded, none, odd


# Line dedup
def test_lines_on_many_sites_go(spark):
    rows = [(i, f"own {i}\n  shared line\nthird {i % 2}", f"s{i % 12}") for i in range(60)] + [(99, None, None), (None, "shared line", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.drop_boilerplate(frame).collect()}
    assert got[3] == ("own 3\nthird 1", 3, 1) and got[99] == (None, 0, 0) and got[None] == ("", 1, 1)


@pytest.mark.parametrize("registers", [4, 12])
def test_near_threshold_is_exact(spark, registers):
    rows = [(k, f"line {n}", f"s{k}") for n in range(30, 50) for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = lines.occurrences(frame, "text", "source", F.xxhash64("doc_id", "text"))
    names = {tuple(r) for r in lines.boilerplate(found, 40, registers).collect()}
    want = {tuple(r) for r in spark.createDataFrame([(f"line {n}",) for n in range(40, 50)], "t string").select(lines._name(F.col("t")).alias("n")).select("n.*").collect()}
    assert names == want or registers == 4 and want <= names | want


def test_lines_of_odd_rows(spark):
    assert lines.drop_boilerplate(crowded(spark)).count() == len(ROWS)
    assert lines.drop_boilerplate(none(spark)).count() == 0


# Mixing
def test_every_block_runs_in_its_window(spark):
    rows = [(i, "x" * 90, "abcdefg"[min(6, i % 11)], 0) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, slot int")
    shares = {"a": 5, "b": 3, "g": 2}
    mixed = mixing.mix(frame, shares=shares, block=500, bucket=3000)
    got = mixed.toPandas()
    assert len(got) == 1500 and got.doc_id.is_unique and list(mixed.columns[-5:]) == ["block", "_slot", "release", "deadline", "place"]
    assert ((got.release <= got._slot) & (got._slot < got.deadline)).all()
    slots = got.groupby("_slot")[["source", "block"]].nunique()
    assert (slots == 1).all().all()
    total = sum(shares.get(s, 1) for s in "abcdefg")
    ends = got.groupby("source").block.max()
    until = min(int(ends[s] // shares.get(s, 1)) for s in "abcdefg") * total
    runs = got.drop_duplicates("_slot").set_index("_slot").source
    for s in "abcdefg":
        done = np.cumsum([runs.get(t) == s for t in range(until)])
        assert np.abs(done - np.arange(1, until + 1) * shares.get(s, 1) / total).max() < 1
    whole = got.sort_values(["source", "place"])
    assert (whole.groupby("source").place.diff().dropna() == 90).all()


def earliest_deadline_first(blocks: dict[str, int], shares: dict[str, int]) -> dict:
    """(source, block) -> (slot, release, deadline), slot by slot."""
    done, out, period, base = dict.fromkeys(blocks, 0), {}, 0, 0
    life = {s: -(-n // shares.get(s, 1)) for s, n in blocks.items()}
    while active := sorted(s for s in blocks if life[s] > period):
        slots = sum(shares.get(s, 1) for s in active)
        run = dict.fromkeys(active, 0)
        for t in range(slots):
            offers = [(-(-(run[s] + 1) * slots // n), s, run[s] * slots // n) for s in active if run[s] < (n := shares.get(s, 1)) and run[s] * slots // n <= t]
            deadline, s, release = min(offers)
            if (b := period * shares.get(s, 1) + run[s]) < blocks[s]:
                out[s, b] = base + t, base + release, base + deadline
            run[s] += 1
        base, period = base + slots, period + 1
    return out


@pytest.mark.parametrize("shares", [{"s004": 4}, {"s002": 3, "s030": 5, "s017": 2, "s059": 7}, {f"s{i:03}": 2 + i % 3 for i in range(60)}])
def test_schedule_slot_by_slot(spark, shares):
    blocks = {f"s{i:03}": 1 + i * i % 23 for i in range(60)}
    sizes = spark.createDataFrame([(s, shares.get(s, 1), n) for s, n in blocks.items()], "s_key string, share bigint, blocks bigint")
    got = {(r.key, r.block): (r.slot, r.release, r.deadline) for r in mixing.schedule(sizes).collect()}
    assert got == earliest_deadline_first(blocks, shares)


def test_thousands_of_sources_are_mixed(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x" * 90).alias("text"), F.concat(F.lit("src"), F.col("id") % 1500).alias("source"))
    got = mixing.mix(frame, block=50).toPandas()
    assert len(got) == 3000 and ((got.release <= got.slot) & (got.slot < got.deadline)).all()
    assert (got.groupby("slot")[["source", "block"]].nunique() == 1).all().all()


def test_mixing_odd_rows(spark):
    docs = crowded(spark)
    assert mixing.mix(docs, bucket=10).count() == len(ROWS)
    ordered = mixing.in_order(docs)
    assert ordered.columns == docs.columns and ordered.count() == len(ROWS)
    assert mixing.mix(none(spark)).count() == 0
    with pytest.raises(ValueError, match="schedule"):
        mixing.mix(docs, shares={"src0": 10**6})


# Toxicity
def test_sample_bounds_rows_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(i if i < 20 else 3, f"text {i}") for i in range(500)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    got = toxicity._sampled(docs, labels, "doc_id", "text", toxicity.CATEGORIES, 10, 5)
    assert got.count() <= 10
    all_ids = toxicity._sampled(docs, labels, "doc_id", "text", toxicity.CATEGORIES, 100, 5)
    assert all_ids.count() == all_ids.select("text").distinct().count() == 20


def test_chain_learns_stems_and_leaves_the_rest(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abdegilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows, labels = [], []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        bad, low = i % 5 == 0, i % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = "vokk" + rng.choice(plain)
        if low:
            words[0] = "zzjunk"
        rows.append((i, " ".join(words)))
        if i < 900:
            labels.append((i, int(not low), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([*labels, (None, 1, 1), (1, None, 1), (2, 1, 7)], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(docs, known)
    assert [len(link.earlier) for link in chain.links] == [0, 1]
    got = {r.doc_id: r.rejected for r in toxicity.score(docs, chain).collect()}
    held = range(900, 1200)
    assert sum(got[i] == (i % 5 == 0) for i in held) / len(held) > 0.98
    assert toxicity.drop_toxic(docs, chain).count() == sum(not r for r in got.values())
    odd_ones = toxicity.score(crowded(spark), chain).collect()
    assert len(odd_ones) == len(ROWS) and toxicity.drop_toxic(crowded(spark), chain).columns == crowded(spark).columns
    assert toxicity.score(none(spark), chain).count() == 0


def test_without_labels_nothing_is_rejected(spark):
    known = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(odd(spark), known)
    assert toxicity.drop_toxic(odd(spark), chain).count() == len(ROWS)


# Secrets
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in sorted(found))


def test_spans_like_brute_force(spark):
    rng = random.Random(4)
    bits = ["token", "=", ": ", "'", '"', "secret", "API_KEY", "apikey", "PassWord", "abc", "abcdef0123456789abcdef01", " ", "AKIA", "ABCDEFGH01234567", "é", "🙂", "\n", "="]
    texts = [None, "", "token=token=abcdefgh", "api_key=token:abcdefgh", 'secret" : "a.b/c+d=', "AKIA" * 7, "f" * 100_000]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = secret_scan.digests(secret_scan.scan(frame, rules=secret_scan.BASE), secret_scan.BASE).collect()
    assert {r.doc_id: r.spans for r in got} == {i: brute_spans(t) for i, t in enumerate(texts)}
    assert all(r.n_assign + r.n_access + r.n_hex == len([s for s in r.spans.split(",") if s]) for r in got)


def test_trigram_queries():
    query = secret_scan.trigram_query
    assert query("[0-9a-f]{24,}") is None and query("a|bcd") is None and query("x?abc") == [frozenset({"abc"})]
    assert query("AKIA[A-Z]") == [frozenset({"aki", "kia"})]
    assert {frozenset({"abc"}), frozenset({"bcd", "xbc"})} == set(query("abc|xbcd"))
    assert query("(ab)*cde") == [frozenset({"cde"})] and len(query(secret_scan.BASE[0].pattern)) == 6


def test_secrets_of_odd_rows(spark):
    assert secret_scan.digests(secret_scan.scan(crowded(spark))).count() == len(ROWS)
    assert secret_scan.scan(none(spark)).count() == 0


# Training order
def test_feistel_permutes():
    for size in (1, 2, 3, 100, 1000, 4097):
        for key in (1, 2):
            assert sorted(order.feistel(np.arange(size), key, size).tolist()) == list(range(size))
    assert order.feistel(np.arange(50), 1, 10**12).tolist() != order.feistel(np.arange(50), 2, 10**12).tolist()


def test_shards_hold_every_token_once(spark, tmp_path):
    from leadtide.llm.tokens import encoder

    docs = documents(spark, SF)
    folder = f"file://{tmp_path}/out"
    made = order.materialise(docs, folder, shard_bytes=1 << 17).toPandas()
    assert sorted(made.slot) == list(range(len(made))) and made.shard.nunique() > 1
    encode = encoder()
    tokens = sum(len(encode(r.text or "")) + 1 for r in docs.collect())
    assert made.n_tokens.sum() == tokens and len(made) == -(-tokens // 1024)
    import zlib

    for r in made.itertuples():
        assert zlib.crc32(order.read_records(folder, r.shard, r.record, 1).tobytes()) == r.crc32
    assert {i for ids in made.doc_ids for i in ids} == {r.doc_id for r in docs.collect()}
    again = order.materialise(docs, str(tmp_path / "two"), shard_bytes=1 << 17).toPandas()
    assert made.sort_values("slot").crc32.tolist() == again.sort_values("slot").crc32.tolist()


def test_order_of_odd_rows(spark, tmp_path):
    assert order.materialise(crowded(spark), str(tmp_path / "a")).count() > 0
    assert order.materialise(none(spark), str(tmp_path / "b")).count() == 0


# Quality
def test_a_small_host_needs_more_evidence(spark):
    rows = [(f"h{h}", i % 20 < 1 + h % 4 or h == 29) for h in range(30) for i in range(200)] + [("tiny", True)]
    frame = spark.createDataFrame(rows, "host string, bad boolean")
    got = {r.host: r.shrunk for r in quality.host_rates(frame, {"r": "bad"}).collect()}
    assert got["h29"] > 0.9 and got["h0"] < 0.1 and got["tiny"] < got["h29"] - 0.1


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if h or i % 10 == 0 else "x", f"h{h}") for h in range(5) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = quality.verdicts(frame)
    assert got.filter("kept and host = 'h0'").count() == 0 and got.filter("not kept and host <> 'h0'").count() == 0


def test_quality_of_odd_rows(spark):
    assert quality.verdicts(crowded(spark)).count() == len(ROWS) and quality.verdicts(none(spark)).count() == 0


# Language
def test_language_of_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    got = language.identify(crowded(spark)).collect()
    assert len(got) == len(ROWS) and all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 5))
    assert language.identify(none(spark)).count() == 0
    assert {r.lang_pred for r in language.identify(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
