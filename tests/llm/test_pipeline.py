from __future__ import annotations

import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from leadtide.llm import mixing
from leadtide.llm.common import documents, written
from tests.llm.frames import SF, crowded, near_classes, none
from tests.llm.test_exact import brute


def test_stages_keep_what_brute_force_keeps(spark):
    docs = documents(spark, SF)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "stage")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    before, after = seen["exact dedup"]
    assert after.count() == brute([tuple(r) for r in before.collect()])[1]
    before, after = seen["near dedup"]
    classes = near_classes([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))
    before, after = seen["mixing"]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = seen["toxicity"]
    kept = {r.doc_id for r in after.collect()}
    clean = [i for i, t in labels.items() if not t and i in {r.doc_id for r in before.collect()}]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    before, after = seen["packing"]
    total = defaultdict(int)
    for r in after.collect():
        total[r.doc_id] += r.length
    assert set(total) == {r.doc_id for r in before.collect()}


def test_sequences_follow_the_mix_over_several_files(spark):
    rng = random.Random(4)
    rows = [(i, "alpha beta " * 250, "short") for i in range(100)]
    rows += [(100 + i, " ".join(f"{rng.getrandbits(32):x}" for _ in range(305)), "long") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        mixed = written(corpus_pipeline.mix_sources(spark, docs, SF), "stage")
        assert len(mixed.inputFiles()) > 2
        got = corpus_pipeline.pack(spark, mixed, SF).toPandas()
    finally:
        spark.conf.set(setting, before)
    slot = {r.doc_id: r.slot for r in mixing.mix(docs).collect()}
    first = got.groupby("doc_id").sequence_id.min()
    assert len(first) == 500
    # A pool of 16 windows may change places inside, no more: the mean slot of each run of documents rises.
    slots = np.array([slot[i] for i in first.sort_values(kind="stable").index])
    runs = [part.mean() for part in np.array_split(slots, 10)]
    assert runs == sorted(runs)
    # While both sources last they alternate, and none of the short one comes after.
    names = np.array(["short" if i < 100 else "long" for i in first.sort_values(kind="stable").index])
    assert (names[300:] == "long").all() and 60 <= (names[:150] == "short").sum() <= 90


def test_stages_stand_odd_rows(spark):
    for docs in (crowded(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, written(stage(spark, docs, SF), "stage")
            assert name == "packing" or docs.columns == before.columns
