from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from leadtide.llm import packing, tokens
from leadtide.llm.common import documents
from tests.llm.frames import ROWS, SF, crowded, none, odd


def test_ids_are_those_of_the_tokenizer_file():
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.encoder()
    for text in ["", " ", "\n\n  x", "it's 12 ²³ naïve 日本 🙂\r\n\t", "a<|endoftext|>b", "word " * 50_000, " " * 300_000]:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_differencing_balances_and_windows_hold_the_capacity():
    rng = random.Random(3)
    for _ in range(40):
        sizes = [rng.randint(1, 1000) for _ in range(rng.randint(1, 60))]
        k = rng.randint(1, 9)
        groups = packing.differencing(sizes, k)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        for cut in (True, False):
            made = packing.windows(sizes, 1024, cut)
            assert all(sum(n for *_, n in w) <= 1024 for w in made)
            cover = defaultdict(list)
            for w in made:
                for i, at, n in w:
                    cover[i].append((at, n))
            assert all(sum(n for _, n in cover[i]) == s for i, s in enumerate(sizes))
            assert not cut or len(made) == -(-sum(sizes) // 1024)
            assert cut or all(len(c) == 1 for c in cover.values())
    sizes = [4, 5, 6, 7, 8]
    assert max(sum(sizes[i] for i in g) for g in packing.differencing(sizes, 2)) <= 17


def check(pieces, rows):
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_window = defaultdict(list)
    for p in pieces:
        by_window[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length > 0
    for parts in by_window.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    got = sorted((p.doc_id is None, p.doc_id or 0, p.doc_tokens, p.start, p.ids) for p in pieces)
    want = sorted((i is None, i or 0, slow.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, *_ in rows)
    assert sum(len(g[4]) // 4 for g in got) == sum(len(w[2]) for w in want)
    return got, want, len(by_window)


def test_round_trip_and_little_padding(spark):
    docs = documents(spark, SF)
    pieces = packing.pack_documents(docs).collect()
    got, want, windows = check(pieces, [(r.doc_id, r.text) for r in docs.collect()])
    whole = defaultdict(list)
    for _, doc, _, _, ids in got:
        whole[doc].extend(np.frombuffer(ids, "<u4").tolist())
    assert dict(whole) == {doc: ids for _, doc, ids in want}
    assert windows * 1024 - sum(len(w[2]) for w in want) < 1024 * docs.rdd.getNumPartitions()


def test_odd_rows(spark):
    check(packing.pack_documents(crowded(spark)).collect(), ROWS)
    whole = packing.pack_documents(odd(spark), cut=False, window=1 << 20).collect()
    assert all(p.length == p.doc_tokens for p in whole) and len(whole) == len(ROWS)
    assert packing.pack_documents(none(spark)).count() == 0
    assert packing.piece_digests(packing.pack_documents(odd(spark))).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
