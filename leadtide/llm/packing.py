"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenized and cut into full windows; what remains of each is shorter than a window.
Remainders gather until they fill ``block`` windows exactly (the last one is cut there). The block
is then balanced: each remainder is a partial partition of ``k`` sums, and the two partitions with
the largest imbalance merge, largest sums against smallest, until one is left, whose sums are nearly
equal. A window over capacity gives its excess to the windows below capacity. If that is not enough
room, or if documents may not be cut, the window count rises by one and the block is balanced anew.

A block holds a few dozen pieces, so packing streams beside tokenizing: no shuffle, no hot key,
memory of one batch. A task repeats its packing exactly when its input rows come in the same order,
as they do from files. Null text counts as empty (one end token), an empty table gives no pieces;
null or repeated ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtide.llm.tokens import encoder

WINDOW = 1024
BLOCK = 16
_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
_PIECE_SQL = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Positions of ``sizes`` in ``k`` groups of nearly equal sums."""
    heap = [(-s, i, [(s, [i]), *[(0, [])] * (k - 1)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        merged = sorted(((x + y, g + h) for (x, g), (y, h) in zip(a, reversed(b), strict=True)), key=lambda e: -e[0])
        low = merged[-1][0]
        heapq.heappush(heap, (low - merged[0][0], turn, [(s - low, g) for s, g in merged]))
        turn += 1
    return [g for _, g in heap[0][2]] if heap else [[] for _ in range(k)]


def windows(sizes: list[int], capacity: int, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (position in ``sizes``, start in it, length), none over ``capacity``."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        out = [[(i, 0, sizes[i]) for i in group] for group in differencing(sizes, k)]
        sums = [sum(n for *_, n in w) for w in out]
        if max(sums, default=0) <= capacity:
            return out
        if cut and sum(sums) <= k * capacity:
            break
        k += 1
    excess = []
    for w, total in zip(out, sums, strict=True):
        while total > capacity:
            i, at, n = w.pop()
            over = min(n, total - capacity)
            excess.append((i, at + n - over, over))
            if n > over:
                w.append((i, at, n - over))
            total -= over
    for w in out:
        room = capacity - sum(n for *_, n in w)
        while room and excess:
            i, at, n = excess.pop()
            w.append((i, at, min(n, room)))
            if n > room:
                excess.append((i, at + room, n - room))
            room -= min(n, room)
    return out


def _packer(capacity: int, block: int, vocabulary: str, end: int, cut: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        first = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        pool: list[tuple] = []  # (doc_id, start of the remainder, its ids, tokens of the document)
        pooled = made = held = 0

        def close() -> None:
            nonlocal made, pooled, held
            for window in windows([len(ids) for _, _, ids, _ in pool], capacity, cut):
                offset = 0
                for i, at, n in window:
                    doc, start, ids, total = pool[i]
                    rows.append((doc, start + at, n, ids[at : at + n].tobytes(), total, first + made, offset))
                    offset += n
                made += bool(window)
            held += 4 * pooled
            pool.clear()
            pooled = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE.types, strict=True)]
            rows.clear()
            held = 0
            return pa.record_batch(columns, schema=_PIECE)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.asarray([end], "<u4")).astype("<u4", copy=False)
                total = len(ids)
                rest = total - total % capacity
                for start in range(0, rest, capacity):
                    rows.append((doc, start, capacity, ids[start : start + capacity].tobytes(), total, first + made, 0))
                    made += 1
                held += 4 * rest
                while rest < total:
                    n = min(total - rest, block * capacity - pooled) if cut else total - rest
                    pool.append((doc, rest, ids[rest : rest + n], total))
                    pooled += n
                    rest += n
                    if pooled >= block * capacity:
                        close()
                if held >= 4 << 20:
                    yield flush()
        if pool:
            close()
        if rows:
            yield flush()

    return pack


def pack_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK,
    vocabulary: str = "byte_bpe_50k", end_token: int = 0, cut: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``sequence_id`` is the number of the input partition in the upper bits and a count below.
    """
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_packer(window, block, vocabulary, end_token, cut), _PIECE_SQL)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
