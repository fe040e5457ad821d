"""Exact dedup by Grace hash deduplication.

Documents are equal if their texts are, once white space is deleted. Every task first folds the
copies it meets (bounded memory), so that a group of copies of any size leaves few rows. What is
left is dealt into buckets by a hash of the content; a shuffle file is the spill file of a bucket.
One task holds a bucket in an open-addressing table (Python's dict: a hash finds the slot, the
complete content decides). Contents that find the table full go on, all copies of a content alike,
to the next level, where another hash deals them again, until nothing is left. Levels are tables in
the shared folder, so a lost executor costs one task.

Null text counts as empty. Of equal texts the row with most code points stays, then the smallest
doc_id (null last); of rows that agree in both, exactly one. An empty table gives no rows. Columns
other than id and text pass through ``drop_copies`` and are ignored by ``copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtide.llm.common import WHITE, blobs, unused, written

#: Bytes of content that one task's table holds.
TABLE_BYTES = 64 << 20
_PARTIAL = pa.schema([("content", pa.binary()), ("n", pa.int64()), ("points", pa.int64()), ("id", pa.int64())])
_CLASS = pa.schema([*_PARTIAL, ("digest", pa.binary()), ("settled", pa.bool_())])
_PARTIAL_SQL = "content binary, n bigint, points bigint, id bigint"


def _better(points: int, i: int | None, entry: list) -> bool:
    if points != entry[1]:
        return points > entry[1]
    return i is not None and (entry[2] is None or i < entry[2])


def _add(table: dict, content: bytes, n: int, points: int, i: int | None) -> None:
    entry = table[content]
    entry[0] += n
    if _better(points, i, entry):
        entry[1], entry[2] = points, i


def _out(rows: Iterator[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows, content first, as batches of about ``most`` bytes."""
    part, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        part.append(row)
        held += len(row[0] or b"") + 64
        if held >= most:
            yield batch()
            part, held = [], 0
    if part:
        yield batch()


def _fold(limit: int):
    """Map side: each content once for every ``limit`` bytes of them, with its count and best row."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, list] = {}
        held = 0
        for batch in batches:
            text = batch.column(1)
            points = pc.fill_null(pc.utf8_length(text), 0).to_pylist()
            for i, blob, n in zip(batch.column(0).to_pylist(), blobs(text), points, strict=True):
                content = blob.translate(None, WHITE)
                if content in table:
                    _add(table, content, 1, n, i)
                    continue
                if held >= limit:
                    yield from _out(((c, *e) for c, e in table.items()), _PARTIAL)
                    table, held = {}, 0
                table[content] = [1, n, i]
                held += len(content) + 100
        yield from _out(((c, *e) for c, e in table.items()), _PARTIAL)

    return fold


def _settle(limit: int):
    """One bucket: contents that fit the table are settled, the others go on as they came."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, list] = {}
        held = 0
        for batch in batches:
            passed = []
            for content, n, points, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if content in table:
                    _add(table, content, n, points, i)
                elif held < limit:
                    table[content] = [n, points, i]
                    held += len(content) + 100
                else:
                    passed.append((content, n, points, i, None, False))
            yield from _out(iter(passed), _CLASS)
        yield from _out(((None, *e, hashlib.sha256(c).digest(), True) for c, e in table.items()), _CLASS)

    return settle


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """digest, id, points, n: each distinct content with the row that stays and the rows it has."""
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    left = narrow.mapInArrow(_fold(table_bytes // 2), _PARTIAL_SQL)
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found, level = None, 0
    while True:
        buckets = max(1, -(-2 * size // table_bytes))
        dealt = left.repartition(buckets, F.xxhash64(F.lit(level), "content"))
        out = written(dealt.mapInArrow(_settle(table_bytes), f"{_PARTIAL_SQL}, digest binary, settled boolean"), "grace")
        settled = out.filter("settled").select("digest", "id", "points", "n")
        found = settled if found is None else found.unionByName(settled)
        left = out.filter("not settled").select("content", "n", "points", "id")
        size = left.agg(F.sum(F.octet_length("content") + 100)).first()[0]
        if not size:
            return found
        level += 1


def _digests(at: int, schema: pa.Schema | None = None):
    """Appends digest and code points of column ``at`` to each row; without ``schema`` only id, digest, points."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            sha = [hashlib.sha256(b.translate(None, WHITE)).digest() for b in blobs(text)]
            points = pc.fill_null(pc.utf8_length(text), 0).cast(pa.int64())
            kept = batch.columns[:at] if schema is None else batch.columns
            names = batch.schema.names[: len(kept)]
            own = ["digest", "points"] if schema is None else schema
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sha, pa.binary()), points], names=[*names, *own])

    return digests


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the content).

    The join back moves ids and digests only. Rows that agree in id and content are counted before
    it and told apart after it, so that one of them stays.
    """
    known = classes(docs, doc_id, text, table_bytes)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = narrow.mapInArrow(_digests(1), "doc_id bigint, digest binary, points bigint")
    rows = rows.groupBy("doc_id", "digest", "points").agg(F.count("*").alias("times"))
    best = F.col("doc_id").eqNullSafe(F.col("id")) & (rows["points"] == known["points"])
    joined = rows.join(known, "digest").select("doc_id", "id", "n", "digest", "times", best.alias("best"))
    return joined.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("time")).select(
        "doc_id",
        F.col("id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("best") & (F.col("time") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns.

    The join is on content and id together: copies have ids of their own, so no group meets in one task.
    """
    known = classes(docs, doc_id, text, table_bytes)
    digest, points = unused(docs, "digest", "points")
    last = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(digest, T.BinaryType()), T.StructField(points, T.LongType())])
    rows = docs.mapInArrow(_digests(last, [digest, points]), schema)
    stay = known.select(F.col("digest").alias("k_digest"), F.col("id").alias("k_id"), F.col("points").alias("k_points"))
    on = (rows[digest] == stay["k_digest"]) & rows[doc_id].cast("bigint").eqNullSafe(stay["k_id"]) & (rows[points] == stay["k_points"])
    return rows.join(stay, on, "left_semi").dropDuplicates([digest, doc_id]).select(*[F.col(f"`{c}`") for c in docs.columns])
