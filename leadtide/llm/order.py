"""Training-order materialisation by a keyed Feistel permutation.

Documents become sequences of ``stride`` tokens: each input partition lays its documents, each with
an end token, end to end and cuts; the last sequence is filled with end tokens. Sequence i of
partition p has the index p * PER_PARTITION + i. A Feistel network with a key permutes the smallest
power of four above all possible indices; an index that lands outside walks the cycle until it is
inside, so the result permutes the indices themselves. The permuted index is the place in training
order, and it is known without counting first: tokens are computed once and shuffled once.

Range partitions of the order are shards. A task writes its shard as records of fixed stride under a
name of its own and then moves it into place, so a repeated task leaves the same file. The global
slot of a sequence is the number of records in earlier shards plus its record number; its bytes are
at record times stride, which is all that a reader needs to read on after a stop. The folder is named
in full by Spark's file system on the driver, and a task that does not see the driver's mark there
refuses to write: shards never end on a disk that others cannot see. When all shards are in place,
what failed tasks left is removed and the manifest follows: shard, first slot, records, checksum. A
folder without a manifest is not a whole run.

Null text counts as empty; null and repeated ids are kept; texts of any length are cut into sequences
as their tokens come; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadtide.llm.common import written
from leadtide.llm.tokens import encoder
from leadtide.session import scratch_table

STRIDE = 1024
#: The index: more partitions than Spark gives a scan, and sequences than a partition can hold.
PARTITIONS = 1 << 22
PER_PARTITION = 1 << 38
#: Bytes of text that make up a shard.
SHARD_BYTES = 16 << 20
ROUNDS = 6
MANIFEST = "manifest"
MANIFEST_SCHEMA = "shard int, first bigint, records bigint, checksum bigint"


def feistel(index: np.ndarray, key: int, size: int) -> np.ndarray:
    """A permutation of range(size), given by ``key``, at each ``index``."""
    half = np.uint64(max(1, (int(size - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for turn in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
            f = (right + salt) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & low)
        return (left << half) | right

    out = once(np.asarray(index, np.uint64))
    while len(out_of := np.flatnonzero(out >= np.uint64(size))):
        out[out_of] = once(out[out_of])
    return out.astype(np.int64)


def _cut(stride: int, vocabulary: str, end: int, key: int, shards: int, partitions: int, per_partition: int):
    size = partitions * per_partition

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        if part >= partitions:
            raise ValueError(f"more than {partitions} input partitions")
        made = 0

        def rows(tokens: np.ndarray, owner: np.ndarray, docs: list) -> Iterator[pa.RecordBatch]:
            """Whole sequences; ``owner`` is the place in ``docs`` of each token's document, -1 for filling."""
            nonlocal made
            for at in range(0, len(tokens), 2048 * stride):
                some = tokens[at : at + 2048 * stride].reshape(-1, stride)
                whose = owner[at : at + 2048 * stride].reshape(-1, stride)
                if made + len(some) > per_partition:
                    raise ValueError(f"more than {per_partition} sequences in a partition")
                place = feistel(np.arange(made, made + len(some)) + part * per_partition, key, size)
                made += len(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place), pa.array((place // -(-size // shards)).astype(np.int32)),
                        pa.array([x.tobytes() for x in some], pa.binary()),
                        pa.array([[docs[i] for i in np.unique(w[w >= 0])] for w in whose], pa.list_(pa.int64())),
                        pa.array((whose >= 0).sum(axis=1).astype(np.int32)),
                    ],
                    names=["place", "shard", "tokens", "doc_ids", "n_tokens"],
                )

        ids, docs, held = [], [], 0
        rest, rest_owner = np.empty(0, "<u2"), np.empty(0, np.int64)

        def gathered() -> tuple[np.ndarray, np.ndarray]:
            own = np.repeat(np.arange(len(docs) - len(ids), len(docs)), [len(x) for x in ids])
            return np.concatenate([rest, *ids]).astype("<u2"), np.concatenate([rest_owner, own])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(np.append(encode(text or ""), np.asarray([end], "<u4")))
                docs.append(doc)
                held += len(ids[-1])
                if held >= 256 * stride:
                    tokens, owner = gathered()
                    whole = len(tokens) - len(tokens) % stride
                    yield from rows(tokens[:whole], owner[:whole], docs)
                    rest, (left, rest_owner) = tokens[whole:], np.unique(owner[whole:], return_inverse=True)
                    ids, docs, held = [], [docs[i] for i in left], 0
        tokens, owner = gathered()
        if len(tokens):
            fill = -len(tokens) % stride
            yield from rows(np.append(tokens, np.full(fill, end, "<u2")), np.append(owner, np.full(fill, -1)), docs)

    return cut


def _store(folder: str):
    """pyarrow's file system of a folder that is named in full, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _named(spark: SparkSession, folder: str):
    """Hadoop's file system of ``folder`` and its full name, by the default scheme where it has none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, re.sub("^file:/+", "file:///", store.makeQualified(path).toString())


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _write(folder: str, mark: str):
    """Writes each shard of a sorted partition and gives back its records without their tokens."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        if store.get_file_info(f"{path}/{mark}").type.name == "NotFound":
            raise RuntimeError(f"{folder} is not a folder that the driver and all executors share")
        shard, out, record = None, None, 0
        context = TaskContext.get()
        draft = f"{path}/.draft-{context.partitionId()}-{context.taskAttemptId()}"

        def close() -> None:
            if out is not None:
                out.close()
                store.move(draft, f"{path}/shard-{shard:07d}.bin")

        for batch in batches:
            records, sums = [], []
            for s, tokens in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if s != shard:
                    close()
                    shard, out, record = s, store.open_output_stream(draft), 0
                out.write(tokens)
                records.append(record)
                sums.append(zlib.crc32(tokens))
                record += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array(records, pa.int64()), batch.column("doc_ids"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["shard", "record", "doc_ids", "n_tokens", "crc32"],
            )
        close()

    return write


def materialise(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", key: int = 1, stride: int = STRIDE,
    vocabulary: str = "byte_bpe_50k", end_token: int = 50256, shard_bytes: int = SHARD_BYTES,
    partitions: int = PARTITIONS, per_partition: int = PER_PARTITION,
) -> DataFrame:
    """Write the shards below ``folder``; a row per sequence: slot, shard, record, doc_ids, n_tokens, crc32.

    Tokens are unsigned little-endian 16-bit, so a record has 2 * stride bytes; the vocabulary has
    fewer than 65,536 entries. ``folder`` is one that all executors share.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    store, folder = _named(spark, folder)
    mark = f".mark-{uuid.uuid4().hex}"
    store.create(_path(spark, f"{folder}/{mark}")).close()
    cut = narrow.mapInArrow(
        _cut(stride, vocabulary, end_token, key, shards, partitions, per_partition),
        "place bigint, shard int, tokens binary, doc_ids array<bigint>, n_tokens int",
    )
    dealt = cut.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place")
    done = written(
        dealt.mapInArrow(_write(folder, mark), "shard int, record bigint, doc_ids array<bigint>, n_tokens int, crc32 bigint"), "sequences"
    )
    counts = done.groupBy("shard").agg(F.count("*").alias("n"), F.sum("crc32").alias("checksum"))  # a row per shard
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.col("n").alias("records"), "checksum")
    for left in store.globStatus(_path(spark, f"{folder}/.*-*")) or []:
        store.delete(left.getPath(), False)
    first.write.parquet(f"{folder}/{MANIFEST}")
    return done.join(first, "shard").select(
        (F.col("first") + F.col("record")).alias("slot"), "shard", "record", "doc_ids", "n_tokens", "crc32"
    )


def fresh_folder(docs: DataFrame, name: str = "shards") -> str:
    return scratch_table(docs.sparkSession, name)


def read_records(folder: str, shard: int, record: int, n: int, stride: int = STRIDE) -> np.ndarray:
    """``n`` records of a shard from ``record`` on, by one seek. ``folder`` is named in full."""
    store, path = _store(folder)
    with store.open_input_file(f"{path}/shard-{shard:07d}.bin") as file:
        file.seek(record * stride * 2)
        return np.frombuffer(file.read(n * stride * 2), "<u2").reshape(-1, stride)


def read_slots(spark: SparkSession, folder: str, slot: int, n: int, stride: int = STRIDE) -> Iterator[np.ndarray]:
    """The sequences of ``n`` global slots from ``slot`` on, shard by shard; the manifest says where they are."""
    _, folder = _named(spark, folder)
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/{MANIFEST}")
    hit = manifest.filter((F.col("first") < slot + n) & (F.col("first") + F.col("records") > slot)).orderBy("first")
    for r in hit.toLocalIterator():
        at = max(0, slot - r["first"])
        yield read_records(folder, r["shard"], at, min(slot + n - r["first"], r["records"]) - at, stride)
