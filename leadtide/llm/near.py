"""Near-duplicates by ProbMinHash, banding and verification.

A document is its set of five-word shingles (words: runs without ASCII white space; a text of one to
four words is one shingle). Shingles weigh 1 + log2 of how often the text has them. ProbMinHash lets
each shingle emit points of a Poisson process of that rate; a point falls on one of ``bands * rows``
components, each component keeps the earliest, and a document stops once the next point of a shingle
comes after the latest kept one. Equal components estimate the probability Jaccard similarity.
Bands of components are buckets. A text that has a shingle twice or more also has the buckets of the
signature with all weights 1; without repeats the two signatures are one. So every two documents
are compared by their plain sets too, however often one of them repeats a part. Two documents are
linked if they share a bucket and the Jaccard similarity of their sets is ``least`` or more; classes
are the connected components of the links. With 24 bands of 5 a pair at 0.8 shares no bucket with
probability 7e-5 at most.

Documents with one set are one node from the start. Each bucket first compares its nodes with one
pivot, the node that shares buckets with most others; links are joined up, and another pivot follows.
That connects all but a few nodes of a large class. Only nodes of different components that still
share a bucket are then compared with each other, inside the join, which gives out the links and no
other pair; a large bucket is cut into square blocks of pairs, which are compared in tasks of their own. A pair is left out only if its nodes are connected already or differ too much in size,
so no link that could change a class is lost.

Sketches and links are tables in the shared folder; every step is a join or an aggregate that
combines in each task, and hot keys are met by skew joins. Rows are named by a 64-bit hash of id
and text, used only to fetch texts whose digest is then computed anew. Null text counts as empty;
texts without words form one class; null and repeated ids are kept: the row that stays has the
smallest id (null last), of identical rows one. An empty table gives no rows; other columns pass
through ``drop_near`` and are ignored by ``classes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtide.llm.arrays import bounded
from leadtide.llm.common import row_key, unused, written

SHINGLE = 5
LEAST = 0.8
BANDS = 24
ROWS = 5
#: Rounds of pivots before what is not connected is compared.
ROUNDS = 2
#: Bytes of one text that are cut into words at a time.
PART = 1 << 20
#: Nodes of a bucket that are compared with each other in one task.
BLOCK = 256


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _parts(texts: pa.Array, most: int = PART) -> Iterator[pa.Array]:
    """The texts, or one long text in parts of about ``most`` bytes that end between words."""
    if len(texts) != 1 or not texts[0].is_valid or texts[0].as_buffer().size <= most:
        yield texts
        return
    whole = memoryview(texts[0].as_buffer())
    at = 0
    while at < len(whole):
        end = at + most
        while end < len(whole) and not (cut := max(bytes(whole[at:end]).rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1):
            end += most  # a word longer than a part
        end = at + cut if end < len(whole) else len(whole)
        yield pa.array([bytes(whole[at:end])], pa.binary()).cast(pa.string())
        at = end


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each word."""
    import xxhash

    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    docs = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    words = flat.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    word = known[words.indices.to_numpy(zero_copy_only=False)[full]] if len(known) else np.empty(0, np.uint64)
    return word, docs[full]


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, bounds): document i has the ascending distinct hashes[bounds[i]:bounds[i + 1]].

    A long text is cut into words part by part; of the whole text only a number per word is held.
    """
    n = len(texts)
    parts = [_words(part) for part in _parts(texts)]
    if len(parts) == 1:
        word, docs = parts[0]
    else:  # one long text
        word = np.concatenate([w for w, _ in parts])
        docs = np.zeros(len(word), np.int64)
    del parts
    odd = _odd(size)
    per_doc = np.bincount(docs, minlength=n)
    ends = np.cumsum(per_doc)
    hashes, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(word) >= size:
        at = np.flatnonzero(docs[: len(docs) - size + 1] == docs[size - 1 :])
        hashes = np.zeros(len(at), np.uint64)
        for k in range(size):
            hashes += word[at + k] * odd[k]
        hashes, owner = _mix(hashes), docs[at]
    short = np.flatnonzero((per_doc > 0) & (per_doc < size))
    if len(short):
        whole = [_mix((word[e - c : e] * odd[:c]).sum(keepdims=True) + np.uint64(c)) for c, e in zip(per_doc[short], ends[short], strict=True)]
        order = np.argsort(np.concatenate([owner, short]), kind="stable")
        hashes, owner = np.concatenate([hashes, *whole])[order], np.concatenate([owner, short])[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        hashes[s:e].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(hashes)))
    return hashes[first], counts, np.searchsorted(owner[first], np.arange(n + 1))


def signatures(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """The element with the earliest point on each of ``m`` components; row i for document i."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    best, sign = np.full((n, m), np.inf), np.zeros((n, m), np.uint64)
    element, rate, time = hashes, weights.astype(float), np.zeros(len(hashes))
    flat_best, flat_sign = best.ravel(), sign.ravel()
    step = 0
    while len(element):
        salt = np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        bits = _mix(element + salt)
        time = time - np.log(((bits >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53) / rate
        place = (_mix(bits ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
        slot = doc * m + place.astype(np.int64)
        np.minimum.at(flat_best, slot, time)
        won = time == flat_best[slot]
        flat_sign[slot[won]] = element[won]
        open_docs = np.flatnonzero(np.diff(np.searchsorted(doc, np.arange(n + 1)))) if step < 8 else np.unique(doc)
        latest = np.zeros(n)
        latest[open_docs] = best[open_docs].max(axis=1)
        go = time < latest[doc]
        doc, element, rate, time = doc[go], element[go], rate[go], time[go]
        step += 1
    return sign


def _sketches(bands: int, rows: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        salts = _odd(rows)

        def buckets(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            sign = signatures(hashes, weights, bounds, bands * rows).reshape(-1, bands, rows)
            return _mix((sign * salts).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)

        for whole in batches:
            for batch in bounded(whole, 2, rows=1024):
                hashes, counts, bounds = shingle_sets(batch.column("text"))
                sizes = np.diff(bounds)
                banded = list(buckets(hashes, 1.0 + np.log2(counts), bounds))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                again = np.unique(owner[counts > 1])
                ends = np.concatenate([[0], np.cumsum(sizes[again])])
                inside = np.isin(owner, again)
                for i, plain in zip(again, buckets(hashes[inside], np.ones(inside.sum()), ends), strict=True):
                    banded[i] = np.unique(np.concatenate([banded[i], plain]))
                banded = [b if n else b[:0] for b, n in zip(banded, sizes, strict=True)]
                digest = [xxhash.xxh3_128_digest(hashes[s:e].tobytes()) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(b) for b in banded])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"), pa.array(digest, pa.binary()), pa.array(sizes, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(banded)))],
                    names=["doc_id", "row", "digest", "n", "bands"],
                )

    return sketches


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for whole in batches:
        for batch in bounded(whole, whole.schema.get_field_index("text"), rows=1024):
            hashes, _, bounds = shingle_sets(batch.column("text"))
            digest = [xxhash.xxh3_128_digest(hashes[s:e].tobytes()) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), lists], names=["digest", "shingles"])


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it is connected with) for every node of links (a, b).

    Each turn lets every node take its smallest neighbour, jumps once, and contracts the links.
    """
    def nodes(df: DataFrame) -> DataFrame:
        both = df.unionByName(df.select(F.col("a").alias("b"), F.col("b").alias("a")))
        return both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root"))

    links = links.filter("a <> b")
    roots = None
    while True:
        near = written(nodes(links), "parents")
        if near.isEmpty():
            return near if roots is None else roots
        up = near.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = near.join(up, "root").select("node", F.col("top").alias("root"))
        moved = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
        if roots is None:
            roots = written(step, "roots")
        else:
            roots = written(roots.join(moved, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
        a, b = (step.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab")
        links = links.join(a, "a").join(b, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        links = written(links.filter("a <> b").distinct(), "links")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those pairs (a, b) whose sets are similar."""
    a, b = (sets.select(F.col("digest").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    both = pairs.join(a, "a").join(b, "b").select(
        "a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("common"), (F.size("a_set") + F.size("b_set")).alias("sum")
    )
    return both.filter(F.col("common") + 1e-9 >= least * (F.col("sum") - F.col("common"))).select("a", "b")


def _blocks(now: DataFrame, sets: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of each bucket twice, with their sets, dealt so that each two nodes of a bucket meet once.

    A bucket is a square of nodes by nodes. It is cut into square blocks of about ``block`` nodes a side,
    and a block is the key that its rows and columns meet under: no task has a whole large bucket.
    """
    sides = now.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("sides"))
    nodes = now.select("bucket", "digest", "n", "part").join(sides, "bucket")
    nodes = nodes.withColumn("mine", F.pmod(F.xxhash64("digest"), F.col("sides")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    one = nodes.select("bucket", F.col("mine").alias("row_block"), every.alias("column_block"), "digest", "n", "part")
    other = nodes.select(
        F.col("bucket").alias("p_bucket"), every.alias("p_row_block"), F.col("mine").alias("p_column_block"),
        F.col("digest").alias("p_digest"), F.col("n").alias("p_n"), F.col("part").alias("p_part"),
    )
    return one.join(sets, "digest"), other.join(sets.select(F.col("digest").alias("p_digest"), F.col("shingles").alias("p_shingles")), "p_digest")


def classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST, bands: int = BANDS, rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, row, class_id, class_size, kept. ``row`` names equal rows alike."""
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    narrow = narrow.select("doc_id", row_key("doc_id", "text").alias("row"), "text")
    sketched = written(
        narrow.mapInArrow(_sketches(bands, rows), "doc_id bigint, row bigint, digest binary, n int, bands array<bigint>"), "sketches"
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = sketched.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    spread = sketched.dropDuplicates(["digest"]).select("digest", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    entries = written(spread.join(shared, "bucket"), "buckets")
    degree = entries.groupBy("digest").agg(F.sum("nodes").alias("degree"))
    wanted = entries.select("digest").distinct().join(nodes, "digest").select(F.col("first.row").alias("row"))
    sets = written(
        narrow.join(wanted, "row", "left_semi").mapInArrow(_sets, "digest binary, shingles array<bigint>").dropDuplicates(["digest"]), "sets"
    )

    def tagged(roots: DataFrame | None) -> DataFrame:
        if roots is None:
            return entries.withColumn("part", F.col("digest"))
        of = roots.select(F.col("node").alias("digest"), F.col("root").alias("part"))
        return entries.join(of, "digest", "left").withColumn("part", F.coalesce("part", "digest"))

    links, roots = None, None
    alike = F.least("n", "p_n") + 1e-9 >= least * F.greatest("n", "p_n")
    for turn in range(ROUNDS + 1):
        now = tagged(roots)
        split = now.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("bucket")
        now = written(now.join(split, "bucket"), "open")
        if now.isEmpty():
            break
        if turn < ROUNDS:
            ranked = now.join(degree, "digest").withColumn("rank", F.when(F.lit(turn == 0), -F.col("degree")).otherwise(F.xxhash64("digest")))
            pick = F.min(F.struct("rank", F.col("digest").alias("p"), F.col("n").alias("p_n"), F.col("part").alias("p_part")))
            pivots = ranked.groupBy("bucket").agg(pick.alias("v")).select("bucket", "v.p", "v.p_n", "v.p_part")
            pairs = now.join(pivots, "bucket").filter((F.col("part") != F.col("p_part")) & alike)
            pairs = pairs.select(F.least("digest", "p").alias("a"), F.greatest("digest", "p").alias("b")).distinct()
            found = _verified(pairs, sets, least)
        else:
            one, other = _blocks(now, sets, block)
            common = F.size(F.array_intersect("shingles", "p_shingles"))
            close = (1 + least) * common + 1e-6 >= least * (F.col("n") + F.col("p_n"))
            same = (F.col("bucket") == F.col("p_bucket")) & (F.col("row_block") == F.col("p_row_block")) & (F.col("column_block") == F.col("p_column_block"))
            pairs = one.join(other, same & (F.col("part") < F.col("p_part")) & alike & close)
            found = pairs.select(F.col("digest").alias("a"), F.col("p_digest").alias("b")).distinct()
        found = written(found, "links")
        links = found if links is None else links.unionByName(found)
        roots = components(links)

    if roots is None:
        placed = nodes.withColumn("part", F.col("digest"))
    else:
        placed = nodes.join(roots.select(F.col("node").alias("digest"), F.col("root").alias("part")), "digest", "left")
        placed = placed.withColumn("part", F.coalesce("part", "digest"))
    whole = placed.groupBy("part").agg(F.min("first").alias("class_first"), F.sum("size").alias("class_size"))
    by_node = placed.select("digest", "part").join(whole, "part").select("digest", "class_first", "class_size")
    counted = sketched.groupBy("doc_id", "row", "digest").agg(F.count("*").alias("times"))
    return counted.join(by_node, "digest").select(
        "doc_id", "row", "class_first", "class_size", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("time")
    ).select(
        "doc_id", "row", F.col("class_first.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("class_first.doc_id")) & (F.col("row") == F.col("class_first.row")) & (F.col("time") == 1)).alias("kept"),
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows that stay, one of each class, with all their columns."""
    stay = classes(docs, doc_id, text, **how).filter("kept").select(F.col("row").alias("stays"), F.col("doc_id").alias("id"))
    (row,) = unused(docs, "row")
    rows = docs.withColumn(row, row_key(F.col(doc_id).cast("bigint"), text))
    kept = rows.join(stay, (F.col(row) == F.col("stays")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("id")), "left_semi")
    return kept.dropDuplicates([row, doc_id]).select(*[F.col(f"`{c}`") for c in docs.columns])
