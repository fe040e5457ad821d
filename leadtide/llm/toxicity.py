"""Toxicity by classifier chains.

The labelled categories form a chain. Each link is a logistic regression on the words of a document
and on the probabilities of all earlier links. While a link is trained, those probabilities come
from models that have not seen the row (out of fold); when a document is scored, from the final
models. Features are words and word beginnings of three to six letters, present or not, in lower
case and as 64-bit hashes, so inflected and compound forms of a toxic stem share a feature.

The models are fitted on a bounded sample of labelled rows: the ``sample`` rows with the smallest
hash of their id. Their texts are cut to features and counted on the executors; only which of the
chosen features each row has, at most a few hundred numbers a row, is fitted on the driver. A feature enters a model if its frequency in the category differs from the base
rate by ``Z`` standard deviations in that model's own training rows, the ``features`` strongest at
most; so both what is collected and what is sent to the tasks have fixed bounds. Scoring is one pass
without a shuffle; a text of any length is cut to features in parts of a million characters, and a run
of letters longer than that counts as several words.

Null text counts as empty; without labels, or if a category has one value only, its probability is
that constant; labels that are null or not 0 or 1 are not learned from, and of repeated labels of
an id the largest counts. Null and repeated ids are kept; an empty table gives no rows; other
columns pass through ``drop_toxic`` and are ignored by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtide.llm.arrays import bounded, letters, pieces
from leadtide.llm.common import written

#: The chain, earliest first: how each category follows from the columns of the labels.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}
SAMPLE = 10_000
FEATURES = 4_000
FOLDS = 3
Z = 4.0
STARTS = (3, 4, 5, 6)
#: Bytes of text that are cut to features together; a longer text is cut in parts.
LONG = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes): the words and word beginnings of each text, not yet distinct."""
    codes, owner = letters(texts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * _powers(_BASE, len(codes)), dtype=np.uint64)])
    edge = np.diff(np.concatenate([[0], (codes != 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    back = _powers(_INVERSE, len(codes))
    rows, hashes = [], []
    for kind, (s, e) in enumerate([(starts, ends), *((starts[ends - starts >= n], starts[ends - starts >= n] + n) for n in STARTS)]):
        h = (sums[e] - sums[s]) * back[s] + np.uint64(kind)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        rows.append(owner[s])
        hashes.append((h ^ (h >> np.uint64(32))).view(np.int64))
    return np.concatenate(rows), np.concatenate(hashes)


def long_features(text: str, most: int) -> np.ndarray:
    """The distinct features of one text of any length; a part of it is held at a time.

    A run of letters longer than a part is cut after each part: its features are those of the parts.
    """
    held = np.empty(0, np.int64)
    for part, _ in pieces(text, most):
        held = np.union1d(held, features(pa.array([part]))[1])
    return held


def _features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``features``, in parts if it is one long text."""
    if len(texts) == 1 and texts[0].is_valid and texts[0].as_buffer().size > LONG:
        hashes = long_features(texts[0].as_py(), LONG)
        return np.zeros(len(hashes), np.int64), hashes
    return features(texts)


def _feature_counts(categories: int):
    """Per feature and fold: rows that have it, and those of them in each category."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, 0):
                rows, hashes = _features_of(batch.column(0))
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                rows, hashes = rows[new], hashes[new]
                folds = batch.column(1).to_numpy()[rows]
                found, at = np.unique(hashes, return_inverse=True)
                slot, place = np.unique(at * 1024 + folds, return_inverse=True)
                own = [np.bincount(place, batch.column(2 + c).to_numpy()[rows], len(slot)).astype(np.int64) for c in range(categories)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[slot // 1024]), pa.array((slot % 1024).astype(np.int32)), pa.array(np.bincount(place, minlength=len(slot))),
                     *map(pa.array, own)],
                    names=["feature", "fold", "n", *[f"y{c}" for c in range(categories)]],
                )

    return count


def _present(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, places): which entries of the sorted ``vocabulary`` each text has, each once."""
    rows, hashes = _features_of(texts)
    maybe = np.zeros(1 << 20, bool)
    maybe[vocabulary & 0xFFFFF] = True
    near = maybe[hashes & 0xFFFFF]
    rows, hashes = rows[near], hashes[near]
    at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
    hit = vocabulary[at] == hashes if len(vocabulary) else np.zeros(0, bool)
    pairs = np.unique(rows[hit] * np.int64(1 << 32) + at[hit])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _picked(vocabulary: np.ndarray, columns: list[str]):
    """The other columns of the sample with the entries each text has."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, 0):
                rows, places = _present(batch.column(0), vocabulary)
                bounds = np.searchsorted(rows, np.arange(len(batch) + 1))
                words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], words], names=columns)

    return pick


@dataclass
class Link:
    """One category: a constant if ``weights`` is None."""

    intercept: float
    weights: np.ndarray | None = None
    earlier: tuple[float, ...] = ()


    def probability(self, rows: np.ndarray, places: np.ndarray, n: int, earlier: list[np.ndarray]) -> np.ndarray:
        """For ``n`` rows, of which rows[i] has the feature places[i]."""
        if self.weights is None:
            return np.full(n, self.intercept)
        z = self.intercept + np.bincount(rows, self.weights[places], n)
        for w, p in zip(self.earlier, earlier, strict=True):
            z = z + w * p
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class Chain:
    categories: tuple[str, ...]
    vocabulary: np.ndarray
    links: list[Link]

    def probabilities(self, texts: pa.Array) -> list[np.ndarray]:
        n = len(texts)
        rows, places = _present(texts, self.vocabulary)
        out: list[np.ndarray] = []
        for link in self.links:
            out.append(link.probability(rows, places, n, out))
        return out


def logistic(rows: np.ndarray, columns: np.ndarray, width: int, dense: np.ndarray, y: np.ndarray, penalty: float = 0.02, turns: int = 20) -> np.ndarray:
    """Weights of the dense columns (the first is the constant), then of ``width`` present-or-not ones.

    Newton steps with preconditioned conjugate gradients, halved until the loss falls; the squares of
    all weights but the constant are penalized. ``rows`` ascend.
    """
    n, d = dense.shape
    w, ridge = np.zeros(d + width), np.full(d + width, penalty)
    ridge[0] = 1e-6
    order = np.argsort(columns, kind="stable")
    by_column = rows[order]
    row_ids, row_starts = np.unique(rows, return_index=True)
    column_ids, column_starts = np.unique(columns[order], return_index=True)

    def times(v: np.ndarray) -> np.ndarray:
        out = dense @ v[:d]
        if len(rows):
            out[row_ids] += np.add.reduceat(v[d:][columns], row_starts)
        return out

    def back(r: np.ndarray, x: np.ndarray = dense) -> np.ndarray:
        out = np.zeros(d + width)
        out[:d] = x.T @ r
        if len(rows):
            out[d + column_ids] = np.add.reduceat(r[by_column], column_starts)
        return out

    def loss(v: np.ndarray) -> float:
        z = times(v)
        return float((np.logaddexp(0, z) - y * z).sum() + (ridge * v * v).sum() / 2)

    now = loss(w)
    for _ in range(turns):
        p = 1.0 / (1.0 + np.exp(-np.clip(times(w), -500, 500)))
        grad, s = back(p - y) + ridge * w, p * (1 - p) + 1e-9
        scale_by = 1.0 / (back(s, dense * dense) + ridge)
        step, r = np.zeros_like(w), -grad
        q = scale_by * r
        rz = first = float(r @ q)
        for _ in range(30):
            if rz <= 1e-6 * first:
                break
            hq = back(s * times(q)) + ridge * q
            a = rz / float(q @ hq)
            step, r = step + a * q, r - a * hq
            rz, old = float(r @ (scale_by * r)), rz
            q = scale_by * r + rz / old * q
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        after = loss(w + size * step)
        if not after < now - 1e-6 * (1 + now):
            break
        w, now = w + size * step, after
    return w


def _sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, categories: dict[str, str], sample: int, folds: int) -> DataFrame:
    """text, fold, y0, y1, ... of the labelled documents in the sample."""
    ys = [F.expr(e).cast("int").alias(f"y{c}") for c, e in enumerate(categories.values())]
    good = labels.select(F.col("doc_id").cast("bigint").alias("l_id"), *ys).filter("l_id is not null")
    for c in range(len(categories)):
        good = good.filter(f"y{c} in (0, 1)")
    one = good.groupBy("l_id").agg(*[F.max(f"y{c}").alias(f"y{c}") for c in range(len(categories))])
    # At most ``sample`` rows: a proven bound.
    some = F.broadcast(one.orderBy(F.xxhash64("l_id"), "l_id").limit(sample))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("l_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(some, "l_id")
    # One row per id, so that ``sample`` bounds the rows as well as the ids.
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    ys = [f"y{c}" for c in range(len(categories))]
    rows = rows.groupBy("l_id", *ys).agg(first).select("l_id", F.col("first.text").alias("text"), *ys)
    fold = F.pmod(F.xxhash64(F.lit(1), "l_id"), F.lit(folds)).cast("int").alias("fold")
    return rows.select("text", fold, *[f"y{c}" for c in range(len(categories))])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", categories: dict[str, str] | None = None,
    sample: int = SAMPLE, most: int = FEATURES, folds: int = FOLDS,
) -> Chain:
    """Fit the chain on a bounded sample of the labelled documents."""
    categories = CATEGORIES if categories is None else categories
    ys = [f"y{c}" for c in range(len(categories))]
    rows = written(_sampled(docs, labels, doc_id, text, categories, sample, folds).repartition(16), "labelled")
    per_fold = rows.groupBy("fold").agg(F.count("*").alias("n"), *[F.sum(y).alias(y) for y in ys]).collect()  # folds rows
    sizes = {r["fold"]: r for r in per_fold}
    sets = [None, *range(folds)]  # all rows, and all but one fold

    def total(column: str, without: int | None) -> int:
        return sum(r[column] for k, r in sizes.items() if k != without)

    schema = "feature bigint, fold int, n bigint, " + ", ".join(f"{y} bigint" for y in ys)
    counted = rows.mapInArrow(_feature_counts(len(ys)), schema).groupBy("feature").agg(
        *[F.sum(F.when(F.col("fold") != k, F.col(c)) if k is not None else F.col(c)).alias(f"{c}_{k}") for k in sets for c in ("n", *ys)]
    )
    scores = []
    for k in sets:
        for y in ys:
            rate = total(y, k) / max(1, total("n", k))
            n, hit = F.col(f"n_{k}"), F.col(f"{y}_{k}")
            z = (F.abs(hit - n * rate) / F.sqrt(n * rate * (1 - rate))) if 0 < rate < 1 else F.lit(0.0)
            scores.append(F.when(n >= 5, z).otherwise(0.0).alias(f"z_{y}_{k}"))
    strongest = counted.select("feature", *scores).withColumn("z", F.greatest(*[f"z_{y}_{k}" for k in sets for y in ys]))
    kept = strongest.filter(F.col("z") >= Z).orderBy(F.desc("z"), "feature").limit(most).toPandas()  # ``most`` rows
    kept = kept.sort_values("feature")
    vocabulary = kept["feature"].to_numpy(np.int64)

    columns = ["fold", *ys, "words"]
    kinds = "fold int, " + ", ".join(f"{y} int" for y in ys) + ", words array<int>"
    table = rows.mapInArrow(_picked(vocabulary, columns), kinds).toArrow()  # ``sample`` rows
    fold = table.column("fold").to_numpy()
    words = table.column("words").combine_chunks() if len(table) else pa.array([], pa.list_(pa.int32()))
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    row_of = np.repeat(np.arange(len(table)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    word = words.flatten().to_numpy()

    def fit(y: str, without: int | None, earlier: list[np.ndarray]) -> Link:
        """The link learned from all rows, or all but one fold."""
        here = np.ones(len(table), bool) if without is None else fold != without
        target = table.column(y).to_numpy()[here].astype(float)
        own = np.flatnonzero(kept[f"z_{y}_{without}"].to_numpy() >= Z)
        if not 0 < target.sum() < len(target) or not len(own):
            return Link(float(target.sum() / max(1, len(target))))
        column = np.full(len(vocabulary), -1)
        column[own] = np.arange(len(own))
        use = here[row_of] & (column[word] >= 0)
        at = (np.cumsum(here) - 1)[row_of[use]]
        dense = np.column_stack([np.ones(int(here.sum())), *[p[here] for p in earlier]])
        solved = logistic(at, column[word[use]], len(own), dense, target)
        weights = np.zeros(len(vocabulary))
        weights[own] = solved[dense.shape[1] :]
        return Link(float(solved[0]), weights, tuple(map(float, solved[1 : dense.shape[1]])))

    links: list[Link] = []
    oof: list[np.ndarray] = []
    for y in ys:
        links.append(fit(y, None, oof))
        if y != ys[-1]:
            p = np.zeros(len(table))
            for k in range(folds):
                p = np.where(fold == k, fit(y, k, oof).probability(row_of, word, len(table), oof), p)
            oof = [*oof, p]
    return Chain(tuple(categories), vocabulary, links)


def score(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the probability of each category, rejected (by the last one)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, 1):
                p = chain.probabilities(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, p), pa.array(p[-1] >= threshold)],
                    names=["doc_id", *[f"p_{c}" for c in chain.categories], "rejected"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    probabilities = ", ".join(f"p_{c} double" for c in chain.categories)
    return rows.mapInArrow(scored, f"doc_id {dict(rows.dtypes)['doc_id']}, {probabilities}, rejected boolean")


def drop_toxic(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, at):
                yield batch.filter(pc.less(pa.array(chain.probabilities(batch.column(at))[-1]), threshold))

    return docs.mapInArrow(keep, docs.schema)
