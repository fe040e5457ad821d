"""Language ID by rank-order profiles.

A profile is a list of the most frequent character n-grams (one to three letters, words padded with
a blank), most frequent first, ties by n-gram. Profiles of languages are counted over all labelled
training documents: every task counts, a shuffle by language and n-gram adds up, and the top of each
language is kept. A document's own profile is compared with each by out-of-place distance: the
difference of ranks, or the profile length for an n-gram that the language does not list. The
language with the smallest distance wins (ties by name), and the score is one minus its distance as
a share of the largest possible.

The profiles are as many rows as languages (``MOST_LANGUAGES``, checked) times ``top``; they alone are
sent to the tasks. A text of any length is counted in parts of a million characters.
Without letters, or if no language was learned, the answer is ``und`` with score 0. Null text counts
as empty; null and repeated ids are kept, and rows with null id are not learned from; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadtide.llm.arrays import bounded, letters, pieces

TOP = 400
LONGEST = 3
#: The code of a blank in an n-gram; it is no letter, and unlike 0 it differs from no code at all.
BLANK = 1
#: Bytes of text that are looked at together; a longer text is counted in parts.
LONG = 1 << 20
#: More languages than this are not languages: the column holds something else.
MOST_LANGUAGES = 1000


def ngrams(texts: pa.Array, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(grams, bounds): all n-grams of text i are grams[bounds[i]:bounds[i + 1]], packed 21 bits a letter."""
    codes, owner = letters(texts)
    n = len(texts)
    blank = codes == 0
    owner = np.where(blank & (np.arange(len(codes)) < len(codes) - 1), np.append(owner[1:], n), owner)
    codes = np.where(blank, BLANK, codes)
    out, whose = [codes[~blank]], [owner[~blank]]
    packed = codes
    for k in range(1, longest):
        packed = packed[: len(codes) - k] | (codes[k:] << (21 * k))
        good = np.ones(len(packed), bool)
        for i in range(1, k):  # a blank stands at an end only
            good &= ~blank[i : len(codes) - k + i]
        out.append(packed[good])
        whose.append(owner[: len(packed)][good])
    grams, whose = np.concatenate(out), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return grams[order], np.searchsorted(whose[order], np.arange(n + 1))


def counted(text: str, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one text of any length with their counts; a part of it is held at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = ""
    for part, inside in pieces(text, most):
        held.append(np.unique(ngrams(pa.array([part]))[0], return_counts=True))
        if last:  # a run of letters was cut: its n-grams over the cut, instead of those at its ends
            held += _mended(last, part)
        last = part if inside else ""
        if len(held) > 8:
            held = [_merged(held)]
    grams, counts = _merged(held) if held else (np.empty(0, np.int64), np.empty(0, np.int64))
    return grams[counts > 0], counts[counts > 0]


def _mended(before: str, after: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """n-grams of the letters around a cut as one word, less those as two words."""
    whole, left, right = before[-LONGEST:] + after[:LONGEST], before[-LONGEST:], after[:LONGEST]
    count = lambda t: np.unique(ngrams(pa.array([t]))[0], return_counts=True)
    return [count(whole), *((g, -n) for g, n in (count(left), count(right)))]


def strongest(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent of distinct ascending n-grams, most frequent first."""
    return grams[np.argsort(-counts, kind="stable")[:top]]


def _is_long(texts: pa.Array) -> bool:
    return len(texts) == 1 and texts[0].is_valid and texts[0].as_buffer().size > LONG


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams with their counts added up."""
    found, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return found, np.bincount(at, np.concatenate([n for _, n in parts]), len(found)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language of one task, given out whenever a million distinct n-grams are held."""
    held: dict[str, list] = {}

    def given(name: str) -> pa.RecordBatch:
        found, counts = _merged(held.pop(name))
        return pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(counts)], names=["lang", "gram", "n"])

    def add(name: str, found: tuple[np.ndarray, np.ndarray]) -> None:
        parts = held.setdefault(name, [])
        parts.append(found)
        if len(parts) > 8:
            held[name] = [_merged(parts)]

    for whole in batches:
        for batch in bounded(whole, 1, LONG):
            if _is_long(batch.column(1)):
                name = batch.column(0)[0].as_py()
                add(name, counted(batch.column(1)[0].as_py()))
                if len(held[name][-1][0]) > 1_000_000:
                    yield given(name)
                continue
            grams, bounds = ngrams(batch.column(1))
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            of = np.repeat(names, np.diff(bounds))
            for name in sorted(set(names)):
                add(name, np.unique(grams[of == name], return_counts=True))
            for name in [name for name, parts in held.items() if sum(len(g) for g, _ in parts) > 1_000_000]:
                yield given(name)
    for name in list(held):
        yield given(name)


def profiles(labelled: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> dict[str, np.ndarray]:
    """The profile of each language in all of ``labelled``."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = counted.withColumn("place", place).filter(F.col("place") <= top).select("lang", "gram", "place")
    if (names := rows.select("lang").distinct().count()) > MOST_LANGUAGES:
        raise ValueError(f"{names} languages: more than {MOST_LANGUAGES} profiles of {top} n-grams are not sent to every task")
    out: dict[str, list] = {}
    for r in kept.orderBy("lang", "place").collect():  # MOST_LANGUAGES x top rows at most
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _predictor(known: dict[str, np.ndarray], top: int):
    names = sorted(known)
    order = [np.argsort(known[x]) for x in names]
    sorted_grams = [known[x][o] for x, o in zip(names, order, strict=True)]

    def distance(own: np.ndarray, k: int) -> int:
        at = np.minimum(np.searchsorted(sorted_grams[k], own), len(sorted_grams[k]) - 1)
        listed = sorted_grams[k][at] == own
        return int(np.where(listed, np.abs(order[k][at] - np.arange(len(own))), top).sum())

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, 2, LONG):
                if _is_long(batch.column(2)):
                    found = [counted(batch.column(2)[0].as_py())]
                else:
                    grams, bounds = ngrams(batch.column(2))
                    found = (np.unique(grams[s:e], return_counts=True) for s, e in zip(bounds[:-1], bounds[1:], strict=True))
                langs, scores = [], []
                for grams_of, counts in found:
                    if not len(grams_of) or not names:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    own = strongest(grams_of, counts, top)
                    far = [distance(own, k) for k in range(len(names))]
                    best = int(np.argmin(far))
                    langs.append(names[best])
                    scores.append(1.0 - far[best] / (top * len(own)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return predict


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", top: int = TOP,
    known: dict[str, np.ndarray] | None = None,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Profiles are learned from the documents that are not held out (crc32 of the id modulo 4 is not 2),
    unless ``known`` has them.
    """
    part = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    if known is None:
        known = profiles(docs.filter(part != 2), lang, text, top)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(part == 2, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_predictor(known, top), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
