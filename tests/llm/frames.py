"""Small frames that every operator must stand, and brute-force versions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "the quick onion of eared thing is red and thin to the edge " * 4000
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "src0", 35),
    (2, "alpha  beta\tgamma delta\nepsilon zeta", "en", "src1", 36),
    (3, "", "en", "src0", 0),
    (4, None, None, None, None),
    (None, "alpha beta gamma delta epsilon zeta", "en", "src0", 35),
    (None, None, None, None, None),
    (5, "  \n\t ", "de", "src2", 5),
    (6, "x", None, "src0", 1),
    (7, LONG, "en", "src0", len(LONG)),
    (8, LONG + "more", "en", None, len(LONG) + 4),
    (1, "alpha beta gamma delta epsilon zeta", "en", "src0", 35),
    (9, "naïve café öl ÉTÉ ß 日本語 🙂", "fr", "src3", 24),
    (9, "another text under a repeated id", "en", "src3", 30),
]
#: Names that the operators use inside and in their results.
EXTRA = ["kept", "row", "digest", "points", "slot", "place", "block", "n", "text_sha256", "class_id", "m_key", "Bands", "host"]


def odd(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


def crowded(spark: SparkSession) -> DataFrame:
    """The odd rows with columns whose names clash."""
    from pyspark.sql import functions as F

    return odd(spark).select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)])


def none(spark: SparkSession) -> DataFrame:
    return odd(spark).limit(0)


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """doc_id -> smallest doc_id connected by pairs of similarity 0.8 or more; all pairs are compared."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        if a == b or (len(a & b) >= 0.8 * len(a | b) - 1e-9 and a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: find(i) for i in sets}
