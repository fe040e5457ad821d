"""Filter interaction audit: five filters in every order, from one table of failure combinations.

Each text is looked at once for the conditions A to D. Condition E, an equal text under a smaller
doc_id anywhere in the table, is an existential self-join: a row meets its hash, its exact text and a
smaller doc_id in a left-semi join. Only texts whose hash occurs under two doc_ids take part; the
other side of the join has one row per distinct text, its smallest doc_id, and a text with many
copies is salted by its own number of rows, so a group of copies of any size spreads over tasks.

The ids that E marks are united with the failures of the other filters, and one aggregation makes
the bit combination of each id. What all 120 orders then need is a table of at most 32 combinations
per part: a document is removed by the filter of its combination that comes first. The Shapley value
of a filter is 120 / k removals for each document with it and k - 1 other failures.

Null text counts as empty, a null part as the empty string; null doc_ids are neither smaller nor
larger than others and have no label; rows that share a doc_id are never copies of each other and
count as often as they occur; a label repeated for an id counts once; an empty table gives no rows;
other columns are ignored. Texts of any length are read whole, and shuffled only if they have copies.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.llm.common import let, written

#: Failure conditions over text, words (an array), in the order of their bits; E has the last bit.
LETTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of one text that one salt holds.
SALT_ROWS = 256
#: Repeated hashes that are broadcast; more than that are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def _fails(text: Column) -> Column:
    """Bits of A to D."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    few = let(words, lambda ws: let(F.size(ws), lambda n: F.when(n < 50, 1).otherwise(0)
              + F.when(100 * F.size(F.array_distinct(ws)) < 65 * n, 2).otherwise(0)))
    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 5 * F.length(text).cast("bigint")
    return few + F.when(capitals, 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, h1, h2, bits: a row per document with its failures of A to D and its text's name."""
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.select("doc_id", "part", *_names(F.col("text")), _fails(F.col("text")).alias("bits"))


def _names(text: Column) -> list[Column]:
    """Two independent hashes that find the rows to compare; the text itself decides."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def repeated(
    docs: DataFrame, failed: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
    salt_rows: int = SALT_ROWS, most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """doc_id, part, h1, h2 of the rows whose text a smaller doc_id has too."""
    names = failed.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    names = written(names.filter("first < last").select("h1", "h2", F.ceil(F.col("n") / salt_rows).cast("int").alias("salts")), "repeated")
    # Checked: at most 1,000,000 rows of 20 bytes; beyond that a shuffled join does the same.
    small = F.broadcast(names) if names.count() <= most_broadcast else names
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("doc_id is not null")
    rows = rows.select("*", *_names(F.col("text"))).join(small, ["h1", "h2"])
    firsts = rows.groupBy("h1", "h2", "salts", "text").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select("h1", "h2", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    a = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.col("salts")).cast("int")).alias("a")
    b = firsts.alias("b")
    same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & (F.col("a.salt") == F.col("b.salt"))
    found = a.join(b, same & (F.col("a.text") == F.col("b.text")) & (F.col("b.first") < F.col("a.doc_id")), "left_semi")
    return found.select("doc_id", "part", "h1", "h2")


def combinations(failed: DataFrame, marked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: documents of each part by the exact set of filters they fail."""
    key = ["doc_id", "part", "h1", "h2"]
    each = failed.groupBy(*key, "bits").agg(F.count("*").alias("n"))
    ids = each.unionByName(marked.select(*key, F.lit(16).alias("bits"), F.lit(0).cast("bigint").alias("n")))
    whole = ids.groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    whole = whole.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    said = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    # Null ids would meet in one task of the join; they have no label.
    told = whole.filter("doc_id is not null").join(said, "doc_id", "left")
    rest = whole.filter("doc_id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    counted = told.unionByName(rest).groupBy("part", "bits")
    return counted.agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order of the filters and step, from the combinations of the part."""
    rounds = factorial(len(letters))
    steps = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append(("".join(order), step, bit, before))
            before |= bit
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(m).alias("before")) for o, s, b, m in steps])
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("sets"))  # at most 32 each
    rows = parts.select("part", "sets", F.explode(plan).alias("p")).select("part", "sets", "p.*")
    bit, before = F.col("bit"), F.col("before")

    def total(value: str, holds) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate("sets", zero, lambda a, s: a + F.when(holds(s["bits"]), s[value]).otherwise(zero))

    def gone(bits: Column) -> Column:
        return (bits.bitwiseAND(bit) != 0) & (bits.bitwiseAND(before) == 0)

    def fails(bits: Column) -> Column:
        return bits.bitwiseAND(bit) != 0

    # Of the orders, one in k has this filter before the k - 1 others that the combination fails.
    first = F.array(*[F.lit(rounds // max(1, k)).cast("bigint") for k in range(len(letters) + 1)])
    share = F.aggregate("sets", F.lit(0).cast("bigint"), lambda a, s: a + F.when(
        fails(s["bits"]), F.get(first, F.bit_count(s["bits"])) * s["n"]).otherwise(F.lit(0).cast("bigint")))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda bits: bits.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", gone).alias("removed"),
        total("n", lambda bits: fails(bits) & (bits.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda bits: bits == bit).alias("unique_fails"),
        total("good", gone).alias("good_lost"), total("toxic", gone).alias("toxic_lost"), share.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source", **how) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    failed = written(failures(docs, doc_id, text, part), "failures")
    marked = repeated(docs, failed, doc_id, text, part, **how)
    return orders(written(combinations(failed, marked, labels), "combinations"))
