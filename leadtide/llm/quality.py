"""Quality rules with host-level verdicts, in DataFrame functions only.

``measures`` looks at each text once. ``host_rates`` counts rule failures by host and shrinks each
rate towards what hosts have in common: a beta prior fitted to the rates by moments, so a host with
few documents needs more evidence. ``verdicts`` joins the rejected hosts back to the documents.

Texts are never shuffled; the measures of a document are a table of a few numbers. Counting by host
combines in each task first; the join by host moves numbers only, and a host of any size is split by
the adaptive join. Null text counts as empty, a null host is a host of its own, repeated rows count
as often as they occur, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.llm.common import let, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: A document fails a rule if its expression over the measures holds.
RULES = {
    "base": "base_failed",
    "symbols": "n_symbols * 10 > n_words",
    "lines": "n_dup_lines * 3 > n_lines",
    "length": "word_chars > 12 * n_words or word_chars < 2 * n_words",
}
#: A host is rejected if its shrunk rate of a rule is above this.
MOST_FAILING = 0.5


def _covered(places: Column) -> Column:
    """Words that three-word windows at the ascending ``places`` cover."""
    step = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
    return F.aggregate(step, F.lit(0), lambda a, b: a + b)


def _places(hashes: Column) -> Column:
    """Ascending places of those windows that occur more than once."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(ordered, lambda s: F.array_sort(F.filter(F.transform(s, lambda e, j: F.when(
        (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]), e["i"])), lambda p: p.isNotNull())))


def repeated_words(words: Column) -> Column:
    """How many of ``words`` lie in three-word windows that the text has twice or more."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    some = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), 0).otherwise(let(_places(hs), _covered)))
    return F.when(n < 4, 0).otherwise(some)


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words, lambda ws: F.struct(
        F.size(ws).alias("n"), F.length(F.array_join(ws, "")).alias("chars"), repeated_words(ws).alias("repeated")))
    of_lines = let(lines, lambda ls: F.struct(
        F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")))
    out = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), of_words.alias("w"), of_lines.alias("l"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    out = out.select(
        "doc_id", "host", F.col("w.n").cast("bigint").alias("n_words"), F.col("w.chars").cast("bigint").alias("word_chars"),
        "n_symbols", F.col("l.n").cast("bigint").alias("n_lines"), F.col("l.dup").cast("bigint").alias("n_dup_lines"),
        F.col("w.repeated").cast("bigint").alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def host_rates(measured: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """host, rule, n, failed, rate, shrunk: shrunk is the posterior mean under the rule's beta prior."""
    rules = RULES if rules is None else rules
    counted = measured.groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(e)).alias(f"r_{r}") for r, e in rules.items()]
    )
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"r_{r}").alias("failed")) for r in rules]))
    rates = counted.select("host", "n", each.alias("e")).select(
        "host", "n", "e.rule", "e.failed", (F.col("e.failed") / F.col("n")).alias("rate")
    )
    m, v = F.avg("rate"), F.var_pop("rate")
    strength = F.when(v > 0, m * (1 - m) / v - 1).otherwise(1.0)
    prior = rates.groupBy("rule").agg((m * strength).alias("alpha"), strength.alias("strength"))
    # As many rows as rules: a proven bound.
    return rates.join(F.broadcast(prior), "rule").select(
        "host", "rule", "n", "failed", "rate",
        ((F.col("failed") + F.col("alpha")) / (F.col("n") + F.col("strength"))).alias("shrunk"),
    )


def verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", most: float = MOST_FAILING
) -> DataFrame:
    """The measures of each document with host_rejected and kept."""
    measured = written(measures(docs, doc_id, text, host), "measures")
    rejected = host_rates(measured).groupBy(F.col("host").alias("of_host")).agg(F.max(F.col("shrunk") > most).alias("host_rejected"))
    joined = measured.join(rejected, F.col("host").eqNullSafe(F.col("of_host")), "left").drop("of_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
