"""Secret scans by a trigram index, in DataFrame functions only.

Every rule is a regular expression. ``trigram_query`` derives from it an OR of ANDs of three-letter
strings that each match must contain. ``postings`` lists, for the trigrams that the rules ask for,
the rows that contain them; ``candidates`` intersects the lists of each AND. Only candidates are
verified by the expression itself. A rule from which no trigram follows is run over every text.

The index is in lower case, so it holds more rows than needed, never fewer. Intersecting groups by
row, not by trigram, so a trigram that every text has makes no task larger than another. Rows are
named by a 64-bit hash of id and text: rows that share it verify together, which costs nothing but
time. Texts are verified whole, however long. Null text counts as empty; null and repeated ids are kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.llm.common import let, row_key


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if their ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
#: More alternatives than this are not worth asking for: the rule scans fully.
MOST_CLAUSES = 64
#: A class of at most so many characters is written out.
SMALL_CLASS = 8

_Ways = set[tuple[frozenset[str], str]]


def _pruned(ways: _Ways) -> _Ways:
    """Without ways that ask for more than another one with the same tail."""
    return {(t, tail) for t, tail in ways if not any(o < t and tail == x for o, x in ways)}


def _characters(parsed) -> list[str] | None:
    """The characters of a small class in lower case."""
    out: set[str] = set()
    for op, arg in parsed:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < SMALL_CLASS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return sorted(out) if len(out) <= SMALL_CLASS else None


def _after(parsed, ways: _Ways) -> _Ways:
    """The ways to match so far, each as the trigrams it must contain and its last fixed letters, two at most."""

    def then(ways: _Ways, letter: str) -> _Ways:
        out = set()
        for trigrams, tail in ways:
            run = tail + letter
            out.add((trigrams | {run}, run[1:]) if len(run) == 3 else (trigrams, run))
        return out

    def broken(ways: _Ways) -> _Ways:
        return {(trigrams, "") for trigrams, _ in ways}

    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            ways = then(ways, chr(arg).lower())
        elif name == "IN" and (letters := _characters(arg)):
            ways = set().union(*(then(ways, c) for c in letters))
        elif name == "SUBPATTERN":
            ways = _after(arg[3], ways)
        elif name == "BRANCH":
            ways = set().union(*(_after(branch, ways) for branch in arg[1]))
        elif name == "MAX_REPEAT" and tuple(arg[:2]) == (0, 1):
            ways = ways | _after(arg[2], ways)
        elif name == "MAX_REPEAT" and arg[0] >= 1:
            for _ in range(min(arg[0], 3)):
                ways = _after(arg[2], ways)
            ways = ways if arg[0] == arg[1] <= 3 else broken(ways)
        elif name != "AT":
            ways = broken(ways)
        ways = _pruned(ways)
        if len(ways) > MOST_CLAUSES:
            ways = _pruned(broken(ways))
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of lower-case trigrams that every match contains; None if none is mandatory."""
    clauses = {trigrams for trigrams, _ in _after(re._parser.parse(pattern), {(frozenset(), "")})}
    if not all(clauses) or len(clauses) > MOST_CLAUSES:
        return None
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], key: Column, text: str = "text") -> DataFrame:
    """trigram, row: which rows contain which of ``trigrams``."""
    has = let(F.lower(F.coalesce(F.col(text), F.lit(""))), lambda low: F.array(*[F.when(F.contains(low, F.lit(g)), g) for g in trigrams]))
    return docs.select(key.alias("row"), F.explode(F.array_compact(has)).alias("trigram"))


def candidates(posted: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """row, kinds: the rules of which some AND is complete among the row's trigrams."""
    clauses = [(kind, i, sorted(c)) for kind, cs in queries.items() for i, c in enumerate(cs)]
    asked = [F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("clause"), F.lit(g).alias("asked"), F.lit(1 << j).alias("bit"),
                      F.lit((1 << len(c)) - 1).alias("all")) for kind, i, c in clauses for j, g in enumerate(c)]
    # As many rows as the rules have trigrams: a proven bound.
    asks = F.broadcast(docs_of(posted).select(F.inline(F.array(*asked))))
    met = posted.join(asks, F.col("trigram") == F.col("asked")).groupBy("row", "kind", "clause")
    met = met.agg(F.bit_or("bit").alias("has"), F.first("all").alias("all")).filter("has = all")
    return met.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def docs_of(df: DataFrame) -> DataFrame:
    """A frame of one row, to build constants on."""
    return df.sparkSession.range(1)


def spans(text: Column, rule: Rule, place: int) -> Column:
    """Matches as structs (start, place, end) in code points; leftmost, not overlapping.

    The pieces between matches and the matches themselves, laid end to end, give the offsets.
    """
    kind = "array<struct<start:int,place:int,end:int>>"
    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("part"),
    )

    def walk(p: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(p["between"][i])
            end = start + F.length(p["match"][i])
            one = F.array(F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end")))
            found = F.when(F.length(p["part"][i]) >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"])
            return F.struct(end.alias("at"), found.alias("found"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))
        return F.aggregate(F.sequence(F.lit(0), F.size(p["match"]) - 1), zero, step, lambda acc: acc["found"])

    return F.when(text.rlike(rule.pattern), let(parts, walk)).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, found: the matches of all rules in each text by start, then rule as listed.

    ``found`` holds structs (start, place, end), ``place`` counting the rules from 1.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    wanted = sorted({g for q in queries.values() for c in q for g in c})
    key = row_key("doc_id", "text")
    if wanted:
        near = candidates(postings(narrow, wanted, key), queries)
        rows = narrow.withColumn("row", key).join(near, "row", "left")
    else:
        rows = narrow.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    each = []
    for place, rule in enumerate(rules, 1):
        own = spans(F.col("text"), rule, place)
        each.append(F.when(F.array_contains("kinds", rule.kind), own).otherwise(none) if rule.kind in queries else own)
    return rows.select("doc_id", F.array_sort(reduce(F.concat, each)).alias("found"))


def digests(found: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE)) -> DataFrame:
    """doc_id, a count for each base rule, base_sha256 and spans."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def said(col: Column) -> Column:
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", kinds[s["place"] - 1], s["start"], s["end"])), ",")

    def count(place: int) -> Column:
        return F.size(F.filter("found", lambda s: s["place"] == place)).cast("bigint")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(rules[:base], 1)]
    own = said(F.filter("found", lambda s: s["place"] <= base))
    return found.select("doc_id", *counts, F.sha2(own, 256).alias("base_sha256"), said(F.col("found")).alias("spans"))
