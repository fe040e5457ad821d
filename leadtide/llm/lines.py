"""Line dedup by distinct-site spread, in DataFrame functions only.

A line is its text without white space at both ends; lines without any text are left alone. Every
line hash gets a HyperLogLog sketch of the sites that have the line; sketches are built in each task
and merged by aggregation. A line whose estimate lies near the threshold, closer than the sketch's
error allows to tell, gets an exact distinct count. Lines on ``sites`` or more sites are boilerplate
and are removed from every document.

Lines are named by two independent 64-bit hashes. Only hashes are shuffled to count; a line that a
third of all documents have is combined in each task, and its occurrences are salted before they
meet their verdict. A document's removed hashes then join its text, keyed by a hash of id and text:
rows that share the key get the union, which is still a set of boilerplate lines. Null text stays
null; a null site is no site; null and repeated ids are kept; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.llm.common import row_key, written

SITES = 10
#: Registers of a sketch, as a power of two, and the standard errors that count as near.
REGISTERS = 12
NEAR = 4.0
SALTS = 16
BLANK = " \t\r\x0b\x0c"


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _name(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def occurrences(docs: DataFrame, text: str, site: str, key: Column) -> DataFrame:
    """row, site, h1, h2: each distinct line of each document."""
    lines = F.array_distinct(F.transform(F.split(F.col(text), "\n"), lambda s: _stripped(s)))
    named = F.transform(F.filter(lines, lambda s: s != ""), lambda s: _name(s))
    rows = docs.select(key.alias("row"), F.col(site).cast("string").alias("site"), F.explode(named).alias("line"))
    return rows.select("row", "site", "line.h1", "line.h2")


def boilerplate(found: DataFrame, sites: int = SITES, registers: int = REGISTERS) -> DataFrame:
    """h1, h2 of the lines on ``sites`` or more sites."""
    near = max(1.0, NEAR * 1.04 / sqrt(1 << registers) * sites)
    spread = found.filter("site is not null").groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(registers))).alias("about")
    )
    spread = written(spread.filter(F.col("about") >= sites - near), "spread")
    sure = spread.filter(F.col("about") > sites + near).select("h1", "h2")
    asked = spread.filter(F.col("about") <= sites + near).select("h1", "h2")
    pairs = _salted(found, asked).filter("site is not null").select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("h1", "h2")
    return sure.unionByName(exact)


def _salted(found: DataFrame, lines: DataFrame) -> DataFrame:
    """The occurrences of ``lines``, a line's occurrences dealt over ``SALTS`` partitions."""
    many = lines.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return found.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(many, ["h1", "h2", "salt"]).drop("salt")


def drop_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES, registers: int = REGISTERS
) -> DataFrame:
    """One row per document: doc_id, text without boilerplate lines, n_lines, n_removed."""
    key = row_key(doc_id, text)
    found = occurrences(docs, text, site, key)
    lines = written(boilerplate(found, sites, registers), "boilerplate")
    gone = _salted(found, lines).groupBy("row").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("row")).join(gone, "row", "left")
    split = F.split("text", "\n")
    none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    kept = F.when(F.col("gone").isNull(), split).otherwise(
        F.filter(split, lambda s: (_stripped(s) == "") | ~F.array_contains(F.coalesce("gone", none), _name(_stripped(s))))
    )
    cut = rows.select("doc_id", split.alias("all"), kept.alias("left"))
    return cut.select(
        "doc_id",
        F.array_join("left", "\n").alias("text"),
        F.coalesce(F.size("all"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("all") - F.size("left"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
