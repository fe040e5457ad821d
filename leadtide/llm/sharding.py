"""Sharding along a Hilbert curve, in DataFrame functions only.

Three columns of a document (language, source and size of the text) are quantised to 16 bins each.
Bins are cut at equal ranks of the whole table, by prefix sums over the counts of distinct values, so
that skewed columns use all bins and a bin is a range of values. The cell of a document has an index on
the Hilbert curve of the cube: cells next to each other on the curve differ by one bin of one column.
Documents are ordered by that index, inside a cell by the three values, id and checksum, and runs of
the order are the shards. So a shard is a compact block in all three columns at once, and the ranges
in its files' statistics prune by any of them.

Law: ``rows``. Shard s of n holds the ranks from ceil(s N / n) on; shard sizes differ by one row at most.

Ranks come from range partitions of the order: places inside a partition, then the sum of earlier
partitions. Equal rows are told apart by a number of their own, so neither a hot source nor a group of
copies lands in one task. The text is read once for size and checksum and is not shuffled, unless
``carry`` asks for it. Null text has no bytes and checksum 0; nulls of a column come before its values;
null and repeated ids are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtide.llm.common import unused, written

SHARDS = 8
#: Bits of a column's bin.
BITS = 4
_PLACE = (1 << 33) - 1


def hilbert(cell: tuple[int, ...], bits: int = BITS) -> int:
    """The place of a cell on the Hilbert curve of a cube with 2 ** bits cells a side."""
    x, n = list(cell), len(cell)
    for b in range(bits - 1, 0, -1):  # undo the turns of each level
        q = 1 << b
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = 0
    for b in range(bits - 1, 0, -1):
        if x[n - 1] & (1 << b):
            t ^= (1 << b) - 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v ^ t) >> b & 1
    return out


def running(df: DataFrame, order: list[Column], weight: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows before a row in ``order``, which must order all rows.

    Rows are dealt by ranges; a range only needs the sum of the ranges before it.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("*", weight.cast("bigint").alias("r_weight"), F.monotonically_increasing_id().alias("r_at"))
    dealt = written(dealt.withColumn("r_part", F.shiftright("r_at", 33)), "ranges")
    inside = Window.partitionBy("r_part").orderBy("r_at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(F.lit(0)).orderBy("r_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("r_part").agg(F.sum("r_weight").alias("r_sum"))  # a row per partition
    base = parts.select("r_part", F.coalesce(F.sum("r_sum").over(before), F.lit(0)).alias("r_base"))
    out = dealt.withColumn("r_inside", F.coalesce(F.sum("r_weight").over(inside), F.lit(0)))
    out = out.join(F.broadcast(base), "r_part")  # bounded by the number of partitions
    return out.select(*df.columns, (F.col("r_base") + F.col("r_inside")).alias(name))


def ranks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the number of rows before a row: no sum is needed inside a range."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("r_at", F.monotonically_increasing_id())
    dealt = written(dealt, "ranks").withColumn("r_part", F.shiftright("r_at", 33))
    before = Window.partitionBy(F.lit(0)).orderBy("r_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("r_part").agg(F.count("*").alias("r_n"))  # a row per partition
    base = parts.select("r_part", F.coalesce(F.sum("r_n").over(before), F.lit(0)).alias("r_base"))
    place = F.col("r_at").bitwiseAND(F.lit(_PLACE))
    return dealt.join(F.broadcast(base), "r_part").select(*df.columns, (F.col("r_base") + place).alias(name))


def cuts(df: DataFrame, column: str, bins: int = 1 << BITS) -> list:
    """The first value of each bin, at most ``bins`` of them; null, if it occurs, comes first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = df.count()
    before = running(counts, [F.col("value").asc_nulls_first()], F.col("n"), "before")
    of = F.lit(max(1, total)).cast("bigint")
    bins_of = before.withColumn("bin", F.call_function("div", F.col("before") * bins, of).cast("int"))
    first = bins_of.groupBy("bin").agg(F.min_by("value", "before").alias("value")).orderBy("bin")
    return [(r["bin"], r["value"]) for r in first.collect()]  # at most ``bins`` rows


def _bin(column: str, found: list, kind: str) -> Column:
    out = F.lit(0)
    for number, value in found:  # ascending, the last that holds decides
        holds = F.lit(True) if value is None else F.coalesce(F.col(column) >= F.lit(value).cast(kind), F.lit(False))
        out = F.when(holds, F.lit(number)).otherwise(out)
    return out


def shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    n_shards: int = SHARDS, bits: int = BITS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, lang, source, size, text_crc32, curve, shard, slot and the columns of ``carry`` as ``c_...``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"), F.crc32(whole).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").alias(f"c_{c}") for c in carry],
    )
    rows = written(rows, "sizes")
    dims = ["lang", "source", "size"]
    kinds = dict(rows.dtypes)
    cell = F.lit(0)
    for d in dims:
        cell = cell * (1 << bits) + _bin(d, cuts(rows, d, 1 << bits), kinds[d])
    # The curve of all cells, 4,096 numbers, is a constant of the plan.
    curve = F.array(*[F.lit(hilbert(c, bits)) for c in product(range(1 << bits), repeat=len(dims))])
    rows = rows.withColumn("curve", F.get(curve, cell))
    total = rows.count()
    order = [F.col(c).asc_nulls_first() for c in ("curve", *dims, "doc_id", "text_crc32", "row")]
    n, of = F.lit(n_shards).cast("bigint"), F.lit(max(1, total)).cast("bigint")
    placed = ranks(rows, order, "rank").withColumn("shard", F.call_function("div", F.col("rank") * n, of).cast("int"))
    start = F.call_function("div", F.col("shard") * of + n - 1, n)
    return placed.withColumn("slot", F.col("rank") - start).drop("rank", "row")


def write_shards(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", **how) -> None:
    """Write all columns of ``docs`` as Parquet below ``folder``: a folder for each shard, rows by slot.

    The folders are named by column ``shard`` (with underscores before it if ``docs`` has that name).
    """
    names = docs.columns
    shard, slot = unused(docs, "shard", "slot")
    placed = shards(docs, doc_id, text, carry=tuple(names), **how)
    rows = placed.select(*[F.col(f"`c_{c}`").alias(c) for c in names], F.col("shard").alias(shard), F.col("slot").alias(slot))
    rows.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
