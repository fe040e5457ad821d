"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

A source's documents, in the order of a hash of their ids, form blocks of about ``block`` code
points; its weight is a whole number of shares. Time runs in periods of as many slots as the active
sources have shares together. In a period with H slots, block j of a source with s shares is
released at floor(j H / s) and due at ceil((j + 1) H / s). Each slot goes to the released block with
the earliest deadline, ties by source. So every block runs in its window and no source is ever a
whole block ahead of or behind its share. A source that runs dry leaves the active set, and the
other weights hold among themselves; no document is dropped or repeated.

The schedule is a table of blocks, so any number of sources has one. Sources of one share are ranked in
each phase of one active set; blocks of sources with more shares, which only ``shares`` can name, are
placed one by one, and MOST_SLOTS bounds their shares, never the sources.
Prefix sums within a source are taken in two steps: sums by bucket of the hash, then within each
bucket, and a source has as many buckets as its size asks for. So no source, however large, is
ordered in one task. Null text counts as empty, a null source is a source of its own, null and
repeated ids are kept, an empty table gives no rows, other columns pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtide.llm.common import let, unused, written

BLOCK = 50_000
#: Shares of the production mix; sources that it does not name have one share.
SHARES = {"src0": 4}
#: Code points of one bucket, the part of a source that one task orders.
BUCKET = 4_000_000
#: Bound of the shares of all sources with more than one.
MOST_SLOTS = 200_000


def _ceil(a: Column, b: Column) -> Column:
    return F.ceil(a / b).cast("bigint")


def _share(source: Column, shares: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, n in shares.items():
        out = F.when(source == name, n).otherwise(out)
    return out.cast("bigint")


def _free(taken: Column, start: Column) -> Column:
    """The first slot from ``start`` on that is not in the ascending ``taken``."""
    return F.aggregate(taken, start, lambda at, x: F.when(x == at, at + 1).otherwise(at))


def _nth_free(taken: Column, n: Column) -> Column:
    """The slot that ``n`` slots outside the ascending ``taken`` come before."""
    return F.aggregate(taken, n, lambda at, x: F.when(x <= at, at + 1).otherwise(at))


def schedule(sizes: DataFrame) -> DataFrame:
    """key, block, slot, release, deadline: a row per block.

    ``sizes`` has (s_key, share, blocks), a row per source. Unit jobs that each take, earliest deadline
    first, the first free slot from their release on run exactly as the slots would choose them. All
    sources of one share have the window of the whole period and so come last, in their order; they
    only need their rank. Only the few blocks of sources with more shares are placed one by one.
    """
    zero = F.lit(0).cast("bigint")
    lives = sizes.withColumn("life", _ceil(F.col("blocks"), F.col("share")))
    # Phases of one active set: a row per distinct life, at most about the root of twice the blocks.
    steps = Window.partitionBy(F.lit(0)).orderBy("to_period")
    ends = lives.select(F.col("life").alias("to_period")).distinct().select(
        "to_period", F.lag("to_period", 1, 0).over(steps).alias("from_period"), F.row_number().over(steps).alias("phase")
    )
    # A source has a row per phase that it lives in, at most one a block.
    alive = lives.join(ends.select(F.col("to_period").alias("life"), F.col("phase").alias("last")), "life")
    alive = alive.select("s_key", "share", "blocks", F.explode(F.sequence(F.lit(1), "last")).alias("phase"))
    singles = Window.partitionBy("phase").orderBy("s_key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("share") == 1, 1).otherwise(0)).over(singles), zero)
    alive = alive.withColumn("before", before.cast("bigint"))

    many = F.when(F.col("share") > 1, F.struct("s_key", "share", "blocks", "before"))
    phases = alive.groupBy("phase").agg(F.sum("share").alias("slots"), F.collect_list(many).alias("many")).join(ends, "phase")
    size = (F.col("to_period") - F.col("from_period")) * F.col("slots")
    order = Window.partitionBy(F.lit(0)).orderBy("from_period").rowsBetween(Window.unboundedPreceding, -1)
    phases = phases.withColumn("base", F.coalesce(F.sum(size).over(order), zero).cast("bigint"))

    def job(m: Column, j: Column) -> Column:
        return F.struct(
            _ceil((j + 1) * F.col("slots"), m["share"]).alias("deadline"), m["s_key"].alias("s_key"), j.alias("j"),
            F.floor(j * F.col("slots") / m["share"]).cast("bigint").alias("release"),
            m["before"].alias("before"), m["share"].alias("share"), m["blocks"].alias("blocks"),
        )

    def place(state: Column, b: Column) -> Column:
        # At the last deadline the singles of smaller keys have run already.
        after = F.when(b["deadline"] == F.col("slots"), _nth_free(state["taken"], b["before"])).otherwise(zero)
        return let(_free(state["taken"], F.greatest(b["release"], after)), lambda slot: F.struct(
            F.array_sort(F.concat(state["taken"], F.array(slot))).alias("taken"),
            F.concat(state["run"], F.array(slot)).alias("run")))

    jobs = F.flatten(F.transform("many", lambda m: F.transform(F.sequence(zero, m["share"] - 1), lambda j: job(m, j))))
    none = F.array().cast("array<bigint>")
    phases = phases.withColumn("jobs", F.array_sort(jobs)).withColumn(
        "state", F.aggregate("jobs", F.struct(none.alias("taken"), none.alias("run")), place)
    )
    phases = written(phases.select("phase", "from_period", "to_period", "slots", "base", "jobs", "state"), "phases")
    front = ["from_period", "to_period", "slots", "base"]
    picked = phases.select(*front, F.explode(F.arrays_zip("jobs", F.col("state.run").alias("run"))).alias("z")).select(
        *front, "z.jobs.s_key", "z.jobs.share", "z.jobs.blocks", "z.jobs.j", F.col("z.run").alias("at"), "z.jobs.release", "z.jobs.deadline"
    )
    single = alive.filter("share = 1").join(phases.select("phase", *front, "state.taken"), "phase").select(
        *front, "s_key", "share", "blocks", zero.alias("j"), _nth_free(F.col("taken"), F.col("before")).alias("at"),
        zero.alias("release"), F.col("slots").alias("deadline"),
    )
    rows = picked.unionByName(single).withColumn("period", F.explode(F.sequence("from_period", F.col("to_period") - 1)))
    start = F.col("base") + (F.col("period") - F.col("from_period")) * F.col("slots")
    return rows.withColumn("block", F.col("period") * F.col("share") + F.col("j")).filter("block < blocks").select(
        F.col("s_key").alias("key"), "block", (start + F.col("at")).alias("slot"),
        (start + F.col("release")).alias("release"), (start + F.col("deadline")).alias("deadline"),
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", shares: dict[str, int] | None = None,
    block: int = BLOCK, bucket: int = BUCKET,
) -> DataFrame:
    """All rows and columns with, last, their block, its slot, release and deadline, and their place in the source.

    ``place`` is the code points of the source before the row. Ordering by slot, then place, gives the
    mix. A name that ``docs`` has already gets an underscore before it.
    """
    names = unused(docs, "block", "slot", "release", "deadline", "place")
    h, size, key, part, inside = unused(docs, "m_h", "m_size", "m_key", "m_part", "m_inside")
    name = F.col(source).cast("string")
    wide = docs.withColumns({
        h: F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint"),
        size: F.coalesce(F.length(text), F.lit(0)).cast("bigint"),
        key: F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)),
    })
    sizes = wide.groupBy(F.col(key).alias("s_key")).agg(F.max(name).alias("source"), F.sum(size).alias("total"))
    sizes = sizes.withColumn("share", _share(F.col("source"), SHARES if shares is None else shares))
    sizes = sizes.withColumn("blocks", F.greatest(F.lit(1).cast("bigint"), _ceil(F.col("total"), F.lit(block))))
    sizes = written(sizes.withColumn("parts", _ceil(F.col("total") + 1, F.lit(bucket))), "sources")
    slots = sizes.filter("share > 1").agg(F.sum("share")).first()[0] or 0
    if slots > MOST_SLOTS:
        raise ValueError(f"named sources with {slots} shares need a schedule of more than {MOST_SLOTS} slots; lower the shares")
    rows = wide.join(sizes.select("s_key", "share", "blocks", "parts"), F.col(key) == F.col("s_key")).drop("s_key")
    rows = rows.withColumn(part, F.floor(F.col(h) * F.col("parts") / F.lit(1 << 32)).cast("bigint")).drop("parts")

    sums = rows.groupBy(F.col(key).alias("p_key"), F.col(part).alias("p_part")).agg(F.sum(size).alias("sum"))
    before = Window.partitionBy("p_key").orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("p_key", "p_part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("p_base"))
    order = Window.partitionBy(key, part).orderBy(h, F.col(doc_id).asc_nulls_last(), F.xxhash64(text)).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(inside, F.coalesce(F.sum(size).over(order), F.lit(0)))
    placed = placed.join(sums, (F.col(key) == F.col("p_key")) & (F.col(part) == F.col("p_part")))
    placed = placed.withColumn(names[4], F.col("p_base") + F.col(inside))
    placed = placed.withColumn(names[0], F.least(F.floor(F.col(names[4]) / F.lit(block)).cast("bigint"), F.col("blocks") - 1))

    plan = schedule(sizes)
    plan = written(plan.select(*[F.col(c).alias(f"w_{c}") for c in plan.columns]), "plan")  # a row per block
    out = placed.join(plan, (F.col(key) == F.col("w_key")) & (F.col(names[0]) == F.col("w_block")))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(
        *own, names[0], F.col("w_slot").alias(names[1]), F.col("w_release").alias(names[2]),
        F.col("w_deadline").alias(names[3]), names[4],
    )


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in the order of the mix, with their own columns only.

    Rows at one place are ordered too, so that only equal ids and texts can change places.
    """
    mixed = mix(docs, doc_id, text, **how)
    slot, place = mixed.columns[-4], mixed.columns[-1]
    return mixed.orderBy(slot, place, F.col(doc_id).asc_nulls_last(), F.xxhash64(text)).select(*[F.col(f"`{c}`") for c in docs.columns])
