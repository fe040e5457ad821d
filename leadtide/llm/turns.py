"""Conversation structure repair by Wagner-Fischer alignment to the grammar's strings.

A conversation should read ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn.
The feasible target strings are alternating strings of every length, with or without the system turn,
so all targets that end alike are suffixes of one string: one Wagner-Fischer table, filled from the
end, holds the cost of aligning the rows from i on to the last j characters for every j. An incumbent
(straight alignment with at most one insertion or deletion, or all truncated rows deleted) gives a
cost bound U, and Ukkonen's band drops the cells that need more than U / 2 deletions or U / 5
insertions. Lengths that tie in cost are told apart by their backtraced audits: the trace takes the
ASCII-least letter that stays optimal. Rows that must be deleted cost the same in every alignment;
they are left out of the tables and woven in again at once after the row before them.

A conversation of any length is cut into blocks of ``2 ** BLOCK`` rows. A block gives the best cost and
audit from each state of the grammar (start, after s, u, a) to each other one; insertions stand before
rows, so audits of a block are never prefixes of each other and the least of each pair is enough.
Blocks are aligned in their own tasks and chained from the end, state by state.

Spark sorts small rows (no texts) by conversation and turn over range partitions, so that a
conversation with a third of all rows is sorted by many tasks; the first occurrence of a text is a
minimum by aggregation, joined back by row number. Texts are shuffled once, for the digest of the
repaired conversation, and streamed through it: a task holds one text and one audit. An audit has as
many letters as its conversation has rows, and the digest of one conversation is one stream; both are
so by contract.

Nulls: a null role or text is one space, a null turn comes first, a null conv_id is a conversation of
its own; rows of one turn are taken by role, then a hash of the text, equal rows side by side. A role
counts by its first character; another than s, u, a is never kept. Conversations without rows after
damage have zeros and the digest of the empty string; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.llm.arrays import bounded
from leadtide.llm.common import WHITE, written

#: Fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT = 1, 2, 3
INITIALS = "sua"
#: Rows of a block, as a power of two, and cells of the tables that one task holds at a time.
BLOCK = 9
CELLS = 4_000_000
#: Rows that one task aligns.
TASK_ROWS = 100_000
#: States: start, after s, after u, after a. What follows a state: u, except after u.
START, S, U, A = range(4)
_FAR = np.int32(1 << 28)


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after damage; a dropped row is still there, marked."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(named) % 20
    whole = F.coalesce(F.col(text), space)
    out = rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(whole, ".!?", "")).otherwise(whole).alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return out.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")


def as_they_are(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns without damage."""
    space = F.lit(" ")
    return rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"), F.lit(False).alias("gone"),
    )


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2")]


def _hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2")]


def coded(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, block, at, turn, code: rows with their place, dealt by block; code is four times the place of the initial in
    ``INITIALS`` (3 for others) plus the fault."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE.decode())), -1, 1)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.length("role") == 0) | (initial == 0), 3).otherwise(initial - 1)
    fault = F.when(last == "", BLANK_FAULT).when(~last.isin(".", "!", "?"), TRUNCATED_FAULT).otherwise(0)
    small = rows.filter("not gone").select("conv_id", "turn", "role", *_hashes(), initial.alias("initial"), fault.alias("fault"))
    small = written(small, "turns")
    dealt = small.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    dealt = written(dealt.drop("role").withColumn("at", F.monotonically_increasing_id()), "order")
    first = dealt.groupBy("conv_id", "h1", "h2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    told = dealt.join(first, "at", "left")
    fault = F.when(F.col("fault") == BLANK_FAULT, BLANK_FAULT).when(F.col("first").isNull(), DUPLICATE_FAULT).otherwise(F.col("fault"))
    codes = told.select("conv_id", F.shiftright("at", block).alias("block"), "at", "turn", (4 * F.col("initial") + fault).alias("code"))
    # Rows of a few bytes that take long: a set number of tasks, or the adaptive plan puts all into one.
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-dealt.count() // TASK_ROWS))
    return codes.repartition(tasks, "conv_id", "block")


# The alignment of one block


def _char(end: int, j: np.ndarray) -> np.ndarray:
    """Place in INITIALS of the first of the last j characters of a target that ends in state ``end``."""
    return np.where(j % 2 == 1, end - 1, 3 - (end - 1))


class Tables:
    """Costs of aligning the rows from i on to the last j characters, for blocks of ``m`` rows each.

    ``initials`` and ``cut`` (truncated) are arrays of blocks by rows without must-deletes. Cell
    [i][block][d - low] is for j = m - i + d.
    """

    def __init__(self, initials: np.ndarray, cut: np.ndarray, end: int):
        n, m = initials.shape
        self.m, self.end = m, end
        self.keep = TRUNCATED * cut.astype(np.int32)
        self.initials = initials
        bound = self._incumbent()
        self.low, self.high = -int(min(m, bound // DELETE)), int(bound // INSERT)
        width = self.high - self.low + 1
        d = np.arange(self.low, self.high + 1)
        self.cells = np.full((m + 1, n, width), _FAR, np.int32)
        self.cells[m, :, -self.low] = 0  # no insertion after the last row of a block
        slope = INSERT * np.arange(width, dtype=np.int32)
        for i in range(m - 1, -1, -1):
            below = self.cells[i + 1]
            j = m - i + d
            here = below + self.match(i, j)
            here[:, j < 1] = _FAR
            if width > 1:
                here[:, :-1] = np.minimum(here[:, :-1], below[:, 1:] + DELETE)
            here[:, j < 0] = _FAR
            here = np.minimum.accumulate(here - slope, axis=1) + slope  # insertions
            self.cells[i] = np.minimum(here, _FAR)

    def match(self, i: int, j: np.ndarray) -> np.ndarray:
        """Blocks by cells: the cost of keeping row i as, or turning it into, the target's character."""
        return self.keep[:, i, None] + REROLE * (self.initials[:, i, None] != _char(self.end, j)[None, :])

    def _incumbent(self) -> int:
        """A cost that no block exceeds from any state: the best of alignments without search."""
        n, m = self.initials.shape
        if not m:
            return 0
        place = np.arange(m)
        straight = [  # the rows as an alternating string that starts with u, with a
            (self.initials != np.where((place + first) % 2 == 0, 1, 2)[None, :]) * REROLE for first in (0, 1)
        ]
        rough = np.maximum(*[x.sum(axis=1) for x in straight]) + self.keep.sum(axis=1) + INSERT
        # Truncated rows deleted, the others straight.
        kept = self.keep == 0
        rank = np.cumsum(kept, axis=1) - 1
        odd = [(kept & (self.initials != np.where((rank + first) % 2 == 0, 1, 2))).sum(axis=1) * REROLE for first in (0, 1)]
        few = np.maximum(*odd) + DELETE * (~kept).sum(axis=1) + INSERT
        few = np.where(kept.any(axis=1), few, rough)  # an insertion needs a row after it
        return int(np.minimum(rough, few).max())

    def cost(self, block: int, i: int, j: int) -> int:
        d = j - (self.m - i)
        return int(self.cells[i, block, d - self.low]) if self.low <= d <= self.high and j >= 0 else int(_FAR)

    def trace(self, block: int, i: int, j: int) -> str:
        """The ASCII-least audit of the rows from i on among those of least cost for j characters."""
        out = []
        while i < self.m:
            here = self.cost(block, i, j)
            if self.cost(block, i + 1, j) + DELETE == here:
                out.append("D")
                i += 1
            elif j and self.cost(block, i, j - 1) + INSERT == here:
                out.append("I")
                j -= 1
            else:
                same = self.initials[block, i] == (self.end - 1 if j % 2 else 4 - self.end)
                out.append("K" if same else "R")
                i, j = i + 1, j - 1
        return "".join(out)

    def lengths(self, i: int, first: int) -> range:
        """Lengths in the band of targets for the rows from i on that start with character ``first``."""
        least = max(1, self.m - i + self.low)
        odd = 1 if first == self.end - 1 else 0
        return range(least + (least % 2 != odd), self.m - i + self.high + 1, 2)

    def best(self, block: int, i: int, first: int) -> tuple[int, str] | None:
        """Least cost and its ASCII-least audit over all target lengths of at least one character."""
        lengths = self.lengths(i, first)
        if not len(lengths):
            return None
        at = lengths.start - (self.m - i) - self.low
        costs = self.cells[i, block, at :: 2][: len(lengths)]
        least = int(costs.min())
        if least >= _FAR:
            return None
        return least, min(self.trace(block, i, lengths[k]) for k in np.flatnonzero(costs == least))


def _weave(audit: str, must: list[bool]) -> str:
    """An audit of the rows that may stay with a D for each row that must go, as early as its place allows."""
    if not any(must):
        return audit
    out, at = [], 0
    for gone in must:
        if gone:
            out.append("D")
            continue
        while audit[at] == "I":
            out.append("I")
            at += 1
        out.append(audit[at])
        at += 1
    return "".join(out)


def _block(u: Tables, a: Tables, k: int, must: list[bool]) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, audit) of block ``k`` of the tables that end in u and in a."""
    m, forced = u.m, DELETE * sum(must)
    found = {(p, p): (DELETE * m, "D" * m) for p in range(4)}

    def offer(p: int, q: int, what: tuple[int, str] | None) -> None:
        if what and ((p, q) not in found or what < found[p, q]):
            found[p, q] = what

    system = [i for i in range(m) if u.initials[k, i] == 0]
    for i in system:
        offer(START, S, (DELETE * (m - 1) + int(u.keep[k, i]), "D" * i + "K" + "D" * (m - 1 - i)))
    for q, table in ((U, u), (A, a)):
        after = table.best(k, 0, 1)
        for p in (START, S, A):
            offer(p, q, after)
        offer(U, q, table.best(k, 0, 2))
        # The system turn is a row that is kept; what stands before it is deleted.
        limit = found.get((START, q), (int(_FAR), ""))[0]
        for i in system:
            before = DELETE * i + int(u.keep[k, i])
            if before <= limit and (rest := table.best(k, i + 1, 1)):
                offer(START, q, (before + rest[0], "D" * i + "K" + rest[1]))
                limit = found[START, q][0]
    return [(p, q, cost + forced, _weave(audit, must)) for (p, q), (cost, audit) in found.items()]


def align(blocks: list[np.ndarray]) -> list[list[tuple[int, int, int, str]]]:
    """The state table of each block, given its codes in order. Blocks of one length share their tables."""
    out: list = [None] * len(blocks)
    alike = defaultdict(list)
    musts = []
    for k, codes in enumerate(blocks):
        fault = codes % 4
        must = (fault == BLANK_FAULT) | (fault == DUPLICATE_FAULT)
        musts.append(must.tolist())
        alike[int((~must).sum())].append((k, codes[~must]))
    for m, group in alike.items():
        # A table has at most m rows and about 4 m offsets.
        size = max(1, CELLS // ((m + 1) * (4 * m + 4)))
        for at in range(0, len(group), size):
            some = group[at : at + size]
            codes = np.array([c for _, c in some], np.int32).reshape(len(some), m)
            tables = [Tables(codes // 4, codes % 4 == TRUNCATED_FAULT, end) for end in (U, A)]
            for k, (place, _) in enumerate(some):
                out[place] = _block(*tables, k, musts[place])
    return out


_BLOCK = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("n", pa.list_(pa.int64())), ("illegal", pa.int64()), ("ends", pa.list_(pa.int32())),
    ("turns", pa.list_(pa.int64())), ("moves", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
_BLOCK_SQL = (
    "conv_id bigint, block bigint, n array<bigint>, illegal bigint, ends array<int>, turns array<bigint>, "
    "moves array<struct<p:int,q:int,cost:bigint,audit:string>>"
)


def _legal(x: int, y: int) -> bool:
    """Initials s u, u a or a u."""
    return (x, y) in ((0, 1), (1, 2), (2, 1))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: faults (1 to 3), illegal pairs, first and last initial, least, greatest and number of turns, state table."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            rows = batch.column("rows").to_pylist()
            codes = [np.array([r["code"] for r in b], np.int32) for b in rows]
            faults = [np.bincount(c % 4, minlength=4)[1:].tolist() for c in codes]
            initials = [(c // 4).tolist() for c in codes]
            turns = [[r["turn"] for r in b if r["turn"] is not None] for b in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id"), batch.column("block"), pa.array(faults, pa.list_(pa.int64())),
                pa.array([sum(not _legal(x, y) for x, y in zip(s, s[1:])) for s in initials], pa.int64()),
                pa.array([[s[0], s[-1]] for s in initials], pa.list_(pa.int32())),
                pa.array([[t[0], t[-1], len(set(t))] if t else [] for t in turns], pa.list_(pa.int64())),
                pa.array([[dict(p=p, q=q, cost=c, audit=x) for p, q, c, x in moves] for moves in align(codes)], _BLOCK.field("moves").type),
            ], schema=_BLOCK)


def chain(blocks: list[dict]) -> dict:
    """The verdict of a conversation from the summaries of its blocks in order."""
    best = {START: (0, ""), S: (2 * INSERT, "II"), U: (INSERT, "I"), A: (0, "")}
    for b in reversed(blocks):
        then: dict[int, tuple[int, str]] = {}
        for move in b["moves"]:
            end = best.get(move["q"])
            if end is None:
                continue
            cost = move["cost"] + end[0]
            if move["p"] not in then or cost <= then[move["p"]][0]:
                here = (cost, move["audit"] + end[1])
                if move["p"] not in then or here < then[move["p"]]:
                    then[move["p"]] = here
        best = then
    cost, audit = best[START]
    known = [b["turns"] for b in blocks if b["turns"]]
    distinct = sum(t[2] for t in known) - sum(x[1] == y[0] for x, y in zip(known, known[1:]))
    return {
        "gaps": known[-1][1] - known[0][0] + 1 - distinct if known else 0,
        "blank": sum(b["n"][0] for b in blocks), "duplicate": sum(b["n"][1] for b in blocks), "truncated": sum(b["n"][2] for b in blocks),
        "illegal": sum(b["illegal"] for b in blocks) + sum(not _legal(x["ends"][1], y["ends"][0]) for x, y in zip(blocks, blocks[1:])),
        "cost": cost, "audit": audit,
    }


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_VERDICT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])
_VERDICT_SQL = f"conv_id bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            out = [{"conv_id": i, **chain(b or [])} for i, b in zip(batch.column("conv_id").to_pylist(), batch.column("blocks").to_pylist())]
            yield pa.RecordBatch.from_pylist(out, schema=_VERDICT)


def verdicts(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of damaged rows."""
    each = coded(rows, block).groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("at", "code", "turn"))).alias("rows"))
    parts = each.mapInArrow(_summaries, _BLOCK_SQL)
    # Conversations whose rows were all dropped have no block.
    gone = rows.groupBy("conv_id").agg(F.bool_and("gone").alias("all")).filter("all").select("conv_id")
    held = F.struct("block", "n", "illegal", "ends", "turns", "moves")
    blocks = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(held)).alias("blocks"))
    return blocks.unionByName(gone, allowMissingColumns=True).mapInArrow(_chains, _VERDICT_SQL)


# The repaired conversation

_NEXT = {START: "user", S: "user", U: "assistant", A: "user"}
_STATE = {"s": S, "u": U, "a": A}


class Repair:
    """Applies an audit to the rows of a conversation, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insertions(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role = _NEXT[self.state]
            self.state = _STATE[role[0]]
            yield role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insertions()
        move = self.audit[self.at]
        self.at += 1
        if move == "D":
            return
        if move == "R":
            role = _NEXT[self.state]
        self.state = _STATE[role[0]]
        yield role, text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._insertions()


_DIGEST = pa.schema([*_VERDICT, ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, its verdict before its turns."""
    out: list[dict] = []
    verdict, repair, sha, any_row = None, None, None, False

    def feed(turns: Iterator[tuple[str, str]]) -> None:
        nonlocal any_row
        for role, text in turns:
            sha.update((("\n" if any_row else "") + role + ":").encode("utf-8", "surrogatepass"))
            sha.update(text.encode("utf-8", "surrogatepass"))
            any_row = True

    def close() -> None:
        if verdict is not None:
            feed(repair.end())
            out.append({**verdict, "repaired_sha256": sha.hexdigest()})

    for batch in (part for whole in batches for part in bounded(whole, whole.schema.get_field_index("text"))):
        for row in batch.to_pylist():
            if row["audit"] is not None:
                close()
                verdict = {c: row[c] for c in ("conv_id", *COUNTS, "audit")}
                repair, sha, any_row = Repair(row["audit"]), hashlib.sha256(), False
            else:
                feed(repair.row(row["role"], row["text"]))
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)
            out = []
    close()
    yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)


def _with_verdicts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Turns and verdicts of a conversation in one partition, in order, the verdict first."""
    turns = rows.filter("not gone").select("conv_id", "turn", "role", "text", *_hashes())
    both = turns.unionByName(found, allowMissingColumns=True).withColumn("later", F.col("audit").isNull())
    conv, *rest = _order()
    return both.repartition("conv_id").sortWithinPartitions(conv, "later", *rest).drop("h1", "h2", "later")


def repair_digests(rows: DataFrame) -> DataFrame:
    """The verdict of each conversation with the SHA-256 of its repaired rows."""
    found = written(verdicts(rows), "verdicts")
    return _with_verdicts(rows, found).mapInArrow(_digests, f"{_VERDICT_SQL}, repaired_sha256 string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    repair, conv, place = None, None, 0
    for batch in (part for whole in batches for part in bounded(whole, whole.schema.get_field_index("text"))):
        out: list[dict] = []

        def emit(turns: Iterator[tuple[str, str]], out: list[dict] = out) -> None:
            nonlocal place
            for role, text in turns:
                out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                place += 1

        for row in batch.to_pylist():
            if row["audit"] is not None:
                if repair:
                    emit(repair.end())
                repair, conv, place = Repair(row["audit"]), row["conv_id"], 0
            else:
                emit(repair.row(row["role"], row["text"]))
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if repair:
        out = [{"conv_id": conv, "place": place + k, "role": r, "text": t} for k, (r, t) in enumerate(repair.end())]
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the repaired conversations, for rows as ``as_they_are`` or ``damaged`` give them."""
    found = written(verdicts(rows), "verdicts")
    return _with_verdicts(rows, found).mapInArrow(_repaired, "conv_id bigint, place bigint, role string, text string")
