"""Ordered windows over series of any length.

A window partitioned by the series puts a whole series into one task. That is right for many
series of moderate length, and wrong when one series holds a third of the table. ``lay_out``
looks at the series lengths once, reading only key and time columns. If no series is longer than
``block_rows`` the usual window is used as it is. Otherwise each long series is cut along time
into blocks of about ``block_rows`` rows, and the few rows a window needs from the neighbouring
block are copied over, so that no task ever holds more than one block and results stay exact.

The cut works on small equal-width time cells: a cell number is plain arithmetic on the
timestamp, cell counts give the position of every block, and both lookup tables are bounded by
the number of blocks, never by the number of rows.

One rule for equal times, at every size: time and the tie columns of the layout must tell the rows
of a series apart, and one time may have a quarter block of rows at most. ``lay_out`` refuses other
frames by an aggregate, unless the caller knows that the rows are told apart (a ``groupBy`` made
them so). Rows of one time are ordered by the tie columns, nulls first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from leadtide.config import KEYS, TIME
from leadtide.session import cut_lineage

BLOCK_ROWS = 4_000_000
MAX_BLOCKS = 32_768
CELLS_PER_BLOCK = 16
BROADCAST_ROWS = 2_000_000

BLOCK, HOME = "_block", "_home"
_CELL, _T0, _WIDTH = "_cell", "_t0", "_width"
_BEFORE, _AFTER, _START, _TOTAL = "_before", "_after", "_block_start", "_series_rows"
_EARLIER = "_from_earlier"


@dataclass(frozen=True)
class SeriesLayout:
    """How the rows of one frame are cut. ``spans`` and ``cells`` are None when nothing is cut.

    ``rows`` is an upper bound for the number of rows of the frame. ``ties`` order rows of one time.
    ``entered`` is set for a stored frame that has its blocks, with so many rows copied (back, ahead).
    """

    keys: tuple[str, ...] = KEYS
    time: str = TIME
    block_rows: int = BLOCK_ROWS
    spans: DataFrame | None = None
    cells: DataFrame | None = None
    broadcast_cells: bool = True
    rows: int | None = None
    ties: tuple[str, ...] = ()
    entered: tuple[int, int] | None = None

    @property
    def order(self) -> list[str]:
        """What orders the rows of a series."""
        return [self.time, *self.ties]

    @property
    def blocked(self) -> bool:
        return self.cells is not None or self.entered is not None

    @property
    def helpers(self) -> list[str]:
        """Columns of a frame that has its blocks, until ``leave`` drops them."""
        return [BLOCK, HOME, _EARLIER, _START, _TOTAL] if self.blocked else []

    def partition(self, scope: Sequence[str] = ()) -> list[str]:
        return [*self.keys, *scope, *([BLOCK] if self.blocked else [])]

    def over(self, frame: str, scope: Sequence[str] = ()) -> str:
        """The same window as SQL text, for expressions over many columns."""
        keys = ", ".join(f"`{k}`" for k in self.partition(scope))
        order = ", ".join(f"`{c}`" for c in self.order)
        return f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {frame})"

    def window(self, scope: Sequence[str] = ()) -> WindowSpec:
        return Window.partitionBy(*self.partition(scope)).orderBy(*self.order)


def micros(time: str) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` column."""
    return F.expr(
        f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{time}`)"
    )


def lay_out(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    time: str = TIME,
    block_rows: int = BLOCK_ROWS,
    at_most: int | None = None,
    ties: Sequence[str] = (),
    unique: bool = False,
) -> SeriesLayout:
    """Look at the series lengths of ``df`` and decide whether its series must be cut.

    ``at_most`` is a known upper bound for the rows of ``df`` (for example the row count of the
    table it is aggregated from, which Parquet footers answer); if it is small, no pass is made.
    The layout holds for exactly these rows: lay out the frame that is windowed. ``unique`` says that
    time and ``ties`` are known to tell the rows of a series apart.
    """
    keys, ties = tuple(keys), tuple(ties)
    if not unique:
        check_order(df, keys, time, ties, block_rows)
    if at_most is not None and at_most <= block_rows:
        return SeriesLayout(keys, time, block_rows, rows=at_most, ties=ties)

    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(micros(time)).alias("lo"),
        F.max(micros(time)).alias("hi"),
    )
    seen = sizes.agg(F.sum("n").alias("total"), F.max("n").alias("longest")).first()
    if not seen["longest"] or seen["longest"] <= block_rows:
        return SeriesLayout(keys, time, block_rows, rows=seen["total"] or 0, ties=ties)

    # At most MAX_BLOCKS blocks in all, hence at most that many long series and a bounded lookup.
    rows = max(block_rows, math.ceil(seen["total"] / MAX_BLOCKS))
    long = sizes.where(F.col("n") > rows)
    wanted = F.ceil(F.col("n") * CELLS_PER_BLOCK / rows)
    spans = cut_lineage(
        long.select(
            *keys,
            F.col("lo").alias(_T0),
            F.greatest((F.col("hi") - F.col("lo") + 1) / wanted, F.lit(1.0)).cast("long").alias(_WIDTH),
        )
    )
    while True:
        counts = cut_lineage(
            _with_cell(df.select(*keys, time), spans, keys, time)
            .where(F.col(_CELL).isNotNull())
            .groupBy(*keys, _CELL)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        crowded = counts.groupBy(*keys).agg((F.max("n") > rows // 4).alias("crowded"))
        tight = spans.join(crowded, list(keys)).where("crowded")
        if tight.isEmpty():
            break
        if not tight.where(F.col(_WIDTH) == 1).isEmpty():
            raise ValueError(f"{time} does not order the rows of a series: too many share one value")
        # Bursts: split the cells of crowded series further; only non-empty cells are kept.
        spans = cut_lineage(
            spans.join(F.broadcast(crowded), list(keys)).select(
                *keys,
                _T0,
                F.when(F.col("crowded"), F.greatest(F.expr(f"{_WIDTH} div 8"), F.lit(1)))
                .otherwise(F.col(_WIDTH)).cast("long").alias(_WIDTH),
            )
        )

    # A cell holds at most a quarter block, so blocks are numbered without holes and every block
    # but the last holds at least three quarters of block_rows rows.
    running = Window.partitionBy(*keys).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("first", F.coalesce(F.sum("n").over(running), F.lit(0)))
    placed = placed.withColumn(BLOCK, F.expr(f"first div {rows}"))
    in_block = Window.partitionBy(*keys, BLOCK)
    start = F.min("first").over(in_block)
    end = F.max(F.col("first") + F.col("n")).over(in_block)
    cells = cut_lineage(
        placed.select(
            *keys,
            _CELL,
            BLOCK,
            start.alias(_START),
            (F.col("first") - start).alias(_BEFORE),
            (end - F.col("first") - F.col("n")).alias(_AFTER),
            F.sum("n").over(Window.partitionBy(*keys)).alias(_TOTAL),
        )
    )
    return SeriesLayout(keys, time, rows, spans, cells, cells.count() <= BROADCAST_ROWS, seen["total"], ties)


def check_order(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> None:
    """Refuse a frame with two rows of a series that agree in time and ties, or with too many of one time."""
    same = df.groupBy(*keys, time, *ties).agg(F.count(F.lit(1)).alias("_n"))
    if ties:
        same = same.groupBy(*keys, time).agg(F.max("_n").alias("_n"), F.sum("_n").alias("_all"))
    else:
        same = same.withColumn("_all", F.col("_n"))
    worst = same.agg(F.max("_n").alias("same"), F.max("_all").alias("all")).first()
    if worst["same"] and worst["same"] > 1:
        raise ValueError(f"{[time, *ties]} does not order the rows of a series: {worst['same']} rows agree; name more tie columns")
    if worst["all"] and worst["all"] > max(1, block_rows // 4):
        raise ValueError(f"{worst['all']} rows of a series share one {time}: more than a quarter of a block of {block_rows} rows")


def _with_cell(df: DataFrame, spans: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    # spans: one row per long series, at most MAX_BLOCKS rows
    return (
        df.join(F.broadcast(spans), list(keys), "left")
        .withColumn(_CELL, F.floor((micros(time) - F.col(_T0)) / F.col(_WIDTH)))
        .drop(_T0, _WIDTH)
    )


def enter(df: DataFrame, layout: SeriesLayout, back: int = 0, ahead: int = 0) -> DataFrame:
    """Give every row its block, and copy ``back`` / ``ahead`` rows across block borders.

    Copies have ``_home`` = false; ``leave`` drops them again. Nothing happens to uncut series.
    """
    if not layout.blocked:
        return df
    if layout.entered is not None:
        if back > layout.entered[0] or ahead > layout.entered[1]:
            raise ValueError(f"the stored frame has {layout.entered} rows copied over block borders, {(back, ahead)} are needed")
        return df
    if max(back, ahead) > layout.block_rows // 2:
        raise ValueError("a window may reach over half a block at most; use larger blocks")
    cells = F.broadcast(layout.cells) if layout.broadcast_cells else layout.cells
    tagged = _with_cell(df, layout.spans, layout.keys, layout.time).join(
        cells, [*layout.keys, _CELL], "left"
    )
    home = F.coalesce(F.col(BLOCK), F.lit(0).cast("long"))
    goes_to = F.array_compact(
        F.array(
            home,
            F.when(F.col(_AFTER) < back, F.col(BLOCK) + 1),
            F.when((F.col(_BEFORE) < ahead) & (F.col(BLOCK) > 0), F.col(BLOCK) - 1),
        )
    )
    return (
        tagged.withColumn("_origin", home)
        .withColumn(BLOCK, F.explode(goes_to))
        .withColumn(HOME, F.col(BLOCK) == F.col("_origin"))
        .withColumn(_EARLIER, F.col("_origin") < F.col(BLOCK))
        .drop("_origin", _CELL, _BEFORE, _AFTER)
    )


def only_home(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    return df.where(HOME) if layout.blocked else df


def leave(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Drop copied rows and helper columns."""
    if not layout.blocked:
        return df
    return df.where(HOME).drop(*layout.helpers)


def over_series(
    df: DataFrame,
    layout: SeriesLayout,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int = 0,
    ahead: int = 0,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Run ``add(df, window)`` where window is ordered by time within (series, scope).

    ``back`` and ``ahead`` say how many rows the frames in ``add`` reach. ``scope`` columns
    restart the windows (splits, folds) and must cut a series into runs of consecutive rows.
    Where series are cut, a frame that reaches farther is refused: it would stop at block borders.
    """
    wide = enter(df, layout, back, ahead)
    window = layout.window(scope)
    return leave(add(wide, _within(window, back, ahead) if layout.blocked else window), layout)


def _within(window: WindowSpec, back: int, ahead: int) -> WindowSpec:
    """The window, with frames of rows limited to what the copied rows cover and no way around them."""
    plain = window.rowsBetween

    def rows_between(start: int, end: int) -> WindowSpec:
        if start < -back or end > ahead:
            raise ValueError(f"frame {start}..{end} reaches over a block border: only {back} rows back and {ahead} ahead are there")
        return plain(start, end)

    def refused(*_) -> WindowSpec:
        raise ValueError("where series are cut, a window has frames of rows in the order it came with")

    window.rowsBetween = rows_between
    window.rangeBetween = window.orderBy = window.partitionBy = refused
    return window


def row_index(df: DataFrame, layout: SeriesLayout, idx: str = "idx", n: str | None = None) -> DataFrame:
    """Position of each row in its series, from 0, and if asked the length of the series."""
    return leave(index_inside(enter(df, layout), layout, idx, n), layout)


def index_inside(df: DataFrame, layout: SeriesLayout, idx: str = "idx", n: str | None = None) -> DataFrame:
    """``row_index`` for a frame that has its blocks already; copied rows get their position too."""
    local = F.row_number().over(layout.window()) - 1
    whole = Window.partitionBy(*layout.partition())
    if not layout.blocked:
        out = df.withColumn(idx, local.cast("long"))
        return out.withColumn(n, F.count(F.lit(1)).over(whole)) if n else out
    start = F.coalesce(F.max(F.when(F.col(HOME), F.col(_START))).over(whole), F.lit(0))
    out = df.withColumn(idx, (start + local - F.count_if(F.col(_EARLIER)).over(whole)).cast("long"))
    # uncut series sit in block 0 as a whole, so their length is the size of that block
    return out.withColumn(n, F.coalesce(F.col(_TOTAL), F.count(F.lit(1)).over(whole))) if n else out
