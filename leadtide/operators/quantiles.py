"""Exact interpolated quantiles of many columns without gathering a column in one task.

The built-in exact ``percentile`` keeps all distinct values of a group in one buffer. Here a
sketch brackets each quantile first (its rank error is bounded), then one pass keeps only values
inside the brackets and counts the rest per gap, with partial aggregation in every task. Ranks of
the kept values are exact, and so is the quantile; a bracket that should miss fails the job.
Brackets are cut into slices, so that only the values of a few slices are put in order.

Expressions over many columns are written as SQL text: one call per column instead of hundreds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 20_000  # the sketch answers within n / ACCURACY ranks
NARROW, WIDE = 2.0 / ACCURACY, 0.05
SLICES = 1024
IN_ONE_BUFFER = 1_000_000  # rows whose values one task may hold
SMALL, TINY = 2 * ACCURACY, 100  # below these row counts a bracket is WIDE, or the whole range


def _sketches(columns: Sequence[str], probs: Sequence[float]) -> list[str]:
    wanted = [min(max(p + m, 0.0), 1.0) for p in probs for m in (-WIDE, -NARROW, NARROW, WIDE)]
    list_ = ", ".join(f"{p!r}D" for p in wanted)
    out = []
    for c in columns:
        out += [
            f"percentile_approx(`{c}`, array({list_}), {ACCURACY}) AS `_s_{c}`",
            f"count(`{c}`) AS `_n_{c}`", f"min(`{c}`) AS `_lo_{c}`", f"max(`{c}`) AS `_hi_{c}`",
        ]
    return out


def _brackets(c: str, probs: Sequence[float]) -> str:
    """Lower and upper bracket per quantile, wide enough to hold both of its neighbours."""

    def pick(rough: str, wide: int, narrow: int) -> str:
        return (f"CASE WHEN `_n_{c}` < {TINY} THEN `{rough}_{c}` WHEN `_n_{c}` < {SMALL} THEN `_s_{c}`[{wide}] "
                f"ELSE `_s_{c}`[{narrow}] END")

    sides = []
    for i in range(len(probs)):
        sides += [pick("_lo", 4 * i, 4 * i + 1), pick("_hi", 4 * i + 3, 4 * i + 2)]
    return f"array({', '.join(sides)}) AS `_b_{c}`"


def _place(c: str, n_probs: int) -> str:
    """Feature, cell and kept value of one column. Brackets are cut into SLICES cells, each gap is
    one cell more; cells are numbered in the order of their values."""
    v, b = f"`{c}`", f"`_b_{c}`"
    cases, inside = [f"WHEN {v} < {b}[0] THEN -1"], []
    for i in range(n_probs):
        lo, hi, base = f"{b}[{2 * i}]", f"{b}[{2 * i + 1}]", i * (SLICES + 2)
        if i:
            cases.append(f"WHEN {v} < {lo} THEN {base - 1}")
        cases.append(f"WHEN {v} <= {hi} THEN {base} + if({hi} > {lo}, coalesce(try_cast(({v} - {lo}) / ({hi} - {lo}) * {SLICES} AS INT), {SLICES}), 0)")
        inside.append(f"{v} BETWEEN {lo} AND {hi}")
    last = n_probs * (SLICES + 2) - 1
    return (f"if({v} IS NULL, NULL, struct('{c}' AS feature, CASE {' '.join(cases)} ELSE {last} END AS cell, "
            f"if({' OR '.join(inside)}, {v}, NULL) AS v))")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
    at_most: int | None = None,
) -> DataFrame:
    """One row per group and column: ``by``, ``feature``, ``n`` and ``quantiles`` (array).

    ``by`` names a bounded set of groups (folds, seasons); missing values are skipped. Columns
    without any value give no row. Quantiles interpolate linearly between neighbours.
    ``at_most`` is a known upper bound for the rows of ``df``: a small frame needs no brackets.
    """
    by, probs = list(by), sorted(probs)
    if at_most is not None and at_most <= IN_ONE_BUFFER:
        return _in_one_buffer(df, columns, probs, by)
    keys = by or ["_all"]
    named = [f"`{k}`" for k in keys]
    doubles = [f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns]
    data = df.selectExpr(*([f"`{b}`" for b in by] or ["1 AS _all"]), *doubles)
    sketches = [F.expr(e) for e in _sketches(columns, probs)]
    if by:
        # Bounded broadcast: one row per fold or season, 2 * len(probs) numbers per column.
        brackets = data.groupBy(*by).agg(*sketches).selectExpr(*named, *[_brackets(c, probs) for c in columns])
        near = data.join(F.broadcast(brackets), by)
    else:
        row = data.agg(*sketches).selectExpr(*[_brackets(c, probs) for c in columns]).first()  # one row
        found = {c: row[f"_b_{c}"] for c in columns if row[f"_b_{c}"][0] is not None}
        if not found:
            return df.sparkSession.createDataFrame([], "feature string, n bigint, quantiles array<double>")
        columns = list(found)
        near = data.selectExpr(
            "_all", *[f"`{c}`" for c in columns],
            *[f"array({', '.join(f'double({str(x)!r})' for x in b)}) AS `_b_{c}`" for c, b in found.items()],
        )
    places = ", ".join(_place(c, len(probs)) for c in columns)
    front = ", ".join(named)
    counted = (
        near.selectExpr(*named, f"inline(array_compact(array({places})))")
        .groupBy(*keys, "feature", "cell", "v")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    # Ranks at which the cells of a column start: a few thousand rows per group and column.
    cells = (
        counted.groupBy(*keys, "feature", "cell")
        .agg(F.sum("m").alias("size"))
        .selectExpr(
            *named, "feature", "cell", f"sum(size) OVER (PARTITION BY {front}, feature) AS n",
            f"sum(size) OVER (PARTITION BY {front}, feature ORDER BY cell ROWS UNBOUNDED PRECEDING) AS stop", "size",
        )
        .selectExpr(*named, "feature", "cell", "n", "stop - size AS start", "stop")
    )
    ranks = {}
    for i, p in enumerate(probs):
        ranks[f"lo{i}"], ranks[f"hi{i}"] = f"floor({p!r}D * (n - 1))", f"ceil({p!r}D * (n - 1))"
    wanted = " OR ".join(f"(start <= {k} AND {k} < stop)" for k in ranks.values())
    # Only values of the few cells that hold a wanted rank are put in order: at most two cells
    # per quantile, so the other side of this join is tiny.
    on = [*keys, "feature", "cell"]
    hit = counted.join(F.broadcast(cells.where(wanted)), on)
    ranked = hit.selectExpr(
        *named, "feature", "v", "n", "m",
        f"start + sum(m) OVER (PARTITION BY {front}, feature, cell ORDER BY v ROWS UNBOUNDED PRECEDING) AS end",
    )
    picks = [F.expr(f"max(CASE WHEN end - m <= {k} AND {k} < end THEN v END) AS {name}") for name, k in ranks.items()]
    found = ranked.groupBy(*keys, "feature", "n").agg(*picks)
    values = ", ".join(
        f"CASE WHEN lo{i} IS NULL OR hi{i} IS NULL THEN CAST(raise_error('quantile outside its bracket') AS DOUBLE) "
        f"WHEN lo{i} = hi{i} THEN lo{i} ELSE lo{i} + (hi{i} - lo{i}) * ({p!r}D * (n - 1) - floor({p!r}D * (n - 1))) END"
        for i, p in enumerate(probs)
    )
    return found.selectExpr(*[f"`{b}`" for b in by], "feature", "n", f"array({values}) AS quantiles")


def _in_one_buffer(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: list[str]) -> DataFrame:
    list_ = ", ".join(f"{p!r}D" for p in probs)
    wide = df.groupBy(*by).agg(
        *[F.expr(f"struct('{c}' AS feature, count(`{c}`) AS n, percentile(`{c}`, array({list_})) AS quantiles) AS `{c}`")
          for c in columns]
    )
    rows = ", ".join(f"`{c}`" for c in columns)
    return wide.selectExpr(*[f"`{b}`" for b in by], f"inline(array({rows}))").where("n > 0")


def quartiles_wide(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), at_most: int | None = None
) -> DataFrame:
    """``exact_quantiles`` with one row per group and columns ``<c>_q25 / _q50 / _q75``."""
    long = exact_quantiles(df, columns, QUARTILES, by, at_most)
    out = []
    for c in columns:
        q = f"max(CASE WHEN feature = '{c}' THEN quantiles END)"
        out += [F.expr(f"{q}[{i}] AS `{c}_{name}`") for i, name in enumerate(("q25", "q50", "q75"))]
    return long.groupBy(*by).agg(*out)
