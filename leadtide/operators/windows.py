"""Window operators: lead targets, differences, lags, rolling statistics, fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from leadtide.config import TARGET, target_name
from leadtide.operators.blocks import BLOCK, SeriesLayout, enter, leave, only_home, over_series


def lead_targets(
    df: DataFrame, layout: SeriesLayout, horizons: Sequence[int], column: str = TARGET
) -> DataFrame:
    """One ``target_t<h>`` per horizon: the value ``h`` rows later, NULL at the end of a series."""
    return over_series(df, layout, lambda d, w: targets_inside(d, w, horizons, column), ahead=max(horizons))


def targets_inside(df: DataFrame, w: WindowSpec, horizons: Sequence[int], column: str = TARGET) -> DataFrame:
    return df.withColumns({target_name(h): F.lead(column, h).over(w) for h in horizons})


def difference(column: str, w: WindowSpec) -> Column:
    """Change against the row before; 0 where there is none."""
    return F.coalesce(F.col(column) - F.lag(column, 1).over(w), F.lit(0.0))


def lagged(column: str, rows: int, w: WindowSpec) -> Column:
    return F.coalesce(F.lag(column, rows).over(w), F.lit(0.0))


def trailing_mean(column: str, rows: int, w: WindowSpec) -> Column:
    """Mean of the ``rows`` rows before this one."""
    return F.coalesce(F.avg(column).over(w.rowsBetween(-rows, -1)), F.lit(0.0))


def trailing_sum(column: str, rows: int, w: WindowSpec) -> Column:
    return F.coalesce(F.sum(column).over(w.rowsBetween(-rows, -1)), F.lit(0.0))


def centred_frame(w: WindowSpec, rows: int) -> WindowSpec:
    """The centred frame of ``rows`` rows: an even width looks one row further back."""
    return w.rowsBetween(-(rows // 2), (rows - 1) // 2)


def centred_band(
    df: DataFrame,
    layout: SeriesLayout,
    column: str = TARGET,
    rows: int = 30,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Centred rolling mean and standard deviation, and the band mean +/- deviation.

    Only full frames without missing values give a result.
    """

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = centred_frame(w, rows)
        full = F.count(column).over(frame) == rows
        d = d.withColumns(
            {
                "rolling_mean": F.when(full, F.avg(column).over(frame)),
                "rolling_std": F.when(full, F.stddev_samp(column).over(frame)),
            }
        )
        return d.withColumns(
            {
                "upper_bound": F.col("rolling_mean") + F.col("rolling_std"),
                "lower_bound": F.col("rolling_mean") - F.col("rolling_std"),
            }
        )

    return over_series(df, layout, add, back=rows // 2, ahead=(rows - 1) // 2, scope=scope)


def fill_gaps(
    df: DataFrame,
    layout: SeriesLayout,
    columns: Sequence[str],
    scope: Sequence[str] = (),
    last_resort: float | None = 0.0,
    backward: bool = True,
) -> DataFrame:
    """Forward fill, then (``backward``) backward fill what is left at the start, then a constant."""
    filled = fill_inside(enter(df, layout), layout, columns, scope, last_resort, backward)
    return leave(filled, layout)


def fill_inside(
    df: DataFrame,
    layout: SeriesLayout,
    columns: Sequence[str],
    scope: Sequence[str] = (),
    last_resort: float | None = 0.0,
    backward: bool = True,
) -> DataFrame:
    """``fill_gaps`` for a frame that has its blocks already (see ``enter``).

    After a forward fill only rows before the first known value are missing, so the backward
    fill is the first known value of the whole run; no frame that looks ahead row by row is needed.
    """
    df = only_home(df, layout)
    so_far = layout.over("UNBOUNDED PRECEDING AND CURRENT ROW", scope)
    whole = layout.over("UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING", scope)
    rest = "" if last_resort is None else f", {float(last_resort)!r}D"
    if not layout.blocked:
        heads = {c: f", first(`{c}`) IGNORE NULLS {whole}" if backward else "" for c in columns}
        return _replace(df, {c: f"coalesce(last(`{c}`) IGNORE NULLS {so_far}{heads[c]}{rest}, NULL)" for c in columns})

    # Long series: per block the first and last known value, carried from block to block. That
    # table has one row per block and scope, so its windows stay small.
    run = [*layout.keys, *scope]
    ends = df.groupBy(*run, BLOCK).agg(
        *[F.expr(f"{f}_by(`{c}`, struct({', '.join(f'`{o}`' for o in layout.order)})) FILTER (WHERE `{c}` IS NOT NULL) AS `_{name}_{c}`")
          for c in columns for f, name in (("max", "last"), ("min", "first"))]
    )
    keys = ", ".join(f"`{k}`" for k in run)
    by_block = f"OVER (PARTITION BY {keys} ORDER BY {BLOCK} ROWS BETWEEN"
    carried = ends.selectExpr(
        *[f"`{k}`" for k in run],
        BLOCK,
        *[f"last(`_last_{c}`) IGNORE NULLS {by_block} UNBOUNDED PRECEDING AND 1 PRECEDING) AS `_in_{c}`" for c in columns],
        *[f"first(`_first_{c}`) IGNORE NULLS {by_block} UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS `_head_{c}`" for c in columns],
    )
    names = df.columns
    local = _replace(df, {c: f"last(`{c}`) IGNORE NULLS {so_far}" for c in columns})
    joined = local.join(carried, [*run, BLOCK], "left")
    return _replace(
        joined, {c: f"coalesce(`{c}`, `_in_{c}`{f', `_head_{c}`' if backward else ''}{rest})" for c in columns}, names
    )


def _replace(df: DataFrame, texts: dict[str, str], names: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``names``) with some columns replaced by SQL expressions."""
    return df.selectExpr(*[f"{texts[c]} AS `{c}`" if c in texts else f"`{c}`" for c in names or df.columns])
