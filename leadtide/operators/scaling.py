"""Robust scaling: (x - median) / interquartile range, with exact quartiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.operators.quantiles import exact_quantiles, quartiles_wide

# Fixed value: a spread below ten machine epsilons is none.
NO_SPREAD = 2.220446049250313e-15


def robust_constants(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), at_most: int | None = None
) -> DataFrame:
    """One row per group and feature: median and spread; a spread of (almost) zero becomes 1."""
    q = F.col("quantiles")
    return exact_quantiles(df, columns, by=by, at_most=at_most).select(
        *by, "feature", q[1].alias("median"), (q[2] - q[0]).alias("iqr"), _spread(q[2] - q[0]).alias("scale")
    )


def _spread(iqr: Column) -> Column:
    return F.when(iqr < NO_SPREAD, F.lit(1.0)).otherwise(iqr)


def fit_robust_scaler(
    df: DataFrame, columns: Sequence[str], at_most: int | None = None
) -> dict[str, tuple[float, float]]:
    """Median and spread per column as numbers (one row per feature reaches the driver).

    A column without any value keeps median 0 and spread 1.
    """
    rows = robust_constants(df, columns, at_most=at_most).collect()  # at most len(columns) rows
    fitted = {c: (0.0, 1.0) for c in columns}
    fitted.update({r["feature"]: (r["median"], r["scale"]) for r in rows})
    return fitted


def apply_robust_scaler(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Scale as a projection with constant medians and spreads."""
    return df.selectExpr(
        *[
            f"(`{c}` - {fitted[c][0]!r}D) / {fitted[c][1]!r}D AS `{c}`" if c in fitted else f"`{c}`"
            for c in df.columns
        ]
    )


def scale_per_group(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], fit_on: Column, at_most: int | None = None
) -> DataFrame:
    """Scale every row with constants of its group, fitted on the rows where ``fit_on`` holds.

    The groups are folds: the constants are one row per fold, a bounded broadcast.
    """
    constants = quartiles_wide(df.where(fit_on), columns, by, at_most)
    out = df.join(F.broadcast(constants), list(by), "left")
    in_order = [c for c in df.columns if c not in by]
    return out.selectExpr(
        *[f"`{b}`" for b in by],
        *[
            f"(`{c}` - coalesce(`{c}_q50`, 0D)) / if(`{c}_q75` - `{c}_q25` >= {NO_SPREAD!r}D, `{c}_q75` - `{c}_q25`, 1D) AS `{c}`"
            if c in set(columns) else f"`{c}`"
            for c in in_order
        ],
    )
