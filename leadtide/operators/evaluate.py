"""Forecast errors and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.config import pred_name, target_name

# Fixed value: the smallest divisor of the relative error (double machine epsilon).
EPSILON = 2.220446049250313e-16


def metric_columns(y: Column, pred: Column) -> dict[str, Column]:
    """rmse, mae, r2 and mape as aggregates over rows where both values are known."""
    error = y - pred
    both = y.isNotNull() & pred.isNotNull()
    kept = F.when(both, y)
    total = F.count(error) * F.var_pop(kept)
    squares = F.sum(error * error)
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.when(total == 0, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(1 - squares / total),
        "mape": F.avg(F.abs(error) / F.greatest(F.abs(kept), F.lit(EPSILON))),
    }


def evaluate(long: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Metrics of a long prediction table (``y``, ``pred``) per group, with the row count."""
    y, pred = F.col("y"), F.col("pred")
    cols = metric_columns(y, pred)
    return long.groupBy(*by).agg(F.count(y - pred).alias("n_rows"), *[c.alias(k) for k, c in cols.items()])


def to_long(wide: DataFrame, horizons: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Wide ``target_t<h>`` / ``pred_target_t<h>`` columns to rows (horizon, y, pred)."""
    rows = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), F.col(target_name(h)).alias("y"), F.col(pred_name(h)).alias("pred"))
            for h in horizons
        ]
    )
    return wide.select(*keep, F.inline(rows))


def to_wide(long: DataFrame, horizons: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """One row per time with target and prediction columns of all horizons."""
    cols = []
    for h in horizons:
        here = F.col("horizon") == h
        cols.append(F.max(F.when(here, F.col("y"))).alias(target_name(h)))
        cols.append(F.max(F.when(here, F.col("pred"))).alias(pred_name(h)))
    return long.groupBy(*keep).agg(*cols)
