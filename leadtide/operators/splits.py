"""Splits by time, purged expanding folds, and the checks around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.config import FOLDS, KEYS, TIME, TRAIN_RATIO, VAL_RATIO
from leadtide.operators.blocks import SeriesLayout, enter, index_inside, leave, row_index


def split_label(idx: Column, n: Column, train: float = TRAIN_RATIO, val: float = VAL_RATIO) -> Column:
    """train / val / test by position. Cut points are double products, truncated."""
    train_end = F.floor(n * F.lit(float(train)))
    val_end = train_end + F.floor(n * F.lit(float(val)))
    return F.when(idx < train_end, "train").when(idx < val_end, "val").otherwise("test")


def split_by_time(
    df: DataFrame,
    layout: SeriesLayout,
    train: float = TRAIN_RATIO,
    val: float = VAL_RATIO,
) -> DataFrame:
    """Add ``split``: per series the first 70 % of rows train, the next 15 % val, the rest test."""
    return leave(split_inside(enter(df, layout), layout, train, val), layout)


def split_inside(
    df: DataFrame, layout: SeriesLayout, train: float = TRAIN_RATIO, val: float = VAL_RATIO
) -> DataFrame:
    """``split_by_time`` for a frame that has its blocks already (see ``enter``)."""
    placed = index_inside(df, layout, "_idx", "_n")
    return placed.withColumn("split", split_label(F.col("_idx"), F.col("_n"), train, val)).drop("_idx", "_n")


def purged_folds(idx: Column, n: Column, folds: int, gap: int) -> Column:
    """Array of (fold, role) a row takes part in.

    A test part has n div (folds + 1) rows; fold i trains on everything before its end minus the
    gap, and a fold whose validation part does not fit is left out, as are all later ones.
    """
    size = F.floor(n / F.lit(folds + 1))
    parts = []
    for i in range(1, folds + 1):
        train_end = size * i
        val_start = train_end + gap
        val_end = val_start + size
        role = F.when(idx < train_end, "train").when((idx >= val_start) & (idx < val_end), "val")
        parts.append(F.when((val_end <= n) & role.isNotNull(), F.struct(F.lit(i).alias("fold"), role.alias("role"))))
    return F.array_compact(F.array(*parts))


def assign_folds(df: DataFrame, layout: SeriesLayout, gap: int, folds: int = FOLDS) -> DataFrame:
    """One copy of a row per fold it takes part in, with ``fold``, ``role`` and ``idx``."""
    placed = row_index(df, layout, "idx", "_n")
    return (
        placed.withColumn("_part", F.explode(purged_folds(F.col("idx"), F.col("_n"), folds, gap)))
        .withColumns({"fold": F.col("_part.fold"), "role": F.col("_part.role")})
        .drop("_part", "_n")
    )


def leaks(folded: DataFrame, keys: Sequence[str] = KEYS, time: str = TIME) -> DataFrame:
    """Folds whose training part does not end before its validation part starts. Empty is good."""
    return (
        folded.groupBy(*keys, "fold")
        .agg(
            F.max(F.when(F.col("role") == "train", F.col(time))).alias("train_end"),
            F.min(F.when(F.col("role") == "val", F.col(time))).alias("val_start"),
        )
        .where(F.col("train_end") >= F.col("val_start"))
    )


def check_no_leak(folded: DataFrame, keys: Sequence[str] = KEYS, time: str = TIME) -> None:
    bad = leaks(folded, keys, time).first()
    if bad is not None:
        raise AssertionError(
            f"fold {bad['fold']} leaks: train ends {bad['train_end']}, val starts {bad['val_start']}"
        )


def range_report(df: DataFrame, by: Sequence[str], time: str = TIME) -> DataFrame:
    """First and last moment and row count per split or fold part."""
    return df.groupBy(*by).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n_rows")
    )


def fold_gaps(folded: DataFrame, keys: Sequence[str] = KEYS, time: str = TIME) -> DataFrame:
    """Days between the end of training and the start of validation, per fold."""
    ends = folded.groupBy(*keys, "fold").agg(
        F.max(F.when(F.col("role") == "train", F.col(time))).alias("train_end"),
        F.min(F.when(F.col("role") == "val", F.col(time))).alias("val_start"),
    )
    return ends.withColumn("gap_days", F.expr("timestampdiff(DAY, train_end, val_start)"))
