"""Rounded output, so that the order of floating point sums does not show in a comparison.

The test data has two decimals, so means are often exactly half way between two rounded values;
a small constant moves those away from the edge on both sides of a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

OFFSET = 1.7e-8


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all double columns."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.selectExpr(
        *[f"round(`{c}` + {OFFSET!r}D, {digits}) AS `{c}`" if c in floats else f"`{c}`" for c in df.columns]
    )
