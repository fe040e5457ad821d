"""Names, labels and number formats of report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def horizon_of(name: Column, unit: str = "row") -> Column:
    """The horizon in a name such as ``target_t24``; with unit ``hour`` it is turned into days."""
    steps = F.substring_index(name, "_t", -1).cast("int")
    if unit == "hour":
        return steps / F.lit(24.0)
    return steps


def relative_gap(base: Column, other: Column) -> Column:
    """(other - base) / base in percent; NULL where base is 0."""
    return F.try_divide(other - base, base) * 100


def metric_label(name: Column, labels: dict[str, str]) -> Column:
    """Look a display name up; unknown names give NULL."""
    out = F.lit(None).cast("string")
    for key, label in labels.items():
        out = F.when(name == key, label).otherwise(out)
    return out


def title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def decimals(x: Column, digits: int = 4, suffix: str = "") -> Column:
    return F.format_string(f"%.{digits}f{suffix}", x)


def percent(x: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", x * 100)
