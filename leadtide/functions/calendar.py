"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.config import TIME

_TURN = 2 * math.pi


def calendar_parts(df: DataFrame, time: str = TIME) -> DataFrame:
    """month, day_of_year, day_of_week (Monday = 0), hour and year."""
    return df.withColumns(
        {
            "year": F.year(time),
            "month": F.month(time),
            "day_of_year": F.dayofyear(time),
            "day_of_week": F.weekday(time),
            "hour": F.hour(time),
        }
    )


def cycle(part: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of a part of a period."""
    angle = F.lit(_TURN) * part / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def year_cycle(time: str = TIME) -> dict[str, Column]:
    """Month of 12 and day of 365; the divisor stays 365 in leap years."""
    month_sin, month_cos = cycle(F.month(time), 12)
    day_sin, day_cos = cycle(F.dayofyear(time), 365)
    return {"month_sin": month_sin, "month_cos": month_cos, "day_sin": day_sin, "day_cos": day_cos}


def hour_cycle(time: str = TIME) -> dict[str, Column]:
    hour_sin, hour_cos = cycle(F.hour(time), 24)
    return {"hour_sin": hour_sin, "hour_cos": hour_cos}


def season(month: Column) -> Column:
    """Rainy from May to November, else Dry."""
    return F.when(month.between(5, 11), F.lit("Rainy")).otherwise(F.lit("Dry"))


def add_ahead(time: str | Column, steps: Column, unit: str) -> Column:
    """The moment ``steps`` days or hours after ``time``."""
    start = F.col(time) if isinstance(time, str) else time
    if unit == "day":
        return start + F.make_dt_interval(days=steps.cast("int"))
    if unit == "hour":
        return start + F.make_dt_interval(hours=steps.cast("int"))
    raise ValueError(f"unit is day or hour, not {unit}")
