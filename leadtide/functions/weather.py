"""Row-wise features derived from measures. Each exists only if its inputs do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daylight_hours(sunrise: str = "sunrise", sunset: str = "sunset") -> Column:
    """Hours from sunrise to sunset; NULL if either is no timestamp."""
    parsed = f"try_cast(`{sunrise}` AS timestamp_ntz), try_cast(`{sunset}` AS timestamp_ntz)"
    return F.expr(f"timestampdiff(MICROSECOND, {parsed})") / F.lit(3.6e9)


def row_features(df: DataFrame) -> DataFrame:
    """daylight_hours, solar_per_hour, temp_range and dewpoint_depression."""
    have = set(df.columns)
    if {"sunrise", "sunset"} <= have:
        df = df.withColumn("daylight_hours", daylight_hours())
        if "solarenergy" in have:
            df = df.withColumn("solar_per_hour", F.col("solarenergy") / (F.col("daylight_hours") + 1e-6))
    extra: dict[str, Column] = {}
    if {"tempmax", "tempmin"} <= have:
        extra["temp_range"] = F.col("tempmax") - F.col("tempmin")
    if {"temp", "dew"} <= have:
        extra["dewpoint_depression"] = F.col("temp") - F.col("dew")
    return df.withColumns(extra) if extra else df


def temperature_band(temp: Column) -> Column:
    """Band 1 (hottest) to 6, cut at 35, 31, 28, 25 and 22."""
    return (
        F.when(temp >= 35, 1).when(temp >= 31, 2).when(temp >= 28, 3)
        .when(temp >= 25, 4).when(temp >= 22, 5).when(temp.isNotNull(), 6)
    )
