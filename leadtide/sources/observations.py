"""Reading observation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtide.config import TIME

_MEASURES = (
    "temp", "tempmax", "tempmin", "feelslike", "dew", "humidity", "sealevelpressure", "cloudcover",
    "solarradiation", "solarenergy", "visibility", "windspeed", "windgust", "precip", "uvindex",
    "moonphase",
)

OBSERVATION_SCHEMA = T.StructType(
    [T.StructField("series_id", T.StringType()), T.StructField("datetime", T.TimestampNTZType())]
    + [T.StructField(m, T.DoubleType()) for m in _MEASURES]
    + [T.StructField(s, T.StringType()) for s in ("sunrise", "sunset", "preciptype", "severerisk")]
)


def read_observations(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Read observations with a declared schema and turn NaN into NULL.

    CSV needs a schema (``OBSERVATION_SCHEMA`` unless given); Parquet carries its own.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").schema(schema or OBSERVATION_SCHEMA)
    elif schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.options(**options).load(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Aggregates and windows skip NULL but not NaN, so missing is NULL everywhere."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.selectExpr(
        *[f"nullif(`{c}`, double('NaN')) AS `{c}`" if c in floats else f"`{c}`" for c in df.columns]
    )


def parse_time(df: DataFrame, column: str = TIME) -> DataFrame:
    """Strict: a value that is no timestamp fails the job."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def parse_time_or_null(df: DataFrame, *columns: str) -> DataFrame:
    """Lenient: a value that is no timestamp becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def require_columns(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {', '.join(missing)}")
