"""Observation views over the event and order-line tables of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.sources.observations import read_observations


def _sun(time: str) -> dict[str, str]:
    day = f"CAST(CAST(min({time}) AS DATE) AS STRING)"
    return {
        "sunrise": f"CASE WHEN count(*) % 5 = 0 THEN 'n/a' ELSE concat({day}, ' 05:30:00') END",
        "sunset": f"concat({day}, ' 18:', lpad(CAST(day(min({time})) AS STRING), 2, '0'), ':00')",
    }


def _aggregate(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*[F.expr(f"{e} AS {n}") for n, e in columns.items()])


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hourly series, one per event type."""
    events = read_observations(spark, f"{sf_dir}/events.parquet")
    hour = "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0)"
    return _aggregate(
        events,
        ["event_type AS series_id", f"{hour} AS datetime"],
        {
            "temp": "avg(value)", "tempmax": "max(value)", "tempmin": "min(value)",
            "dew": "avg(value) - 0.1D * count(*)",
            "humidity": "CAST(count(DISTINCT user_id) AS DOUBLE)",
            "sealevelpressure": "1000D + avg(CAST(event_id % 50 AS DOUBLE))",
            "cloudcover": "100D * avg(CASE WHEN value > 50 THEN 1D ELSE 0D END)",
            "solarradiation": "sum(value)", "solarenergy": "0.0864D * sum(value)",
            "visibility": "CAST(max(user_id % 17) AS DOUBLE)",
            "windspeed": "CASE WHEN count(*) > 1 THEN stddev_samp(value) END",
            "windgust": "max(value) - min(value)",
            "precip": "coalesce(sum(CASE WHEN value > 150 THEN value END), 0D)",
            **_sun("ts"),
        },
    )


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series over all order lines."""
    lines = read_observations(spark, f"{sf_dir}/lineitem.parquet")
    days = _aggregate(
        lines,
        ["CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP_NTZ) AS datetime"],
        {
            "temp": "avg(l_quantity)", "tempmax": "max(l_quantity)", "tempmin": "min(l_quantity)",
            "dew": "avg(l_quantity) - 100D * avg(l_tax)",
            "humidity": "1000D * avg(l_discount)",
            "sealevelpressure": "1000D + avg(CAST(l_partkey % 50 AS DOUBLE))",
            "cloudcover": "100D * avg(CASE WHEN l_returnflag = 'A' THEN 1D ELSE 0D END)",
            "solarradiation": "avg(l_extendedprice)", "solarenergy": "0.0864D * avg(l_extendedprice)",
            "visibility": "CAST(max(l_suppkey % 17) AS DOUBLE)",
            "windspeed": "CASE WHEN count(*) > 20 THEN stddev_samp(l_quantity) END",
            "windgust": "max(l_quantity) - min(l_quantity)",
            "precip": "coalesce(sum(CASE WHEN l_quantity > 49 AND l_returnflag = 'R' THEN l_tax END), 0D)",
            **_sun("l_shipdate"),
        },
    )
    return days.selectExpr("'all' AS series_id", "*")


def at_most_rows(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Row count of a table from its Parquet footers: a bound for every view aggregated from it."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
