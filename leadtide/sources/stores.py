"""Tables and models that jobs hand to each other: splits, predictions, metrics, parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.operators.blocks import SeriesLayout, enter

PREDICTIONS = "series_id string, datetime timestamp_ntz, horizon int, y double, pred double"
METRICS = "model string, metric_type string, horizon int, rmse double, mae double, r2 double, mape double"
LINES = "horizon int, name string, weight double"
NOTES = "keys array<string>, time string, ties array<string>, block_rows bigint, rows bigint, blocked boolean, back int, ahead int"
PARAMETERS = "model string, horizon int, name string, value string"


def write_splits(df: DataFrame, path: str) -> None:
    """One table, one folder per split, so that a reader of one split reads only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, *splits: str) -> DataFrame:
    """Rows of the named splits (all if none is named); other folders are not listed for reading."""
    df = spark.read.parquet(path)
    return df.where(F.col("split").isin(*splits)) if splits else df


def write_series(df: DataFrame, layout: SeriesLayout, table: str, path: str, back: int = 0, ahead: int = 0, buckets: int | None = None) -> None:
    """A table stored by series (long ones by block) and time, for many window jobs.

    Rows are dealt into buckets by series and block and sorted by time; cut series keep the ``back`` and
    ``ahead`` rows that windows need beside each block. What ``read_series`` gives needs no shuffle and no
    look at the lengths. The notes about the layout lie beside the rows and come last.
    """
    spark = df.sparkSession
    by = layout.partition()
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = enter(df, layout, back, ahead).repartition(n, *by)
    writer = dealt.write.mode("overwrite").option("path", f"{path}/rows").bucketBy(n, *by).sortBy(*by, *layout.order)
    writer.saveAsTable(table)
    notes = (list(layout.keys), layout.time, list(layout.ties), layout.block_rows, layout.rows, layout.blocked, back, ahead)
    spark.createDataFrame([notes], NOTES).write.mode("overwrite").parquet(f"{path}/layout")


def read_series(spark: SparkSession, table: str, path: str) -> tuple[DataFrame, SeriesLayout]:
    """The rows and their layout; windows over them are computed where the buckets lie."""
    r = spark.read.schema(NOTES).parquet(f"{path}/layout").first()
    entered = (r["back"], r["ahead"]) if r["blocked"] else None
    return spark.table(table), SeriesLayout(tuple(r["keys"]), r["time"], r["block_rows"], rows=r["rows"], ties=tuple(r["ties"]), entered=entered)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Predictions, metrics and parameters are flat tables in Parquet, JSON lines or CSV."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)


def nested_to_rows(df: DataFrame, column: str, outer: str, inner: str, value: str) -> DataFrame:
    """A map of maps (target -> metric -> number) to one row per inner entry."""
    rest = [c for c in df.columns if c != column]
    once = df.select(*rest, F.explode(column).alias(outer, "_inner"))
    return once.select(*rest, outer, F.explode("_inner").alias(inner, value))


def parameter_rows(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ("model", "horizon")) -> DataFrame:
    """Wide parameters to one row per name; parameters a model does not use are left out."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])
    return df.select(*keep, F.inline(entries)).where(F.col("value").isNotNull())


def save_models(models: dict[int, PipelineModel], path: str) -> None:
    """One folder per horizon."""
    for horizon, model in models.items():
        model.write().overwrite().save(f"{path}/horizon={horizon}")


def load_models(path: str, horizons: Sequence[int]) -> dict[int, PipelineModel]:
    return {h: PipelineModel.load(f"{path}/horizon={h}") for h in horizons}
