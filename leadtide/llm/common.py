"""What the operators share: reading, written tables, row keys and free names."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.session import scratch_table

#: The white space of the contracts: [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and no row is computed twice."""
    path = scratch_table(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*cols: str | Column) -> Column:
    """A 64-bit key of what a row says. It stands in for ids that may be null or repeated, so use it
    only where rows that share a key by accident do no harm."""
    return F.xxhash64(*cols)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once a row however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have in any case of letters."""
    known = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out


def blobs(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, null as empty."""
    return [b or b"" for b in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]
