"""A corpus through five stages: toxicity, exact dedup, near-dedup, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and gives a DataFrame, which
is written as Parquet and read again as the next stage's docs. All stages but the last return the
columns of documents: the filters drop rows, mixing puts all rows in training order. No stage needs
rows to be distinct, texts or ids to be there, or columns beside doc_id, text and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadtide.llm import exact, mixing, near, packing, toxicity
from leadtide.llm.common import documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the chain rejects. It learns from the labelled rows of ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ in white space only, keep the longest."""
    return exact.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, keep the first."""
    return near.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, sources interleaved by their shares."""
    return mixing.in_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of tokens, numbered along the mix.

    A reader deals files out by their size, so the order of the mix is derived anew from the rows.
    """
    ordered = mixing.in_order(docs.select("doc_id", "text", "source"))
    return packing.piece_digests(packing.pack_documents(ordered))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The first stage is a trained model; tests/llm compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
