"""A corpus pipeline of the text operators.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and is written as Parquet below the shared folder before the next one reads
it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import exact_dedup, jaccard_join, mixing, pieces, toxicity
from matchlake.llm.common import bounded_batches, documents, gathered, labels, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    bounded_batches(spark)
    return gathered(toxicity.drop_toxic(docs, labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest doc_id stays."""
    bounded_batches(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 on five-word runs stays."""
    bounded_batches(spark)
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    bounded_batches(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    bounded_batches(spark)
    e = pieces.encode(docs.select("doc_id", "source", "text"))
    return gathered(
        e.selectExpr("doc_id", "source", "ids", "cast(coalesce(size(ids), 0) as bigint) AS n_tokens", "piece_score")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Fitted models and tokenisers have no SQL form: tests hold the rows against
#: brute force, stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
