"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD = 4, 2


def labelled(docs: DataFrame, labels: DataFrame, column: str, size: int, seed: int, keep=()) -> DataFrame:
    """doc_id, text, label of about ``size`` labelled documents outside the
    held-out fold, drawn by a seeded hash of the id.

    At most about ``size`` label rows are drawn (their share comes from a
    count), so sending them to the documents is bounded by the parameter.
    Conflicting labels of an id count by their majority, ties as 1; null
    labels and ids are left out.
    """
    train = labels.where(
        F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (common.fold("doc_id", FOLDS) != HELD)
    )
    n = train.count()
    share = int(min(1.0, size / max(n, 1)) * (1 << 30))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30))
    drawn = train.where(draw < share).groupBy("doc_id").agg(
        (F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("label")
    )
    texts = docs.select(F.col("doc_id").alias("d_id"), "text", *keep)
    return texts.join(F.broadcast(drawn), F.col("d_id") == F.col("doc_id")).select(
        "doc_id", "text", F.col("label").cast("int").alias("label"), *keep
    )


def collected(features: DataFrame) -> pa.Table:
    """Features of a bounded sample, in the order of their ids."""
    return features.toArrow().combine_chunks().sort_by([("doc_id", "ascending"), ("row", "ascending")])
