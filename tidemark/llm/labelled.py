"""Bounded samples of labelled documents for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 3, 1


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def labelled_sample(documents: DataFrame, labels: DataFrame, folds: tuple[int, ...], rows: int) -> DataFrame:
    """(text, label) of at most `rows` labels (doc_id, quality) in the given folds.

    Which ones is decided by a hash of the id, so reruns agree. Labels that are null, or whose id is
    null, are left out; equal labels count once. The ids, at most `rows` numbers, are broadcast.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & fold(F.col("doc_id")).isin(*folds))
    own = own.select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    own = own.withColumn("_h", F.xxhash64("doc_id"))
    every = max(1, own.agg(F.count(F.lit(1))).first()[0] // (2 * rows))
    few = own.where(F.pmod("_h", F.lit(every)) == 0).orderBy("_h", "doc_id", "label").limit(rows)
    found = documents.select("doc_id", "text").join(F.broadcast(few.drop("_h")), "doc_id")
    # Of several documents with one id, one is used: the sample stays bounded.
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")
