"""Labelled rows for the classifiers: a bounded sample, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, materialize

#: Labels are learned from at most so many rows, those of the least seeded hashes of doc_id.
SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id="doc_id"):
    return crc_fold(F.col(doc_id), FOLDS) == HELD_OUT


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, label of a sample of the labelled documents outside the held-out fold.

    A doc_id with several labels counts once, by the largest; null labels and ids are left out. At most ``rows`` ids
    are chosen, 16 bytes each, and broadcast to the documents.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    chosen = known.where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(rows)
    chosen = materialize(chosen)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return found.join(F.broadcast(chosen), "doc_id")
