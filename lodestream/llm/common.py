"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.plans import storage
from lodestream.plans.storage import read, shared_dir

__all__ = ["BROADCAST_IDS", "ROW", "ascii_lower", "carry", "crc_fold", "expand", "materialize", "read", "shared_dir", "without_ids", "without_rows", "words"]

#: Java character class of the bytes that separate words: space and U+0009 to U+000D.
WORD_GAP = r"[ \t-\r]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of a batch that Spark hands to a Python worker while a step is written: JVM and worker hold it several times.
ARROW_BYTES, _ARROW = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def materialize(df: DataFrame) -> DataFrame:
    """storage.materialize with small batches for the Python workers; the session's own setting is back afterwards."""
    conf = df.sparkSession.conf
    before = conf.get(_ARROW)
    conf.set(_ARROW, ARROW_BYTES)
    try:
        return storage.materialize(df)
    finally:
        conf.set(_ARROW, before)


#: Up to so many ids, 8 bytes each, are broadcast; beyond that the join shuffles.
BROADCAST_IDS = 1_000_000


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in ids (one column of distinct longs); all columns stay, whatever their names."""
    return _without(docs, ids.toDF("_gone"), lambda row, gone: row["doc_id"].cast("long") == gone["_gone"])


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without the rows of these ids and texts: rows has distinct doc_id and xxhash64 of the text."""
    return _without(docs, rows.toDF("_gone", "_text"), lambda row, gone: (row["doc_id"].cast("long") == gone["_gone"]) & (F.xxhash64(row["text"]) == gone["_text"]))


def _without(docs: DataFrame, gone: DataFrame, same: Callable[[Column, DataFrame], Column]) -> DataFrame:
    gone = materialize(gone.where("_gone is not null"))
    sized = F.broadcast if gone.count() <= BROADCAST_IDS else lambda df: df
    return expand(carry(docs).join(sized(gone), same(F.col(ROW), gone), "left_anti"))


#: The column in which an operator carries a caller's whole row past its own columns, whatever the caller's are named.
ROW = "__carried_row"


def carry(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def expand(df: DataFrame, added: Sequence[str] = (), but: Sequence[str] = ()) -> DataFrame:
    """The carried columns again, then those of added, which replace carried ones of their names; without those of but."""
    gone = {c.lower() for c in (*added, *but)}
    own = [c for c in df.schema[ROW].dataType.names if c.lower() not in gone]
    return df.select(*[F.col(ROW)[c].alias(c) for c in own], *added)


def words(text: Column) -> Column:
    """The words of a text, null and empty texts having none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP + "+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
