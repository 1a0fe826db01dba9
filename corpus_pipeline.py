"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token ids.

Every stage takes (spark, docs, sf_dir); run() writes each stage's rows to the shared folder and reads them again, so a
stage starts from files and not from the lineage of those before it.

Defined cases, in every stage: null and empty texts have no words, so the quality rules reject them; in a later stage
they link with nothing, hold no item, have size 0 and an end id alone. A null doc_id is kept by the two stages that
match by id, as it can't be told apart. Texts of any length are read whole. Rows repeated whole stay or go together;
several texts under one doc_id are judged each by itself in quality and near-dedup, and together in decontamination.
Ties go to the least doc_id. An empty table passes through all stages as none. Extra columns pass whatever their names,
up to the last stage, which returns its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestream.llm import decontaminate, minhash, mixing, quality_rules, token_ids
from lodestream.llm.common import materialize, read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the standard policy of the rule ledger."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id."""
    return minhash.drop_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_rows(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the id files hold of each row: doc_id, start, n_tokens, ids_crc32."""
    return token_ids.encode_and_read(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]
#: SQL can't encode with a tokenizers file; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
