"""A run's artifacts as rows and text: statistics, manifests, the selected document and an editable review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions.text import TRUNCATED

REVIEW_FIELDS = ("headline", "tldr", "body")


def items_stats(items: DataFrame) -> DataFrame:
    """One row: lines, bytes in all and of the longest line, texts present, cut and their longest."""
    line = F.octet_length(F.to_json(F.struct(*items.columns))) + 1
    has = F.coalesce("content_text", F.lit("")) != ""
    return items.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(line), F.lit(0)).alias("bytes"), F.coalesce(F.max(line), F.lit(0)).alias("longest_line"), F.count_if(has).alias("texts"),
        F.count_if(F.endswith(F.coalesce("content_text", F.lit("")), F.lit(TRUNCATED))).alias("cut"), F.coalesce(F.max(F.length("content_text")), F.lit(0)).alias("longest_text"),
    )


def manifest(run: str, window_start: Column, window_end: Column, stats: DataFrame, per_source: DataFrame) -> DataFrame:
    """One JSON envelope of a run: its window, its statistics and a struct a source, in order of name."""
    sources = per_source.agg(F.array_sort(F.collect_list(F.struct(*per_source.columns))).alias("sources"))
    rows = stats.join(sources, F.lit(True))  # one row each
    return rows.select(F.to_json(F.struct(F.lit("raw_manifest/1").alias("schema"), F.lit(run).alias("run"), window_start.alias("from"), window_end.alias("to"), F.struct(*stats.columns).alias("stats"), "sources")).alias("manifest"))


def selected_document(rows: DataFrame, decided_by: str) -> DataFrame:
    """One JSON document of a day's decision: kept rows by rank, the others with their reason."""
    kept = F.transform(F.array_sort(F.collect_list(F.when(F.col("status") == "kept", F.struct("rank", "item_key", "id")))), lambda x: F.struct(x["item_key"].alias("item_key"), x["id"].alias("id")))
    gone = F.array_sort(F.collect_list(F.when(F.col("status") != "kept", F.struct("item_key", F.col("status").alias("reason")))))
    return rows.agg(F.to_json(F.struct(F.lit("selected/1").alias("schema"), F.lit(decided_by).alias("decided_by"), kept.alias("kept"), gone.alias("dropped"))).alias("document"))


def export_review(items: DataFrame, order: str) -> DataFrame:
    """id, order and a markdown block of each item, with a header that ``import_review`` reads again."""
    block = F.concat(F.lit("## "), F.col("id"), F.lit("\n"), *[F.concat(F.lit(f"### {f}\n"), F.coalesce(f, F.lit("")), F.lit("\n")) for f in REVIEW_FIELDS])
    return items.select("id", order, block.alias("markdown"))


def import_review(blocks: DataFrame) -> DataFrame:
    """id and fields of edited blocks (a column markdown); a block without its headers stops the query."""
    m = F.col("markdown")
    field = lambda f: F.trim(F.regexp_extract(m, rf"(?s)\n### {f}\n(.*?)(?=\n### |$)", 1))
    sound = m.rlike(r"(?s)^## \S+\n") & F.forall(F.array(*[F.lit(f) for f in REVIEW_FIELDS]), lambda f: F.contains(m, F.concat(F.lit("\n### "), f, F.lit("\n"))))
    rows = blocks.where(F.when(sound, True).otherwise(F.raise_error(F.concat(F.lit("broken review block: "), F.substring(m, 1, 40))).cast("boolean")))
    return rows.select(F.regexp_extract(m, r"^## (\S+)\n", 1).alias("id"), *[field(f).alias(f) for f in REVIEW_FIELDS])


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes, sha256 of the files under a folder, hashed where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
