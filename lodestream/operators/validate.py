"""Contract checks as tables of violations: rule, level, place, message."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, rule: str, place: Column, message: Column, level: str = "error") -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(level).alias("level"), place.cast("string").alias("place"), message.alias("message"))


def missing_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str, rule: str) -> DataFrame:
    """Rows whose key no parent has."""
    gone = child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return violations(gone, rule, F.col(key), F.lit("no such parent"))


def repeated_keys(rows: DataFrame, key: str, rule: str) -> DataFrame:
    many = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return violations(many, rule, F.col(key), F.concat(F.lit("times "), F.col("n").cast("string")))


def unequal_sets(left: DataFrame, right: DataFrame, key: str, rule: str) -> DataFrame:
    """Keys of one side only."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    apart = a.join(b, key, "full_outer").where("_a is null or _b is null")
    return violations(apart, rule, F.col(key), F.when(F.col("_a").isNull(), "right only").otherwise("left only"))


def broken(rows: DataFrame, rule: str, place: Column, *checks: tuple[str, Column], level: str = "error") -> DataFrame:
    """Rows that fail a named condition, once a condition; null counts as failing."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), name) for name, c in checks]))
    return violations(rows.withColumn("_failed", F.explode(failed)), rule, place, F.col("_failed"), level)


def quarantine(rows: DataFrame, *checks: tuple[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all conditions, and the others with the names of those they fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), name) for name, c in checks]))
    marked = rows.withColumn("errors", failed)
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0)


def one_primary(rows: DataFrame, group: str, primary: str, rule: str) -> DataFrame:
    counts = rows.groupBy(group).agg(F.count_if(F.col(primary)).alias("n")).where("n <> 1")
    return violations(counts, rule, F.col(group), F.concat(F.lit("primaries "), F.col("n").cast("string")))


def hash_mismatches(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows (path, sha256) against files (path, content): missing or changed."""
    have = files.select("path", F.sha2("content", 256).alias("_have"))
    rows = manifest.join(have, "path", "left").where(F.col("_have").isNull() | (F.col("_have") != F.col("sha256")))
    return violations(rows, "manifest-hash", F.col("path"), F.when(F.col("_have").isNull(), "missing").otherwise("sha mismatch"))


def report(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def summary(found: DataFrame) -> DataFrame:
    """rule, level, n; a run is sound if there is no row of level error."""
    return found.groupBy("rule", "level").agg(F.count("*").alias("n"))
