"""Content hashes and the two 64-bit simhashes.

``stored_features`` are English words and single CJK characters; ``display_features`` are CJK bigrams, English words
and adjacent English word pairs within a run that only CJK breaks. Both are hashed by the first 64 bits of sha1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[a-z0-9]+|[\\u4e00-\\u9fff]"
RUN = "[a-z0-9]+|[\\u4e00-\\u9fff]+"
SEPARATOR = "\u001f"


def sha16(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def content_sha(title: Column, date: Column, text: Column, source: Column) -> Column:
    return sha16(F.concat_ws(SEPARATOR, *[F.coalesce(c, F.lit("")) for c in (title, date, text, source)]))


def stored_features(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def _bigrams(run: Column) -> Column:
    return F.when(F.length(run) == 1, F.array(run)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))), lambda i: F.substring(run, i, F.lit(2))))


def display_features(text: Column) -> Column:
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(RUN), 0)
    is_cjk = lambda r: r.rlike("^[\\u4e00-\\u9fff]")
    single = F.flatten(F.transform(runs, lambda r: F.when(is_cjk(r), _bigrams(r)).otherwise(F.array(r))))
    after = F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0)))
    pairs = F.zip_with(runs, after, lambda a, b: F.when(b.isNotNull() & ~is_cjk(a) & ~is_cjk(b), F.concat(a, F.lit(" "), b)))
    return F.concat(single, F.array_compact(pairs))


def title_tokens(text: Column) -> Column:
    """The set of English words and CJK bigrams, lone characters kept."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(RUN), 0)
    return F.array_distinct(F.flatten(F.transform(runs, lambda r: F.when(r.rlike("^[\\u4e00-\\u9fff]"), _bigrams(r)).otherwise(F.array(r)))))


def sha1_64(text: Column) -> Column:
    """The first eight bytes of sha1 as a signed long."""
    h = F.sha1(text)
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def simhash(df: DataFrame, key: str, features: Column, name: str = "simhash") -> DataFrame:
    """key -> signed 64-bit simhash of an array of features; no feature gives 0.

    A key's features never meet as a list and are not shuffled: tasks count, for each key, how many hashes have a bit
    set. A sum holds two counts, of bit i below and of bit i + 32 from bit 32 on; a text has far fewer than 2^32 features.
    """
    hashed = df.select(key, F.explode(features).alias("_f")).select(key, sha1_64(F.col("_f")).alias("_h"))
    both = lambda i: F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(0x100000001))).alias(f"_v{i}")
    votes = hashed.groupBy(key).agg(F.count("*").alias("_n"), *[both(i) for i in range(32)])
    bits = F.lit(0).cast("long")
    for i in range(64):
        ones = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(F.col(f"_v{i - 32}"), 32)
        bits = bits.bitwiseOR(F.when(2 * ones > F.col("_n"), F.expr(f"shiftleft(1L, {i})")).otherwise(F.lit(0).cast("long")))
    return df.select(key).distinct().join(votes.select(key, bits.alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
