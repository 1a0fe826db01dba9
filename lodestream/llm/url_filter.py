"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed URL is a host with a path prefix. A page's URL is expanded into the keys under which it could be listed (its
host and each parent domain, with each path prefix), but only of label counts and prefix lengths that the list has.
The filter's blocks are a table of 512 bits a row: a probe is an equi-join on the block number with eight bit tests,
so that it stays in generated code. What passes meets the list itself in an exact hash join, which removes the
filter's false positives. The blocks and the list are broadcast only if their checked size is small; beyond that the
same joins shuffle, and adaptive execution splits hot keys. URLs are judged once per distinct (host, path).

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule; repeated rows are all
judged; an empty list or table gives the default verdict or no rows; further columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
WORDS_A_BLOCK, BITS_A_KEY, PROBES = 8, 12, 6
#: Up to so many listed URLs the list and its filter are broadcast: at most 2,000,000 * (12 bits + a URL) of memory.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(rule, verdict) pairs as a table of rule, host, path, verdict; a rule's host ends at its first slash."""
    values = ", ".join("('{}', '{}')".format(*(x.replace("\\", "\\\\").replace("'", "\\'") for x in r)) for r in rules)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(rule, verdict)") if rules else spark.sql("SELECT '' AS rule, '' AS verdict WHERE false")
    return table.select("rule", ascii_lower(F.substring_index("rule", "/", 1)).alias("host"), F.regexp_extract("rule", r"^[^/]*(.*)$", 1).alias("path"), "verdict")


def _mask(key: Column, word: int) -> Column:
    """The bits of one 64-bit word of a key's block that the key sets."""
    h = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511))
        one = F.expr("shiftleft(1L, cast({} as int))".format(f"shiftrightunsigned(xxhash64(key, 'bits'), {9 * i}) & 63"))
        mask = mask.bitwiseOR(F.when(F.shiftright(bit, 6) == word, one).otherwise(F.lit(0).cast("long")))
    return mask


def bloom_blocks(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """The filter of a column ``key``: one row of eight words for each block in use, and the number of blocks."""
    n_blocks = max(1, -(-n_keys * BITS_A_KEY // 512))
    masks = [F.bit_or(_mask(F.col("key"), w)).alias(f"w{w}") for w in range(WORDS_A_BLOCK)]
    return keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("block")).agg(*masks), n_blocks


def candidate_keys(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """host, path -> a row for each key under which they could be listed, of the given label counts and prefix lengths."""
    listed = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(cut).alias("cut")) for n, cut in shapes])
    fits = F.filter(listed, lambda s: (s["n"] <= F.size("parts")) & (s["cut"] <= F.length("path")))
    return (
        urls.withColumn("parts", F.split("host", r"\."))
        .withColumn("s", F.explode(fits))
        .withColumn("suffix", F.expr("array_join(slice(parts, size(parts) - s.n + 1, s.n), '.')"))
        .select("host", "path", F.concat("suffix", F.lit("\u0000"), F.expr("substring(path, 1, s.cut)")).alias("key"))
    )


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path of urls -> host, path, rule, verdict of the longest rule that fits; those that none fits are left out."""
    listed = rules.withColumn("key", F.concat("host", F.lit("\u0000"), "path"))
    n_rules = listed.count()
    if not n_rules:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    # the label counts and prefix lengths that occur together: never more than a URL has of each
    shapes = sorted(tuple(r) for r in listed.select(F.size(F.split("host", r"\.")), F.length("path")).distinct().collect())
    sized = F.broadcast if n_rules <= BROADCAST_RULES else lambda df: df
    blocks, n_blocks = bloom_blocks(listed.select("key"), n_rules)
    probes = candidate_keys(urls.distinct(), shapes).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)))
    passes = None
    for w in range(WORDS_A_BLOCK):
        mask = _mask(F.col("key"), w)
        test = F.col(f"w{w}").bitwiseAND(mask) == mask
        passes = test if passes is None else passes & test
    hits = probes.join(sized(blocks), "block").where(passes).select("host", "path", "key")
    exact = hits.join(sized(listed.select("key", "rule", F.col("verdict"))), "key")
    best = F.max(F.struct(F.length("rule").alias("len"), "rule", "verdict")).alias("best")
    return exact.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to pages; columns of those names are replaced."""
    split = pages.drop("host", "path", "rule", "verdict") if url not in ("host", "path", "rule", "verdict") else pages
    split = split.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = match_rules(split.select("host", "path"), rules)
    return split.join(found, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, rhost, rpath, rverdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
      ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT s.page_id, s.host, s.path, r.rule, r.rverdict, row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
      FROM s LEFT JOIN r ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1
"""
