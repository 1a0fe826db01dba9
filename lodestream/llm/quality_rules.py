"""Quality rules as a bitmask ledger.

``measure`` reads each text once and yields its measurements; ``ledger`` evaluates every rule once and stores the
failures as bits of one long beside the measurements. A policy is a versioned set of rules, hence a mask: applying
one, or computing what a rule alone removes (ablation), is bitwise work on the ledger that never reads a text again.
All of it is built-in functions; nothing is shuffled but the ablation's few sums.

Defined cases: a null or empty text has no words, measures 0 everywhere and fails ``few_words``; texts of any length
are measured whole; repeated rows each get their row; an empty table gives none; of ``ledger``, columns named like a
measurement or ``failures`` are replaced, others pass whatever their names; ``keep_good`` returns all as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, WORD_GAP, carry, expand, read, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_repeat_words")
#: Bit, name and failure condition of each rule; integers only, so that no rounding decides.
RULES: tuple[tuple[int, str, str], ...] = (
    (0, "few_words", "n_words < 50"),
    (1, "repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    (2, "symbols", "10 * n_symbols > n_words"),
    (3, "repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 4 * n_lines"),
    (4, "shouting", "10 * n_upper > 3 * word_chars"),
    (5, "word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
)
SYMBOLS = "#*$%&|<>"
POLICIES = {"base-1": ("few_words", "repeated_trigrams"), "standard-1": tuple(name for _, name, _ in RULES)}


def policy_mask(policy: str) -> int:
    bits = {name: bit for bit, name, _ in RULES}
    return sum(1 << bits[name] for name in POLICIES[policy])


def _windows(w: str) -> Column:
    """A 64-bit fingerprint for every three-word window of the array column w."""
    return F.expr(f"transform(slice({w}, 1, greatest(size({w}) - 2, 0)), (x, i) -> xxhash64(x, {w}[i + 1], {w}[i + 2]))")


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """The carried rows of docs with the measurements of MEASURES.

    n_repeat_words: windows are sorted with their positions; those equal to a neighbour repeat, and the words that the
    repeats cover are counted from the gaps between their positions. Texts without a repeat skip the sort.
    """
    carried = carry(docs)
    t = F.coalesce(F.col(ROW)[text], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    first = carried.withColumns({"_w": words(t), "_l": lines})
    second = first.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": (F.char_length(t) - F.regexp_count(t, F.lit(WORD_GAP))).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "_h": _windows("_w"),
    }).drop("_w", "_l")
    third = second.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.expr("array_sort(transform(_h, (h, i) -> struct(h as h, i as i)))")))
    repeats = "filter(_s, (x, k) -> x.h = get(_s, k + 1).h or (k > 0 and x.h = get(_s, k - 1).h))"
    fourth = third.withColumn("_p", F.expr(f"sort_array(transform({repeats}, x -> x.i))"))
    covered = F.expr("aggregate(zip_with(_p, slice(_p, 2, greatest(size(_p), 1)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (s, x) -> s + x)")
    # a later filter on a measurement must not be pushed below it: its arrays would be computed anew inside the lambdas
    fifth = fourth.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_s", "_p")
    return fifth.withColumn("_at", F.monotonically_increasing_id()).where("_at >= 0").drop("_at")


def _ledger(docs: DataFrame, text: str) -> DataFrame:
    failures = " | ".join(f"if({condition}, {1 << bit}L, 0L)" for bit, _, condition in RULES)
    return _measured(docs, text).withColumn("failures", F.expr(failures))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with their measurements and ``failures``, the bits of the rules that they fail."""
    return expand(_ledger(docs, text), [*MEASURES, "failures"])


def passes(policy: str) -> Column:
    """Over a ledger: whether a row passes the policy."""
    return F.col("failures").bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: how many rows fail it, fail it alone, and are kept with and without it."""
    mask = policy_mask(policy)
    failed = F.col("failures").bitwiseAND(F.lit(mask))
    own = [(bit, name) for bit, name, _ in RULES if mask >> bit & 1]
    sums = rows.groupBy(failed.alias("failed")).agg(F.count("*").alias("n"))  # at most 2 ** rules rows
    per_rule = sums.select("failed", "n", F.explode(F.array(*[F.struct(F.lit(1 << b).alias("bit"), F.lit(n).alias("rule")) for b, n in own])).alias("r")).groupBy("r.rule")
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return per_rule.agg(count(hit)("n_failed"), count(F.col("failed") == F.col("r.bit"))("n_failed_alone"), count(F.col("failed") == 0)("n_kept"), count((F.col("failed") == 0) | (F.col("failed") == F.col("r.bit")))("n_kept_without"))


def keep_good(docs: DataFrame, policy: str = "standard-1") -> DataFrame:
    """The rows of docs that pass the policy, with the columns of docs."""
    return expand(_ledger(docs, "text").where(passes(policy)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ~passes("base-1")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), passes("standard-1").alias("kept"), "failures", "n_lines", "n_upper")


ORACLE = r"""
WITH w AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, row(ws[i], ws[i + 1], ws[i + 2]) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines, len(regexp_extract_all(coalesce(text, ''), '\p{Lu}'))::BIGINT AS n_upper
    FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_upper > 3 * word_chars THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 32 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures, n_lines, n_upper FROM f
"""
