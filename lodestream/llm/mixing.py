"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

``water_fill`` works on one row per source. Sources are filled in the order of cap / weight, in which the capped ones
come first: the level at which the rest share what is left by weight is found from running sums, the fixed point of
redistributing excess until no source is above its cap. ``mix`` repeats a source whole as often as its epochs say, and
for the remaining fraction takes documents in the order of a seeded hash until their words fill it. That order is cut
into 1024 buckets per source: bucket sums decide for whole buckets, and only the documents of the one bucket that the
cut falls into are ordered, so no task ever sorts a source; texts are never shuffled. Reruns agree: the hash depends on id and text alone.

Defined cases: null texts have size 0, take 0 words and never change a sum; a null source is a source of its own, last
in order; a source without words has target 0; repeated rows are documents of their own; ties of the hash are broken by
doc_id and else taken together; an empty table gives no rows; columns of a caller pass whatever their names: ``mix``
replaces those named size, source_size, target and reps, ``repeat_rows`` returns all as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, carry, expand, materialize, read, words

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (5, 2, 1), 1.5, 2.0, 17
#: Up to so many sources their rows, some 100 bytes each, are broadcast.
BROADCAST_SOURCES = 100_000
BUCKET_BITS, KEY_BITS = 10, 60
ADDED = ("size", "source_size", "target", "reps")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source -> weight: the weights repeat over the sources by code point, null last."""
    order = Window.orderBy(F.encode("source", "UTF-8").asc_nulls_last())
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int")))


def water_fill(sources: DataFrame, total: Column, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds target to source, source_size, weight: total shared by weight, none above max_epochs of its size.

    total is an expression over the sums column all_size. The windows hold one row per source of the mixture.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.orderBy("ratio", F.encode("source", "UTF-8").asc_nulls_last())
    ahead, rest, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = sources.withColumn("cap", cap).withColumn("ratio", ratio).withColumn("all_size", F.sum("source_size").over(whole)).withColumn("total", total)
    left = F.greatest(F.col("total") - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0)), F.lit(0.0))
    filled = filled.withColumn("level", F.when(F.sum("weight").over(rest) > 0, left / F.sum("weight").over(rest)))
    # a source is capped if the level it would be filled to with all after it lies at or above its ratio
    filled = filled.withColumn("capped", F.coalesce(F.col("level") >= F.col("ratio"), F.lit(False)))
    settled = filled.withColumn("final", F.min(F.when(~F.col("capped"), F.struct("ratio", F.encode("source", "UTF-8"), "level"))).over(whole)["level"])
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.coalesce(F.col("final") * F.col("weight"), F.lit(0.0)))
    return settled.withColumn("target", target).drop("cap", "ratio", "all_size", "total", "level", "capped", "final")


def _mixed(docs: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float, seed: int) -> DataFrame:
    """The carried rows of docs with the columns of ADDED."""
    row = F.col(ROW)
    marked = F.concat(F.lit(f"{seed}\u001f"), F.coalesce(row["doc_id"].cast("string"), F.lit("")), F.lit("\u001f"), F.coalesce(row["text"], F.lit("")))
    key = F.conv(F.substring(F.md5(marked.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")
    own = {"_doc": row["doc_id"], "_source": row["source"], "size": F.size(words(row["text"])).cast("long"), "_key": key}
    bits = lambda level: F.shiftright("_key", KEY_BITS - (level + 1) * BUCKET_BITS)  # noqa: E731  # in the order of _key
    keyed = carry(docs).withColumns(own).withColumns({"_bucket": bits(0), "_inner": bits(1)})
    narrow = keyed.select(F.col("_doc").alias("doc_id"), F.col("_source").alias("source"), "size", "_key", "_bucket", "_inner")
    buckets = materialize(narrow.groupBy("source", "_bucket").agg(F.sum("size").alias("_words")))
    per_source = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    filled = water_fill(cyclic_weights(per_source, weights), F.col("all_size") * F.lit(float(share)), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    filled = filled.withColumn("_whole", F.floor(epochs)).withColumn("_part", F.col("target") - F.col("_whole") * F.col("source_size"))
    filled = materialize(filled.drop("weight"))
    # one row a source of the mixture: broadcast where that is a checked small number
    sized_join = F.broadcast if filled.count() <= BROADCAST_SOURCES else lambda df: df
    outer = materialize(_cut(buckets, filled, "_part", "_bucket"))
    in_outer = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d._bucket") == F.col("p._cut._bucket"))
    again = narrow.alias("d").join(sized_join(outer.alias("p")), in_outer).select("d.*")
    lefts = outer.where("_cut is not null").select("source", F.col("_cut._left").alias("_rest"))
    plan = materialize(_cut(again.groupBy("source", "_inner").agg(F.sum("size").alias("_words")), lefts, "_rest", "_inner"))
    in_inner = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d._inner") == F.col("p._cut._inner"))
    at_cut = narrow.alias("d").join(sized_join(plan.alias("p")), in_inner).select("d.*", F.col("_cut._left").alias("_left"))
    inside = Window.partitionBy("source", "_inner").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = at_cut.withColumn("_run", F.sum("size").over(inside)).where("_run - size / 2 <= _left")
    last = taken.groupBy("source").agg(F.max(F.struct("_key", F.col("doc_id").alias("_doc"))).alias("_last"))
    same = lambda df, name: df.withColumnRenamed("source", name)
    named = lambda df, name: df.select(F.col("source").alias(name), F.col("_full").alias(f"{name}_full"), F.col("_cut").alias(f"{name}_cut"))
    is_source = lambda name: F.col("source").eqNullSafe(F.col(name))
    choice = filled.join(named(outer, "_s1"), is_source("_s1"), "left").join(named(plan, "_s2"), is_source("_s2"), "left").join(same(last, "_s3"), is_source("_s3"), "left")
    choice = materialize(choice.select(F.col("source").alias("_s"), "source_size", "target", "_whole", F.col("_s1_full").alias("_full"), F.col("_s1_cut._bucket").alias("_at"), F.col("_s2_full").alias("_inner_full"), F.col("_s2_cut._inner").alias("_inner_at"), "_last"))
    found = keyed.join(sized_join(choice), F.col("_source").eqNullSafe(F.col("_s")))
    in_bucket = F.col("_bucket") == F.col("_at")
    whole_bucket = F.coalesce(F.col("_bucket") <= F.col("_full"), F.lit(False)) | F.coalesce(in_bucket & (F.col("_inner") <= F.col("_inner_full")), F.lit(False))
    in_cut = F.coalesce((F.col("_inner") == F.col("_inner_at")) & (F.struct("_key", "_doc") <= F.col("_last")), F.lit(False))
    reps = F.least(F.col("_whole") + F.when(whole_bucket | in_cut, 1).otherwise(0), F.lit(int(max_epochs)))
    return found.select(ROW, "size", "source_size", "target", reps.cast("int").alias("reps"))


def _cut(buckets: DataFrame, sources: DataFrame, left: str, bucket: str) -> DataFrame:
    """Per source the last bucket that its words (a column of sources) fill whole, and the one that they end in with
    what is left there. buckets: source, bucket, _words."""
    before = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    rows = buckets.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select("b.source", bucket, "_words", left)
    rows = rows.withColumn("_left", F.col(left) - F.coalesce(F.sum("_words").over(before), F.lit(0)))
    full, cut = (F.col("_left") > 0) & (F.col("_left") >= F.col("_words")), (F.col("_left") > 0) & (F.col("_left") < F.col("_words"))
    return rows.groupBy("source").agg(F.max(F.when(full, F.col(bucket))).alias("_full"), F.max(F.when(cut, F.struct(bucket, "_left"))).alias("_cut"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Adds size, source_size, target and reps to docs (doc_id, text, source): how often the mix takes each document."""
    return expand(_mixed(docs, weights, share, max_epochs, seed), ADDED)


def repeat_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Each row of docs as often as the mix takes it, with the columns of docs."""
    mixed = _mixed(docs, weights, share, max_epochs, seed).where("reps > 0")
    return expand(mixed.select(ROW, F.explode(F.sequence(F.lit(1), "reps"))).select(ROW))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"), "source")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5('{SEED}' || chr(31) || coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, {KEY_BITS // 4}))::UBIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, {list(WEIGHTS)}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT]::DOUBLE AS weight, source_size * {MAX_EPOCHS}::DOUBLE AS cap, {SHARE}::DOUBLE * sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, cap / weight AS ratio, greatest(total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, CASE WHEN level >= ratio THEN cap ELSE (SELECT level FROM l WHERE level < ratio ORDER BY ratio, source NULLS LAST LIMIT 1) * weight END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS part, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS run FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * least(whole + CASE WHEN part > 0 AND run - size / 2 <= part THEN 1 ELSE 0 END, {int(MAX_EPOCHS)}))::BIGINT AS taken, source FROM r
"""
