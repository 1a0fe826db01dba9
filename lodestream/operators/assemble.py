"""Tables put together from a run's parts: items with their verdicts and summaries, candidates, kept items, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.vectors import cosine
from lodestream.operators.pool import latest_by

LEAK, SAMPLE, LEAST_CHARS = 0.95, 8, 8


def load_items(raw: DataFrame, filtered: DataFrame, summaries: DataFrame, order: str) -> DataFrame:
    """Summaries with their raw item and verdict; of repeated keys the last counts, and a missing field falls back to the raw one."""
    last = lambda df: latest_by(df, "item_key", F.col(order)).drop(order)
    r = last(raw).select("item_key", F.col("title").alias("_title"), F.col("content_text").alias("_text"), "url", "date_published", "source_name")
    f = last(filtered).select("item_key", "news_value", "ai_relevance", F.col("verdict").alias("filter_verdict"))
    joined = summaries.join(r, "item_key", "left").join(f, "item_key", "left")
    return joined.withColumns({"title_zh": F.coalesce(F.nullif("title_zh", F.lit("")), "_title", F.lit("")), "summary": F.coalesce(F.nullif("summary", F.lit("")), F.substring("_text", 1, 120), F.lit(""))}).drop("_title", "_text")


def gate(items: DataFrame, dedup: DataFrame, eligibility: Column) -> DataFrame:
    """Items with their place at the gate: skipped (dropped, or no window), suppressed, or kept, and the reason."""
    rows = items.join(dedup.select("item_key", F.col("verdict").alias("dedup")), "item_key", "left").withColumn("_e", eligibility)
    place = F.when(F.col("filter_verdict") == "drop", "skipped").when(~F.col("_e.ok"), "skipped").when(F.col("dedup") == "suppressed", "suppressed").otherwise("kept")
    reason = F.when(F.col("filter_verdict") == "drop", "dropped").when(~F.col("_e.ok"), F.col("_e.reason")).otherwise(F.coalesce("dedup", F.lit("gray")))
    return rows.withColumns({"place": place, "reason": reason, "recommended": (place == "kept") & (F.col("filter_verdict") == "keep") & F.coalesce(F.col("dedup").isin("fresh", "reissue"), F.lit(False))}).drop("_e")


def kept_items(selected: DataFrame, current: DataFrame, carried: DataFrame) -> DataFrame:
    """The selected keys, in order, with the current run's row or else the carried one; a key without either stops the query."""
    both = current.withColumn("_p", F.lit(0)).unionByName(carried.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    first = both.withColumn("_n", F.row_number().over(Window.partitionBy("item_key").orderBy("_p"))).where("_n = 1").drop("_n", "_p").withColumn("_found", F.lit(True))
    rows = selected.join(first, "item_key", "left")
    return rows.where(F.coalesce(F.col("_found"), F.raise_error(F.concat(F.lit("selected item is missing: "), F.col("item_key"))).cast("boolean"))).drop("_found")


def find_ids(members: DataFrame, keys: DataFrame, episode: Column) -> DataFrame:
    """item_id of keys: those of the episode, and for keys without one there, all."""
    found = members.join(keys.select("item_key").distinct(), "item_key")
    here = F.max((F.col("day") == episode).cast("int")).over(Window.partitionBy("item_key"))
    return found.withColumn("_here", here).where((F.col("_here") == 0) | (F.col("day") == episode)).select("item_key", "item_id")


def item_keys(issue: DataFrame, selected: DataFrame, by_url: DataFrame) -> DataFrame:
    """id -> item_key: the issue's own, else the selection's, else that of its URL."""
    rows = issue.join(selected.select("id", F.col("item_key").alias("_s")), "id", "left").join(by_url.select("url", F.col("item_key").alias("_u")), "url", "left")
    return rows.select("id", F.coalesce("item_key", "_s", "_u").alias("item_key"))


def primary_sources(rows: DataFrame, group: str, url: str, order: str, primary: str) -> DataFrame:
    """A group's sources, each URL once, with exactly one primary: the first that says so, else the first."""
    once = rows.withColumn("_d", F.row_number().over(Window.partitionBy(group, url).orderBy(order))).where("_d = 1").drop("_d")
    w = Window.partitionBy(group).orderBy((~F.coalesce(F.col(primary), F.lit(False))).cast("int"), order)
    return once.withColumn(primary, F.row_number().over(w) == 1)


def leak_audit(sentences: DataFrame, sources: DataFrame, key: str, most: float = LEAK) -> DataFrame:
    """Sentences (key, vector) closer than ``most`` to their own source's vector."""
    joined = sentences.join(sources.select(key, F.col("vector").alias("_v")), key)
    return joined.withColumn("cos", cosine(F.col("vector"), F.col("_v"))).where(F.col("cos") > most).drop("_v")


def sample_sentences(rows: DataFrame, group: str, order: str, text: str, n: int = SAMPLE) -> DataFrame:
    """Every k-th long enough sentence of a group, n at most."""
    long = rows.where(F.length(text) >= LEAST_CHARS)
    w = Window.partitionBy(group)
    numbered = long.withColumn("_i", F.row_number().over(w.orderBy(order)) - 1).withColumn("_all", F.count("*").over(w))
    stride = F.greatest(F.floor(F.col("_all") / n), F.lit(1))
    return numbered.where((F.pmod(F.col("_i"), stride) == 0) & (F.col("_i") / stride < n)).drop("_i", "_all")


def link_audit(links: DataFrame, statuses: DataFrame) -> DataFrame:
    """url, class, n, owners (at most 20, in order): every distinct URL of the items with its class."""
    counts = links.groupBy("url").agg(F.count("*").alias("n"))
    first = links.select("url", "id").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy("id"))).where("_n <= 20")
    owners = counts.join(first.groupBy("url").agg(F.array_sort(F.collect_list("id")).alias("owners")), "url", "left")
    return owners.join(statuses.select("url", "class"), "url", "left").select("url", F.coalesce("class", F.lit("unchecked")).alias("class"), "n", "owners")


def alerts(flags: DataFrame, first: int = 8) -> DataFrame:
    """kind, n, first messages: the most frequent flags first."""
    w = Window.partitionBy("kind").orderBy("id")
    rows = flags.withColumn("_n", F.row_number().over(w))
    shown = F.array_sort(F.collect_list(F.when(F.col("_n") <= first, F.struct("_n", "message"))))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.transform(shown, lambda x: x["message"]).alias("messages")).orderBy(F.desc("n"), "kind")
