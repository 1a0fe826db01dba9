"""Writes to the store of clusters and their members: each gives the next tables, set by set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.vectors import mean_unit
from lodestream.operators.assemble import find_ids
from lodestream.operators.dedup import EMPTY_SHA1, TTL_DAYS, expire, recompute_clusters
from lodestream.operators.pool import mark_used

MEMBER = ("item_id", "cluster_id", "day", "url_hash", "verdict", "vector")


def _named(hash_: Column) -> Column:
    return ~F.coalesce(hash_, F.lit("")).isin("", EMPTY_SHA1)


def insert_members(members: DataFrame, new: DataFrame) -> DataFrame:
    """new with stored_id and inserted: of rows of one url_hash and day only the first is stored, and none where the
    store has one already; the others take that row's id. Rows without a hash are all stored."""
    known = members.where(_named(F.col("url_hash"))).groupBy("url_hash", "day").agg(F.min("item_id").alias("_known"))
    first = new.where(_named(F.col("url_hash"))).groupBy("url_hash", "day").agg(F.min("item_id").alias("_first"))
    rows = new.join(known, ["url_hash", "day"], "left").join(first, ["url_hash", "day"], "left")
    stored = F.coalesce("_known", "_first", "item_id")
    return rows.withColumns({"stored_id": stored, "inserted": stored == F.col("item_id")}).select(*new.columns, "stored_id", "inserted")


def attach(members: DataFrame, clusters: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with the new ones that were stored, and clusters with those alone merged in: the mean of all their
    vectors, counts, reissues; last_seen and expires_at only ever move ahead.

    clusters: cluster_id, centroid, item_count, n_reissues, last_seen, expires_at.
    """
    kept = insert_members(members, new).where("inserted")
    sums = kept.groupBy("cluster_id").agg(F.count("*").alias("_n"), F.count_if(F.col("verdict") == "reissue").alias("_r"), F.max("day").alias("_day"))
    each = kept.select("cluster_id", F.posexplode("vector").alias("place", "x")).groupBy("cluster_id", "place").agg(F.sum("x").alias("x"))
    vectors = each.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda v: v["x"]).alias("_sum"))
    rows = clusters.join(sums, "cluster_id", "left").join(vectors, "cluster_id", "left")
    total = F.zip_with("centroid", "_sum", lambda c, x: c * F.col("item_count") + x)
    norm = F.sqrt(F.aggregate(total, F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.withColumn("centroid", F.when(F.col("_n").isNull(), F.col("centroid")).when(norm > 0, F.transform(total, lambda x: x / norm)).otherwise(total))
    day = F.coalesce(F.col("_day"), F.col("last_seen"))
    rows = rows.withColumns({
        "item_count": F.col("item_count") + F.coalesce("_n", F.lit(0)), "n_reissues": F.col("n_reissues") + F.coalesce("_r", F.lit(0)), "last_seen": F.greatest("last_seen", day),
        "expires_at": F.when(F.col("_day").isNull(), F.col("expires_at")).otherwise(F.greatest("expires_at", F.date_add("_day", TTL_DAYS))),
    })
    return members.unionByName(kept.select(*members.columns)), rows.select(*clusters.columns)


def mark_reported(members: DataFrame, clusters: DataFrame, keys: DataFrame, episode: Column) -> tuple[DataFrame, DataFrame]:
    """The episode's items of these keys as reported, and their clusters as published."""
    hit = find_ids(members, keys, episode).select("item_id").distinct().withColumn("_hit", F.lit(True))
    marked = members.join(hit, "item_id", "left")
    out = marked.withColumns({"verdict": F.when(F.col("_hit"), "reported").otherwise(F.col("verdict")), "episode": F.when(F.col("_hit"), episode.cast("string")).otherwise(F.col("episode"))})
    published = marked.where("_hit").select("cluster_id").distinct().withColumn("_pub", F.lit(True))
    shown = clusters.join(published, "cluster_id", "left").withColumn("published", F.coalesce("published", F.lit(False)) | F.coalesce("_pub", F.lit(False)))
    return out.select(*members.columns), shown.select(*clusters.columns)


def write_back(members: DataFrame, clusters: DataFrame, pool: DataFrame, keys: DataFrame, episode: Column, day: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What an episode's release changes: its items are reported, clusters expire as of its day, the pool's rows are used."""
    members, clusters = mark_reported(members, clusters, keys, episode)
    return members, expire(clusters, episode), mark_used(pool, keys, day)


def replayed_via(via: Column, judge_via: Column, label: Column, verdict: Column, cos: Column) -> Column:
    """How an old row was decided, from its own words or else from what it decided."""
    lab = F.upper(F.trim(label))
    return F.coalesce(
        F.nullif(via, F.lit("")), F.nullif(judge_via, F.lit("")), F.when(lab.isin("A", "B", "C"), F.concat(F.lit("judge_"), F.lower(lab))), F.when(label.isNotNull(), F.lit("judge_na")),
        F.when((verdict == "suppressed") & cos.isNotNull(), F.lit("dup_same")), F.when(verdict == "suppressed", F.lit("dup_exact")),
        F.when(verdict.isin("candidate", "reported") & cos.isNull(), F.lit("no_history")), F.when(verdict.isin("candidate", "reported"), F.lit("embed_lo")), F.lit("replay"),
    )


def backfill_rows(rows: DataFrame, default_day: Column) -> DataFrame:
    """title, summary, url, day, source of old items or summaries, whichever fields they have."""
    filled = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))
    day = F.regexp_extract(filled("date_published", "date"), r"^\d{4}-\d{2}-\d{2}", 0)
    return rows.select(filled("title", "title_zh").alias("title"), F.coalesce(F.nullif("summary", F.lit("")), F.substring(filled("content_text"), 1, 300)).alias("summary"), filled("url", "url_canon").alias("url"), F.coalesce(F.nullif(day, F.lit("")), default_day).alias("day"), "source")


def backfill(members: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old items as reported members of clusters of their own, one for each URL that no member has; the clusters of those.

    rows: item_id, url_hash, day, vector; an item's id names its cluster. Of rows of one hash the first is taken.
    """
    w = Window.partitionBy("url_hash").orderBy("item_id")
    once = rows.withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | ~_named(F.col("url_hash"))).drop("_n")
    new = once.join(members.where(_named(F.col("url_hash"))).select("url_hash").distinct(), "url_hash", "left_anti")
    added = new.select("item_id", F.col("item_id").alias("cluster_id"), "day", "url_hash", F.lit("reported").alias("verdict"), "vector")
    return added, recompute_clusters(added)


def with_stored_vectors(members: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their documents' vectors (item_id, vector) in place of the queries' that found them, and the
    centroids of the clusters that this changes."""
    swapped = members.join(documents.select("item_id", F.col("vector").alias("_v")), "item_id", "left")
    touched = swapped.where("_v is not null").select("cluster_id").distinct()
    out = swapped.withColumn("vector", F.coalesce("_v", "vector")).select(*members.columns)
    return out, mean_unit(out.join(touched, "cluster_id", "left_semi"), "cluster_id", "vector")
