"""Streams run over the driver's tables to their end, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators import diff
from lodestream.plans.queries import _UPSERT_AT
from lodestream.plans.storage import read, shared_dir
from lodestream.streaming import pool_stream


def _stream(spark: SparkSession, d: str, ts: str = "ts") -> DataFrame:
    """The events as a stream of two files, the later ones in the second."""
    path, events = shared_dir(spark), read(spark, d, "events").withColumn(ts, F.col("ts").cast("timestamp"))
    cut = F.lit(_UPSERT_AT).cast("timestamp")
    for part, rows in ((0, events.where(F.col(ts) < cut)), (1, events.where(F.col(ts) >= cut))):
        rows.coalesce(1).write.mode("append").parquet(f"{path}/part={part}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{path}/part=*")


def _run(stream: DataFrame, mode: str) -> DataFrame:
    spark, path = stream.sparkSession, shared_dir(stream.sparkSession)
    pool_stream.final(stream, path, mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out" if mode == "complete" else f"{path}/out/*")


def streamed_episodes(spark: SparkSession, d: str) -> DataFrame:
    return _run(pool_stream.episode_counts(_stream(spark, d), "ts", "event_type", "60 days"), "complete")


def streamed_keys(spark: SparkSession, d: str) -> DataFrame:
    """The keys that a stream meets, each once."""
    keyed = _stream(spark, d).select("user_id", "event_type", F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("key"), "ts")
    return _run(pool_stream.first_seen(keyed, "key", "ts", "60 days"), "append").select("key", "user_id", "event_type")


def streamed_pool(spark: SparkSession, d: str) -> DataFrame:
    """The pool after two micro-batches."""
    e = _stream(spark, d).select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("item_key"), "event_id", F.floor("value").cast("string").alias("content_sha"), F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("date_published"),
        (F.col("event_id") % 2).cast("int").alias("signal"), F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"),
    )
    path = shared_dir(spark)
    pool_stream.keep_pool(spark, e, f"{path}/pool", f"{path}/checkpoint", "event_id").awaitTermination()
    return spark.read.schema(e.drop("event_id").schema).parquet(f"{path}/pool/v=1")


def seen_lists(spark: SparkSession, d: str) -> DataFrame:
    """A source's memory after a run: what it saw now before what it saw then, each once, at most 40."""
    p = read(spark, d, "pages").select((F.col("page_id") % 7).alias("source"), F.concat(F.lit("u"), (F.col("page_id") % 90).cast("string")).alias("u"), "page_id")
    listed = lambda rows, name: rows.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "u"))), lambda x: x["u"]).alias(name))
    both = listed(p.where("page_id % 2 = 0"), "new").join(listed(p.where("page_id % 3 = 0"), "old"), "source", "full_outer")
    return both.select("source", F.array_join(diff.seen_list(F.col("old"), F.col("new"), 40), ",").alias("seen"))


QUERIES = {f.__name__: f for f in (streamed_episodes, streamed_keys, streamed_pool, seen_lists)}

ORACLES = {
    "streamed_episodes": "SELECT (ts + INTERVAL 90 MINUTE)::DATE + 1 AS episode, event_type, count(*) AS n FROM events GROUP BY ALL",
    "streamed_keys": "SELECT DISTINCT user_id || '-' || event_type AS key, user_id, event_type FROM events",
    "streamed_pool": f"""WITH e AS (SELECT user_id || '-' || event_type AS item_key, event_id, floor(value)::BIGINT::VARCHAR AS sha, CASE WHEN event_id % 3 <> 0 THEN ts END AS pub, (event_id % 2)::INT AS signal, ts, ts >= TIMESTAMP '{_UPSERT_AT}' AS late FROM events),
        b AS (SELECT item_key, late, arg_max(sha, event_id) AS sha, arg_max(pub, event_id) FILTER (pub IS NOT NULL) AS pub, max(signal) AS signal, arg_min(ts, event_id) AS first, arg_max(ts, event_id) AS last FROM e GROUP BY ALL)
        SELECT item_key, arg_max(sha, late) AS content_sha, coalesce(max(CASE WHEN late THEN pub END), max(pub)) AS date_published, max(signal) AS signal, arg_min(first, late) AS first_seen, max(last) AS last_seen FROM b GROUP BY 1""",
    "seen_lists": """WITH p AS (SELECT page_id % 7 AS source, 'u' || page_id % 90 AS u, page_id FROM pages), a AS (SELECT source, u, page_id AS o, 0 AS w FROM p WHERE page_id % 2 = 0 UNION ALL SELECT source, u, page_id, 1 FROM p WHERE page_id % 3 = 0),
        f AS (SELECT source, u, min((w, o)) AS k FROM a GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS n FROM f)
        SELECT source, string_agg(u, ',' ORDER BY n) AS seen FROM r WHERE n <= 40 GROUP BY 1""",
}
