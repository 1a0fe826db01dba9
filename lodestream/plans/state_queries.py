"""Queries over the pool and the store of clusters, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import hashing
from lodestream.operators import clusters, dedup, items, pool
from lodestream.plans.queries import _STORED
from lodestream.plans.storage import materialize, read

_at = lambda x: F.lit(x).cast("timestamp")
_NOW, _EPISODE = "2024-01-20T00:00:00+00:00", "2024-01-20"
_BOUNDS = (_EPISODE, "2024-01-18 22:30:00", "2024-01-19 22:30:00", "2024-01-16 22:30:00", "2024-01-04 22:30:00")


def _bounds() -> list[Column]:
    episode, *rest = _BOUNDS
    return [F.lit(episode), *map(_at, rest)]


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and two Chinese ones, as parsed rows: tracked URLs, some without a title, source or date."""
    doc = read(spark, d, "documents").select("doc_id", "text", "source")
    planted = spark.sql("SELECT * FROM VALUES (-1L, '大模型发布会今天在北京举行，多家公司到场', 'wire'), (-2L, 'GPT 6 发布', 'wire') AS t(doc_id, text, source)")
    n, all_docs = F.col("doc_id"), doc.union(planted)
    url = F.concat(F.lit("https://www.x.example/p/"), n.cast("string"), F.lit("/?utm_source=a&b="), n.cast("string"))
    return all_docs.select(
        "doc_id", url.alias("url"), F.when(F.pmod(n, F.lit(5)) != 0, F.col("text")).alias("title"), F.col("text").alias("summary"), F.when(F.pmod(n, F.lit(3)) != 0, F.lit("Tue, 02 Jan 2024 03:04:05 +0800")).alias("date"),
        F.when(F.pmod(n, F.lit(4)) == 0, F.array(F.lit("signal"), F.lit("x"))).alias("tags"), F.col("source").alias("source_name"), F.when(F.pmod(n, F.lit(7)) == 0, F.lit("odd")).otherwise("rss").alias("kind"),
        F.when(F.pmod(n, F.lit(2)) == 0, F.lit("route")).otherwise("direct").alias("via"), F.lit(_NOW).alias("date_fetched"), F.lit(200).alias("status"),
    )


def items_built(spark: SparkSession, d: str) -> DataFrame:
    """Parsed rows as raw items, checked, and as pool rows; those that break the contract with what they break."""
    good, bad = items.checked_items(items.raw_items(_rows(spark, d), unicode=False))
    base = items.base_columns(good, F.lit(_EPISODE), F.lit(_NOW))
    out = base.select("item_key", "url_canon", "title", "content_text", "date_published", "language", F.array_join("tags", ",").alias("tags"), "signal", "content_sha", "first_seen", "source_kind", F.lit(None).cast("string").alias("errors"))
    none = lambda c, kind="string": F.lit(None).cast(kind).alias(c)
    return out.union(bad.select("item_key", "url_canon", "title", "content_text", none("date_published"), "language", F.array_join("tags", ",").alias("tags"), none("signal", "int"), none("content_sha"), none("first_seen"), F.col("_source.kind").alias("source_kind"), F.array_join("errors", ",").alias("errors")))


_ITEMS = r"""
WITH d AS (SELECT doc_id, text, source FROM documents UNION ALL VALUES (-1, '大模型发布会今天在北京举行，多家公司到场', 'wire'), (-2, 'GPT 6 发布', 'wire')),
i AS (SELECT doc_id, 'https://x.example/p/' || doc_id || '?b=' || doc_id AS url_canon, substr(sha256('https://x.example/p/' || doc_id || '?b=' || doc_id), 1, 16) AS item_key,
    'https://www.x.example/p/' || doc_id || '/?utm_source=a&b=' || doc_id AS url, CASE WHEN doc_id % 5 <> 0 THEN text END AS t0,
    coalesce(nullif(trim(regexp_replace(CASE WHEN doc_id % 5 <> 0 THEN text ELSE '' END, '\s+', ' ', 'g')), ''), trim(regexp_replace(doc_id::VARCHAR, '[-_+]+', ' ', 'g'))) AS title,
    CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || '…[截断]' WHEN length(text) > 0 THEN text END AS content_text, CASE WHEN doc_id % 3 <> 0 THEN 'Tue, 02 Jan 2024 03:04:05 +0800' END AS date,
    CASE WHEN doc_id % 4 = 0 THEN 'signal,x' ELSE '' END AS tags, source, CASE WHEN doc_id % 7 = 0 THEN 'odd' ELSE 'rss' END AS kind FROM d),
g AS (SELECT *, substr(coalesce(t0, '') || ' ' || coalesce(text, ''), 1, 600) AS head FROM i JOIN (SELECT doc_id, text FROM d) USING (doc_id)),
b AS (SELECT *, CASE WHEN trim(head) = '' THEN NULL WHEN length(regexp_replace(head, '[^\x{4e00}-\x{9fff}]', '', 'g')) >= 8 AND length(regexp_replace(head, '[^\x{4e00}-\x{9fff}]', '', 'g')) > 0.08 * length(head) THEN 'zh' ELSE 'en' END AS language,
    substr(sha256(title || chr(31) || coalesce(date, '') || chr(31) || coalesce(content_text, '') || chr(31) || coalesce(source, '?')), 1, 16) AS content_sha FROM g)
"""


def _pool(spark: SparkSession, d: str) -> DataFrame:
    """Events as pool rows in every state."""
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    n, u = F.col("event_id"), F.col("user_id")
    pick = lambda c, *values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(c, F.lit(len(values))) + 1).cast("int"))
    return e.select(
        n.cast("string").alias("item_key"), pick(u, "keep", "review", "drop", None).alias("filter_verdict"), F.when(F.col("event_type") != "error", F.col("ts")).alias("date_published"),
        F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / 86400) * 86400 + 86400).alias("first_seen"), F.when(u % 7 == 0, F.lit("2024-01-10")).alias("used_in_episode"), (u % 5 == 0).alias("daily"),
        pick(n, "fresh", "suppressed", "reissue", None, "gray").alias("dedup_verdict"), (n % 50).alias("dedup_cluster_id"), F.when(n % 3 != 0, F.lit("t")).alias("title_zh"), F.when(n % 3 != 0, F.lit("s")).alias("summary"),
        F.round(F.col("value") / 1000, 4).alias("news_value"), F.lit(0.5).alias("ai_relevance"), (n % 2).cast("int").alias("signal"),
    )


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").where("event_id % 11 = 0").select(F.col("event_id").cast("string").alias("item_key"), F.lit(_EPISODE).alias("episode"))


_POOL = f"""
WITH e AS (SELECT event_id, event_id::VARCHAR AS item_key, ['keep', 'review', 'drop', NULL][user_id % 4 + 1] AS v, CASE WHEN event_type <> 'error' THEN ts END AS p, date_trunc('day', ts) + INTERVAL 1 DAY AS f,
    CASE WHEN user_id % 7 = 0 THEN '2024-01-10' END AS used, user_id % 5 = 0 AS daily, ['fresh', 'suppressed', 'reissue', NULL, 'gray'][event_id % 5 + 1] AS dv, event_id % 50 AS cid, event_id % 3 <> 0 AS sum, round(value / 1000, 4) AS nv FROM events),
r AS (SELECT *, CASE WHEN used IS NOT NULL THEN 'used' WHEN p >= TIMESTAMP '{_BOUNDS[1]}' AND p < TIMESTAMP '{_BOUNDS[2]}' THEN 'window' WHEN p IS NULL AND f >= TIMESTAMP '{_BOUNDS[3]}' THEN 'carry-nodate' WHEN p IS NULL THEN 'nodate-old'
    WHEN p < TIMESTAMP '{_BOUNDS[1]}' AND daily THEN 'stale-daily' WHEN p < TIMESTAMP '{_BOUNDS[4]}' THEN 'stale-floor' WHEN p < TIMESTAMP '{_BOUNDS[1]}' AND f >= TIMESTAMP '{_BOUNDS[3]}' THEN 'carry-stale' WHEN p < TIMESTAMP '{_BOUNDS[1]}' THEN 'stale' ELSE 'future' END AS reason FROM e),
"""


def pool_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates and suppressed rows of an episode, with their reason and projection."""
    found = [pool.candidates(_pool(spark, d), _runs(spark, d), *_bounds(), suppressed=s).select("item_key", F.lit(s).alias("is_suppressed"), "reason", "projected") for s in (False, True)]
    return found[0].union(found[1])


def pool_due(spark: SparkSession, d: str) -> DataFrame:
    """Rows that lack a summary, those of them that the day's batch doesn't bring, and what the floor cuts."""
    p, runs = _pool(spark, d), _runs(spark, d)
    due = pool.needs_summary(p, *_bounds(), 48).select("item_key", F.lit("due").alias("what"))
    rest = pool.repairs(p, runs, *_bounds(), 48).select("item_key", F.lit("repair"))
    cut = pool.floor_cut(p, runs, F.lit(_EPISODE), _at("2024-01-02 00:00:00"), _at("2024-01-10 00:00:00")).select(F.col("n_stale_floor").cast("string"), F.lit("cut"))
    return due.union(rest).union(cut)


def pool_statistics(spark: SparkSession, d: str) -> DataFrame:
    return pool.pool_stats(_pool(spark, d))


def pool_writes(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts, summaries, dedup rows and used marks written one after the other, to known rows and to one half unknown."""
    built = items.base_columns(items.raw_items(_rows(spark, d), unicode=False), F.lit(_EPISODE), F.lit(_NOW))
    keyed = built.withColumn("n", F.regexp_extract("url_canon", r"/p/(-?\d+)", 1).cast("long"))
    kinds = dict.fromkeys(("filter_verdict", "judged_content_sha", "verdict_prompt", "verdict_model", "verdict_at", "title_zh", "summary", "section_guess", "summary_sha", "summary_prompt", "summary_model", "summary_at", "dedup_verdict", "used_in_episode"), "string")
    kinds |= {"ai_relevance": "double", "news_value": "double", "reasons": "array<string>", "entities": "array<string>", "facts": "array<string>", "dedup_cluster_id": "long"}
    old = keyed.where(F.pmod("n", F.lit(2)) == 0).drop("n").withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()}).withColumn("dedup_cluster_id", F.pmod(F.length("url"), F.lit(3)).cast("long"))
    judged = keyed.where(F.pmod("n", F.lit(3)) == 0)
    prov = F.struct(F.lit("m").alias("model"), F.when(F.pmod("n", F.lit(4)) == 0, F.lit("p")).alias("prompt"), F.lit(None).cast("string").alias("decided_at"))
    verdicts = judged.select("item_key", F.when(F.pmod("n", F.lit(9)) == 0, F.lit("what")).otherwise("keep").alias("verdict"), F.lit(0.25).alias("ai_relevance"), F.lit(0.5).alias("news_value"), F.array(F.lit("r")).alias("reasons"), prov.alias("prov"))
    sums = keyed.where(F.pmod("n", F.lit(5)) == 0).select("item_key", F.lit("z").alias("title_zh"), F.lit("s").alias("summary"), F.lit(None).cast("array<string>").alias("entities"), F.array(F.lit("f")).alias("facts"), F.lit("g").alias("section_guess"), prov.alias("prov"))
    base = keyed.drop("n")
    out = pool.write_summaries(pool.write_verdicts(old, base, verdicts, "filter-v2", F.lit(_NOW)), base, sums, F.lit(_NOW))
    out = pool.write_dedup(out, keyed.where(F.pmod("n", F.lit(2)) == 0).select("item_key", F.lit("suppressed").alias("verdict"), F.pmod("n", F.lit(3)).cast("long").alias("cluster_id")))
    out = pool.mark_used(out, keyed.where(F.pmod("n", F.lit(6)) == 0).select("item_key"), _EPISODE)
    return out.select("item_key", "title", "content_sha", "filter_verdict", "judged_content_sha", "verdict_prompt", "verdict_at", "ai_relevance", F.array_join("reasons", ",").alias("reasons"), "title_zh", "summary_sha", F.array_join("facts", ",").alias("facts"), "dedup_verdict", "dedup_cluster_id", "used_in_episode")


def pool_records(spark: SparkSession, d: str) -> DataFrame:
    """Pool rows as the three records that they came from."""
    base = items.base_columns(items.raw_items(_rows(spark, d), unicode=False), F.lit(_EPISODE), F.lit(_NOW)).withColumn("n", F.regexp_extract("url_canon", r"/p/(-?\d+)", 1).cast("long"))
    zero = F.pmod("n", F.lit(2)) == 0
    p = base.withColumns({
        "title_zh": F.when(zero, "z"), "summary": F.lit("s"), "entities": F.lit(None).cast("array<string>"), "facts": F.array(F.lit("f")), "section_guess": F.lit("g"), "summary_model": F.when(zero, "m"), "summary_prompt": F.when(zero, "p"), "summary_at": F.when(zero, "2024-01-01"),
        "filter_verdict": F.when(zero, "keep").otherwise("odd"), "ai_relevance": F.when(zero, 0.0).otherwise(0.25), "news_value": F.lit(0.5), "reasons": F.array(F.lit("r")), "verdict_model": F.when(zero, ""), "verdict_prompt": F.lit(None).cast("string"), "verdict_at": F.lit(None).cast("string"),
    })
    now = F.lit(_NOW)
    raw, said, verdict = pool.raw_of_pool(p, now), pool.summary_of_pool(p, now), pool.verdict_of_pool(p, now)
    rows = raw.select("item_key", "url", "title", F.col("_source.name").alias("source"), F.col("_fetch.via").alias("via"), F.col("_fetch.content_sha256").alias("sha"))
    rows = rows.join(said.select("item_key", "title_zh", F.size("entities").alias("entities"), F.concat_ws("|", "prov.model", "prov.prompt", "prov.input_sha", "prov.decided_at").alias("said_by")), "item_key")
    return rows.join(verdict.select("item_key", "verdict", "ai_relevance", F.concat_ws("|", "prov.model", "prov.prompt", "prov.input_sha", "prov.decided_at").alias("judged_by")), "item_key")


def real_verdicts(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    e = read(spark, d, "events").select(
        n, F.struct(F.when(n % 5 != 0, F.lit("filter-v2")).alias("prompt"), F.when(n % 3 != 0, F.lit("judge")).otherwise("no-llm").alias("model")).alias("prov"),
        F.when(n % 4 == 0, F.array(F.lit("coverage-miss: 3"))).when(n % 4 == 1, F.array(F.lit("good"))).alias("reasons"),
    )
    return e.select("event_id", pool.is_real_verdict(F.col("prov"), F.col("reasons"), "judge").alias("is_real"))


def state_tables(spark: SparkSession, d: str) -> DataFrame:
    """Stored JSON as maps, a partial update over them, one key decoded, and two stores of which rows coincide."""
    r = read(spark, d, "nation").select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 != 0, F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("last")))).alias("seen"), F.when(F.col("n_nationkey") % 2 == 0, F.lit('{"fails":"1"}')).otherwise("broken").alias("health"))
    new = r.where("name < 'J'").select("name", F.lit('{"last":"new"}').alias("seen"), F.lit(None).cast("string").alias("health"))
    maps = pool.state_maps(pool.save_state(r, new))
    kv = pool.kv_get(r.select(F.col("name").alias("key"), F.col("seen").alias("value")), "CHINA", "last string")
    _, apart = pool.migrate({"nation": (r, r.where("name < 'C'"))})
    out = maps.select("name", F.col("seen")["last"].alias("a"), F.col("health")["fails"].alias("b"))
    return out.union(kv.select("key", "value.last", F.lit("kv"))).union(apart.select("table", F.col("expected").cast("string"), F.col("found").cast("string")))


def run_days(spark: SparkSession, d: str) -> DataFrame:
    """Which runs go to the pool, and which days are released without a decision."""
    o = read(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")
    run = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("_"), "day")).otherwise(F.col("day"))
    past = pool.is_past_deadline(F.col("o_orderstatus") == "F", _at("1996-06-01 01:30:00"), F.col("day").cast("date"), "09:30")
    return o.select("o_orderkey", pool.is_pool_day(run, F.lit("1996-06-01")).alias("to_pool"), past.alias("released"))


def _members(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("vec_id")
    verdict = F.element_at(F.array(*map(F.lit, ("candidate", "reissue", "reported", "suppressed"))), (n % 4 + 1).cast("int"))
    return read(spark, d, "embeddings").select(
        n.alias("item_id"), F.col("label").cast("long").alias("cluster_id"), F.date_add(F.lit("2024-01-01").cast("date"), (n % 30).cast("int")).alias("day"), F.when(n % 9 == 0, F.lit("")).otherwise(F.sha1(F.concat(F.lit("u"), (n % 40).cast("string")))).alias("url_hash"),
        verdict.alias("verdict"), F.col("embedding").cast("array<double>").alias("vector"), F.concat(F.lit("k"), (n % 25).cast("string")).alias("item_key"), F.lit(None).cast("string").alias("episode"),
    )


_MEMBERS = """
WITH m AS (SELECT vec_id AS item_id, label::BIGINT AS cluster_id, DATE '2024-01-01' + (vec_id % 30)::INT AS day, CASE WHEN vec_id % 9 = 0 THEN '' ELSE sha1('u' || vec_id % 40) END AS url_hash,
    ['candidate', 'reissue', 'reported', 'suppressed'][vec_id % 4 + 1] AS verdict, embedding::DOUBLE[] AS v, 'k' || vec_id % 25 AS item_key FROM embeddings),
"""
_MEAN = "(SELECT {by}, list(x / nullif(n, 0) ORDER BY i) AS c FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY {by})) AS n FROM (SELECT {by}, i, avg(v[i]) AS x FROM (SELECT {by}, v, unnest(range(1, len(v) + 1)) AS i FROM {table}) GROUP BY ALL)) GROUP BY 1)"


def _shown(centroid: str = "centroid") -> Column:
    return F.round(F.aggregate(F.transform(F.col(centroid), lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("mark")


_MARK = "round(list_sum(list_transform(range(1, len({c}) + 1), lambda i: {c}[i] * i)), 6)"


def cluster_life(spark: SparkSession, d: str) -> DataFrame:
    """Clusters recomputed from their members, expired at one day and opened again at an earlier one."""
    c = dedup.recompute_clusters(_members(spark, d)).withColumn("state", F.when(F.col("cluster_id") % 4 == 3, "merged").otherwise("open"))
    c = dedup.expire(c, F.lit("2024-02-20").cast("date"))
    opened = dedup.unexpire(c.select("cluster_id", "state", "expires_at"), F.lit("2024-02-19").cast("date")).select("cluster_id", F.col("state").alias("again"))
    return c.join(opened, "cluster_id").select("cluster_id", "item_count", "n_reissues", "published", "first_seen", "last_seen", "expires_at", "state", "again", _shown())


def cluster_moves(spark: SparkSession, d: str) -> DataFrame:
    """Members after a merge, a split of what it made, a purged day and one row a URL and day."""
    m = dedup.merge_clusters(_members(spark, d), 1, 2)
    m = dedup.split_cluster(m, 1, 1000)
    m = dedup.one_per_url_and_day(dedup.purge_day(m, F.lit("2024-01-05").cast("date")))
    return m.select("item_id", F.col("cluster_id").cast("long").alias("cluster_id"), "day")


def cluster_writes(spark: SparkSession, d: str) -> DataFrame:
    """The later half of the members attached to clusters of the first half."""
    m = _members(spark, d)
    old, new = m.where("item_id % 2 = 0"), m.where("item_id % 2 = 1")
    c = dedup.recompute_clusters(old).select("cluster_id", "centroid", "item_count", "n_reissues", "last_seen", "expires_at")
    kept, merged = clusters.attach(old, c, new)
    counted = kept.groupBy("cluster_id").agg(F.count("*").alias("members"))
    return merged.join(counted, "cluster_id").select("cluster_id", "members", "item_count", "n_reissues", "last_seen", "expires_at", _shown())


def stored_rows(spark: SparkSession, d: str) -> DataFrame:
    """Which of new rows are stored, and under which id the others are known."""
    m = _members(spark, d)
    return clusters.insert_members(m.where("item_id < 300"), m.where("item_id >= 300")).select("item_id", "stored_id", "inserted")


def cluster_reports(spark: SparkSession, d: str) -> DataFrame:
    """Members and clusters after an episode's release, and the pool's rows that it used."""
    m = _members(spark, d)
    keys = spark.sql("SELECT * FROM VALUES ('k3'), ('k7'), ('k7'), ('none') AS t(item_key)")
    c = dedup.recompute_clusters(m).withColumn("state", F.lit("open"))
    p = m.groupBy("item_key").agg(F.max(F.when(F.col("item_id") % 50 == 3, F.lit("2024-01-02"))).alias("used_in_episode"))
    members, shown, used = clusters.write_back(m, c, p, keys, F.lit("2024-01-08").cast("date"), "2024-01-08")
    a = members.select(F.col("item_id").cast("string").alias("id"), F.col("verdict").alias("x"), F.col("episode").alias("y"))
    b = shown.select(F.concat(F.lit("c"), F.col("cluster_id").cast("string")), F.col("published").cast("string"), F.concat(F.col("state"), F.lit(" "), F.col("expires_at").cast("string")))
    return a.union(b).union(used.select("item_key", F.lit("used"), "used_in_episode"))


def replayed(spark: SparkSession, d: str) -> DataFrame:
    """Rows of half the days replayed from the store, with how they were decided."""
    m = _members(spark, d)
    rows = m.where("item_id % 3 = 0").select(F.col("item_id").alias("n"), "url_hash", "day")
    got = dedup.replay(rows, m.where("item_id % 2 = 0"))
    n, none = F.col("n"), F.lit(None).cast("string")
    via = clusters.replayed_via(F.when(n % 7 == 0, "dup_near"), F.when(n % 11 == 0, "said"), F.when(n % 5 == 0, " b ").when(n % 5 == 1, "x").otherwise(none), F.element_at(F.array(*map(F.lit, ("candidate", "reissue", "reported", "suppressed"))), (n % 4 + 1).cast("int")), F.when(n % 2 == 0, 0.5))
    return got.select("n", F.col("replayed").alias("verdict"), "cluster_id", via.alias("via"))


def backfilled(spark: SparkSession, d: str) -> DataFrame:
    """Old rows as clusters of their own, where the store lacks their URL; and stored vectors swapped for the documents'."""
    m = _members(spark, d)
    old, rows = m.where("item_id < 20"), m.select(F.col("item_id"), "url_hash", "day", "vector")
    _, made = clusters.backfill(old, rows)
    _, swapped = clusters.with_stored_vectors(m, m.where("item_id % 10 = 0").select("item_id", F.transform("vector", lambda x: -x).alias("vector")))
    a = made.select(F.lit("made").alias("what"), F.col("cluster_id").cast("long").alias("cluster_id"), "published", _shown())
    return a.union(swapped.select(F.lit("swapped"), "cluster_id", F.lit(None).cast("boolean"), _shown()))


def old_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of old artifacts, whichever fields they have."""
    n = F.col("doc_id")
    docs = read(spark, d, "documents").select(
        F.when(n % 2 == 0, F.col("source")).alias("title"), F.lit("zh").alias("title_zh"), F.when(n % 3 == 0, F.lit("s")).alias("summary"), F.col("text").alias("content_text"), F.lit("").alias("url"), F.concat(F.lit("u"), n.cast("string")).alias("url_canon"),
        F.when(n % 4 == 0, F.lit("2024-01-02T00:00:00Z")).alias("date_published"), F.when(n % 5 == 0, F.lit("2023-02-03")).otherwise("x").alias("date"), "source",
    )
    return clusters.backfill_rows(docs, F.lit("2024-01-15"))


def _day(spark: SparkSession, d: str) -> DataFrame:
    """Documents with vectors as one day's items."""
    docs = read(spark, d, "documents").select("doc_id", "text", "n_chars")
    rows = docs.join(read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("vector")), "doc_id")
    prints = hashing.simhash(rows.select("doc_id", "text"), "doc_id", hashing.stored_features(F.col("text")))
    return materialize(rows.withColumn("tokens", hashing.title_tokens(F.col("text"))).drop("text").join(prints, "doc_id"))


def _same_day(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A day's items and their recalled pairs."""
    day = _day(spark, d)
    return day, materialize(dedup.candidate_pairs(day, "doc_id", "tokens", "vector"))


def same_day_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _same_day(spark, d)[1].withColumn("cos", F.round("cos", 6))


def same_day_groups(spark: SparkSession, d: str) -> DataFrame:
    """A day's clusters by near fingerprints and a judge that joins every second pair it is asked about, and who stands for them."""
    day, pairs = _same_day(spark, d)
    groups = dedup.same_day_clusters(day, pairs, "doc_id", "simhash", lambda asked: asked.withColumn("verdict", F.when((F.col("a") + F.col("b")) % 2 == 0, "A").otherwise("C")))
    reps = dedup.representatives(groups.join(day.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("n_chars").cast("double")).alias("value")), "doc_id"), "doc_id", "component", "value")
    return groups.join(reps.select("component", F.col("doc_id").alias("representative")), "component")


def cascade_one_by_one(spark: SparkSession, d: str) -> DataFrame:
    """Odd documents with vectors in the order of their ids, each against the even ones and those before it. No SQL: every
    decision changes what the next one meets; the tests hold the operator against a plain loop."""
    rows = _day(spark, d).withColumn("url_hash", F.sha1(F.concat(F.lit("u"), (F.col("doc_id") % 331).cast("string"))))
    old, n = rows.where("doc_id % 2 = 0"), F.col("doc_id")
    members = old.select(n.alias("item_id"), n.alias("cluster_id"), "url_hash", "simhash")
    items_ = rows.where("doc_id % 2 = 1").select(F.lit(_EPISODE).alias("episode"), n.alias("ord"), n.alias("key"), "url_hash", "simhash", "vector")
    return dedup.cascade_in_order(items_, members, old.select(n.alias("cluster_id"), F.col("vector").alias("centroid")))


QUERIES = {f.__name__: f for f in (
    items_built, pool_candidates, pool_due, pool_statistics, pool_writes, pool_records, real_verdicts, state_tables, run_days, cluster_life, cluster_moves, cluster_writes, stored_rows, cluster_reports, replayed, backfilled, old_rows, same_day_pairs, same_day_groups, cascade_one_by_one,
)}

_DAY = """, i AS (SELECT d.doc_id, d.text, d.n_chars, e.embedding::DOUBLE[] AS v, s.simhash FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id JOIN s USING (doc_id)),
t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM i), k AS (SELECT t FROM t GROUP BY t HAVING count(*) BETWEEN 2 AND least(8, greatest(3, (SELECT count(*) FROM i) // 3))),
tp AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.t = y.t AND x.doc_id < y.doc_id WHERE x.t IN (SELECT t FROM k)),
n AS (SELECT x.doc_id AS q, y.doc_id AS w FROM i x JOIN i y ON x.doc_id <> y.doc_id QUALIFY row_number() OVER (PARTITION BY x.doc_id ORDER BY round(list_cosine_similarity(x.v, y.v), 12) DESC, y.doc_id) <= 5),
kp AS (SELECT DISTINCT least(q, w) AS a, greatest(q, w) AS b FROM n), ab AS (SELECT a, b, tp.a IS NOT NULL AS tok, kp.a IS NOT NULL AS knn FROM tp FULL JOIN kp USING (a, b)),
c AS (SELECT a, b, greatest(0.0, list_cosine_similarity(x.v, y.v)) AS cos, tok, knn, bit_count(xor(x.simhash, y.simhash)) <= 4 AS near FROM ab JOIN i x ON x.doc_id = a JOIN i y ON y.doc_id = b)"""

ORACLES = {
    "items_built": _ITEMS + """SELECT item_key, url_canon, title, content_text, CASE WHEN kind = 'rss' AND date IS NOT NULL THEN '2024-01-01T19:04:05+00:00' END AS date_published, language, tags, CASE WHEN kind = 'rss' THEN (tags <> '')::INT END AS signal,
        CASE WHEN kind = 'rss' THEN content_sha END AS content_sha, CASE WHEN kind = 'rss' THEN '2024-01-20' END AS first_seen, kind AS source_kind, CASE WHEN kind <> 'rss' THEN 'kind' END AS errors FROM b""",
    "pool_candidates": _POOL + f"""u AS (SELECT DISTINCT cid FROM e WHERE used IS NOT NULL),
        c AS (SELECT r.*, CASE WHEN dv = 'suppressed' THEN 'suppressed' WHEN u.cid IS NOT NULL AND dv = 'reissue' THEN 'reissue' WHEN u.cid IS NOT NULL THEN 'suppressed' ELSE coalesce(dv, 'gray') END AS projected FROM r LEFT JOIN u ON r.cid = u.cid
            WHERE v IN ('keep', 'review') AND event_id % 11 <> 0 AND reason IN ('window', 'carry-nodate', 'carry-stale'))
        SELECT item_key, projected = 'suppressed' AS is_suppressed, reason, projected FROM c""",
    "pool_due": _POOL + f"""w AS (SELECT item_key, event_id FROM e WHERE v IN ('keep', 'review') AND used IS NULL AND NOT sum AND ((p >= TIMESTAMP '{_BOUNDS[1]}' AND p < TIMESTAMP '{_BOUNDS[2]}') OR (p IS NULL AND f >= TIMESTAMP '{_BOUNDS[3]}')
            OR (p < TIMESTAMP '{_BOUNDS[1]}' AND p >= TIMESTAMP '{_BOUNDS[4]}' AND f >= TIMESTAMP '{_BOUNDS[3]}')) ORDER BY f DESC, item_key LIMIT 48)
        SELECT item_key, 'due' AS what FROM w UNION ALL SELECT item_key, 'repair' FROM w WHERE event_id % 11 <> 0
        UNION ALL SELECT count(*)::VARCHAR, 'cut' FROM e WHERE v IN ('keep', 'review') AND used IS NULL AND sum AND p < TIMESTAMP '2024-01-10 00:00:00' AND f >= TIMESTAMP '2024-01-02 00:00:00' AND NOT daily AND event_id % 11 <> 0""",
    "pool_statistics": _POOL + """x AS (SELECT f::VARCHAR AS value, count(*) AS n FROM e GROUP BY 1 ORDER BY 1 DESC LIMIT 12)
        SELECT 'items' AS what, NULL::VARCHAR AS value, count(*) AS n FROM e UNION ALL SELECT 'verdict', coalesce(v, '(unjudged)'), count(*) FROM e GROUP BY 2 UNION ALL SELECT 'first_seen', value, n FROM x
        UNION ALL SELECT 'used', NULL, count(used) FROM e UNION ALL SELECT 'with_summary', NULL, count_if(sum) FROM e UNION ALL SELECT 'signal', NULL, count_if(event_id % 2 = 1) FROM e""",
    "pool_writes": _ITEMS + """, o AS (SELECT *, doc_id % 2 = 0 AS old, ((doc_id % 3) + 3) % 3 = 0 AS j, ((doc_id % 5) + 5) % 5 = 0 AS s, ((doc_id % 4) + 4) % 4 = 0 AS four FROM b)
        SELECT item_key, title, content_sha, CASE WHEN j THEN CASE WHEN doc_id % 9 = 0 THEN 'review' ELSE 'keep' END END AS filter_verdict, CASE WHEN j THEN content_sha END AS judged_content_sha, CASE WHEN j THEN CASE WHEN four THEN 'p' ELSE 'filter-v2' END END AS verdict_prompt,
            CASE WHEN j THEN '2024-01-20T00:00:00+00:00' END AS verdict_at, CASE WHEN j THEN 0.25 END AS ai_relevance, CASE WHEN j THEN 'r' END AS reasons, CASE WHEN s THEN 'z' END AS title_zh, CASE WHEN s THEN content_sha END AS summary_sha, CASE WHEN s THEN 'f' END AS facts,
            CASE WHEN old AND length(url) % 3 <> ((doc_id % 3) + 3) % 3 THEN 'suppressed' END AS dedup_verdict, CASE WHEN old THEN ((doc_id % 3) + 3) % 3 END::BIGINT AS dedup_cluster_id, CASE WHEN doc_id % 6 = 0 THEN '2024-01-20' END AS used_in_episode
        FROM o WHERE old OR j OR s""",
    "pool_records": _ITEMS + """SELECT item_key, url, title, coalesce(nullif(source, ''), '?') AS source, 'cache' AS via, CASE WHEN content_text IS NOT NULL THEN substr(sha256(content_text), 1, 16) END AS sha, CASE WHEN doc_id % 2 = 0 THEN 'z' ELSE '' END AS title_zh, 0 AS entities,
        CASE WHEN doc_id % 2 = 0 THEN 'm|p|' ELSE 'pool|summary-v1|' END || substr(sha256(item_key), 1, 16) || CASE WHEN doc_id % 2 = 0 THEN '|2024-01-01' ELSE '|2024-01-20T00:00:00+00:00' END AS said_by,
        CASE WHEN doc_id % 2 = 0 THEN 'keep' ELSE 'review' END AS verdict, CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE 0.25 END::DOUBLE AS ai_relevance, 'pool|filter-v2|' || substr(sha256(item_key), 1, 16) || '|2024-01-20T00:00:00+00:00' AS judged_by FROM b""",
    "real_verdicts": "SELECT event_id, event_id % 5 <> 0 AND event_id % 3 <> 0 AND event_id % 4 <> 0 AS is_real FROM events",
    "state_tables": """WITH r AS (SELECT n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey::VARCHAR END AS a, CASE WHEN n_nationkey % 2 = 0 THEN '1' END AS b FROM nation)
        SELECT name, CASE WHEN name < 'J' THEN 'new' ELSE a END AS a, b FROM r UNION ALL SELECT name, a, 'kv' FROM r WHERE name = 'CHINA' UNION ALL SELECT 'nation', (count(*) + count_if(name < 'C'))::VARCHAR, count(*)::VARCHAR FROM r HAVING count_if(name < 'C') > 0""",
    "run_days": "SELECT o_orderkey, o_orderkey % 5 <> 0 AND o_orderdate::DATE <= DATE '1996-06-01' AS to_pool, o_orderstatus <> 'F' AND TIMESTAMP '1996-06-01 01:30:00' > o_orderdate::DATE::TIMESTAMP + INTERVAL 90 MINUTE AS released FROM orders",
    "cluster_life": _MEMBERS + "c AS " + _MEAN.format(by="cluster_id", table="m") + f""", s AS (SELECT cluster_id, count(*) AS item_count, count_if(verdict = 'reissue') AS n_reissues, bool_or(verdict = 'reported') AS published, min(day) AS first_seen, max(day) AS last_seen FROM m GROUP BY 1),
        x AS (SELECT *, (last_seen + 21)::DATE AS expires_at, CASE WHEN cluster_id % 4 = 3 THEN 'merged' WHEN last_seen + 21 < DATE '2024-02-20' THEN 'expired' ELSE 'open' END AS state FROM s)
        SELECT cluster_id, item_count, n_reissues, published, first_seen, last_seen, expires_at, state, CASE WHEN state = 'expired' AND expires_at >= DATE '2024-02-19' THEN 'open' ELSE state END AS again, {_MARK.format(c='c')} AS mark FROM x JOIN c USING (cluster_id)""",
    "cluster_moves": _MEMBERS + """a AS (SELECT * REPLACE (CASE WHEN cluster_id = 2 THEN 1 ELSE cluster_id END AS cluster_id) FROM m), l AS (SELECT max(day) AS d, count(*) AS n FROM a WHERE cluster_id = 1), k AS (SELECT count(*) AS moved FROM a, l WHERE cluster_id = 1 AND day = d),
        b AS (SELECT a.* REPLACE (CASE WHEN cluster_id = 1 AND day = d AND n > 1 AND moved < n THEN 1000 ELSE cluster_id END AS cluster_id) FROM a, l, k)
        SELECT item_id, cluster_id::BIGINT AS cluster_id, day FROM b WHERE day <> DATE '2024-01-05' QUALIFY url_hash = '' OR row_number() OVER (PARTITION BY url_hash, day ORDER BY item_id) = 1""",
    "cluster_writes": _MEMBERS + "o AS (SELECT * FROM m WHERE item_id % 2 = 0), c AS " + _MEAN.format(by="cluster_id", table="o") + f""", s AS (SELECT cluster_id, count(*) AS n, count_if(verdict = 'reissue') AS r, max(day) AS l FROM o GROUP BY 1),
        w AS (SELECT * FROM m WHERE item_id % 2 = 1 AND (url_hash = '' OR NOT EXISTS (SELECT 1 FROM o WHERE o.url_hash = m.url_hash AND o.day = m.day)) QUALIFY url_hash = '' OR row_number() OVER (PARTITION BY url_hash, day ORDER BY item_id) = 1),
        k AS (SELECT cluster_id, count(*) AS n2, count_if(verdict = 'reissue') AS r2, max(day) AS l2 FROM w GROUP BY 1), z AS (SELECT cluster_id, i, sum(v[i]) AS x FROM (SELECT cluster_id, v, unnest(range(1, len(v) + 1)) AS i FROM w) GROUP BY ALL),
        y AS (SELECT s.cluster_id, t.i, c.c[t.i] * n + coalesce(z.x, 0) AS x FROM s JOIN c USING (cluster_id), unnest(range(1, 65)) AS t(i) LEFT JOIN z ON z.cluster_id = s.cluster_id AND z.i = t.i),
        q AS (SELECT cluster_id, list(x / norm ORDER BY i) AS c2 FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY cluster_id)) AS norm FROM y) GROUP BY 1)
        SELECT cluster_id, n + coalesce(n2, 0) AS members, n + coalesce(n2, 0) AS item_count, r + coalesce(r2, 0) AS n_reissues, greatest(l, coalesce(l2, l)) AS last_seen, (greatest(l, coalesce(l2, l)) + 21)::DATE AS expires_at, {_MARK.format(c='c2')} AS mark FROM s LEFT JOIN k USING (cluster_id) JOIN q USING (cluster_id)""",
    "stored_rows": _MEMBERS + """o AS (SELECT * FROM m WHERE item_id < 300), w AS (SELECT * FROM m WHERE item_id >= 300),
        x AS (SELECT w.item_id, CASE WHEN w.url_hash = '' THEN w.item_id ELSE coalesce((SELECT min(item_id) FROM o WHERE o.url_hash = w.url_hash AND o.day = w.day), min(w.item_id) OVER (PARTITION BY w.url_hash, w.day)) END AS stored_id FROM w)
        SELECT item_id, stored_id, item_id = stored_id AS inserted FROM x""",
    "cluster_reports": _MEMBERS + """h AS (SELECT *, max((day = DATE '2024-01-08')::INT) OVER (PARTITION BY item_key) AS here FROM m WHERE item_key IN ('k3', 'k7')), hit AS (SELECT item_id, cluster_id FROM h WHERE here = 0 OR day = DATE '2024-01-08'),
        s AS (SELECT cluster_id, bool_or(verdict = 'reported') AS p, (max(day) + 21)::DATE AS e FROM m GROUP BY 1)
        SELECT m.item_id::VARCHAR AS id, CASE WHEN hit.item_id IS NULL THEN verdict ELSE 'reported' END AS x, CASE WHEN hit.item_id IS NOT NULL THEN '2024-01-08' END AS y FROM m LEFT JOIN hit USING (item_id)
        UNION ALL SELECT 'c' || cluster_id, (p OR cluster_id IN (SELECT cluster_id FROM hit))::VARCHAR, CASE WHEN e < DATE '2024-01-08' THEN 'expired ' ELSE 'open ' END || e FROM s
        UNION ALL SELECT item_key, 'used', coalesce(max(CASE WHEN item_id % 50 = 3 THEN '2024-01-02' END), CASE WHEN item_key IN ('k3', 'k7') THEN '2024-01-08' END) FROM m GROUP BY item_key""",
    "replayed": _MEMBERS + """s AS (SELECT url_hash, day, arg_min(verdict, item_id) AS v, arg_min(cluster_id, item_id) AS c FROM m WHERE item_id % 2 = 0 GROUP BY ALL), r AS (SELECT item_id AS n, s.v, s.c FROM m LEFT JOIN s USING (url_hash, day) WHERE item_id % 3 = 0)
        SELECT n, CASE WHEN v IN ('candidate', 'reported') THEN 'fresh' ELSE v END AS verdict, c AS cluster_id, CASE WHEN n % 7 = 0 THEN 'dup_near' WHEN n % 11 = 0 THEN 'said' WHEN n % 5 = 0 THEN 'judge_b' WHEN n % 5 = 1 THEN 'judge_na'
            WHEN n % 4 = 3 THEN CASE WHEN n % 2 = 0 THEN 'dup_same' ELSE 'dup_exact' END WHEN n % 4 IN (0, 2) THEN CASE WHEN n % 2 = 0 THEN 'embed_lo' ELSE 'no_history' END ELSE 'replay' END AS via FROM r""",
    "backfilled": _MEMBERS + f"""o AS (SELECT * FROM m WHERE item_id < 20), w AS (SELECT * FROM m WHERE url_hash = '' OR url_hash NOT IN (SELECT url_hash FROM o) QUALIFY url_hash = '' OR row_number() OVER (PARTITION BY url_hash ORDER BY item_id) = 1),
        w1 AS (SELECT item_id AS k, v FROM w), c AS {_MEAN.format(by='k', table='w1')}, s AS (SELECT m.cluster_id AS k2, CASE WHEN item_id % 10 = 0 THEN list_transform(v, lambda x: -x) ELSE v END AS v FROM m),
        t AS (SELECT * FROM s WHERE k2 IN (SELECT cluster_id FROM m WHERE item_id % 10 = 0)), c2 AS {_MEAN.format(by='k2', table='t')}
        SELECT 'made' AS what, k AS cluster_id, true AS published, {_MARK.format(c='c')} AS mark FROM c UNION ALL SELECT 'swapped', k2, NULL, {_MARK.format(c='c')} FROM c2""",
    "old_rows": """SELECT CASE WHEN doc_id % 2 = 0 AND source <> '' THEN source ELSE 'zh' END AS title, CASE WHEN doc_id % 3 = 0 THEN 's' ELSE substr(coalesce(text, ''), 1, 300) END AS summary, 'u' || doc_id AS url,
        CASE WHEN doc_id % 4 = 0 THEN '2024-01-02' WHEN doc_id % 5 = 0 THEN '2023-02-03' ELSE '2024-01-15' END AS day, source FROM documents""",
    "same_day_pairs": _STORED + _DAY + " SELECT a, b, round(cos, 6) AS cos, tok, knn FROM c",
    "same_day_groups": _STORED.replace("WITH", "WITH RECURSIVE", 1) + _DAY + """, asked AS (SELECT a, b FROM c WHERE NOT near AND (cos >= 0.80 OR (tok AND cos >= 0.55) OR (knn AND cos >= 0.62)) ORDER BY cos DESC, a, b LIMIT 60),
        l AS (SELECT a, b FROM c WHERE near UNION SELECT a, b FROM asked WHERE (a + b) % 2 = 0), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT doc_id AS n, doc_id AS m FROM i UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.n),
        g AS (SELECT n AS doc_id, min(m) AS component FROM r GROUP BY 1), p AS (SELECT component, doc_id AS representative FROM g JOIN i USING (doc_id) QUALIFY row_number() OVER (PARTITION BY component ORDER BY CASE WHEN doc_id % 3 <> 0 THEN n_chars ELSE 0 END DESC, doc_id) = 1)
        SELECT component, doc_id, representative FROM g JOIN p USING (component)""",
}
