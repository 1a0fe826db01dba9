"""The item pool: versioned snapshots with per-column upsert rules, eligibility windows and candidates.

A snapshot is a table; an upsert is a full outer join that gives the next snapshot, written beside the old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.dates import window_end, window_start

REPLACED = ("title", "content_text", "image", "language", "raw_ref", "source_name", "source_feed_url", "source_kind", "item_guid", "tags", "daily", "content_sha")
VERDICTS = ("filter_verdict", "judged_content_sha", "verdict_prompt", "verdict_model", "verdict_at", "ai_relevance", "news_value", "reasons")
KEPT = ("url", "url_canon", "date_fetched", "first_seen")


def fold_batch(batch: DataFrame, order: Column, key: str = "item_key") -> DataFrame:
    """A batch with repeated keys as one row a key: the last row's columns, the last date that isn't null, whether
    content changed on the way (A, B, A is a change), the highest signal, the first url and first_seen.

    One aggregation that combines in the tasks, so that a hot key is no hot task: rows that are applied one after the
    other change the content on the way exactly if not all of them are equal.
    """
    sha = F.coalesce("content_sha", F.lit(""))
    rules = {c: F.max_by(c, order) for c in batch.columns if c != key}
    rules |= {c: F.min_by(c, order) for c in KEPT if c in rules}
    if "date_published" in rules:
        rules["date_published"] = F.max_by("date_published", F.when(F.col("date_published").isNotNull(), order))
    if "signal" in rules:
        rules["signal"] = F.max("signal")
    rules |= {"_drift": F.min(sha) != F.max(sha), "_first_sha": F.min_by("content_sha", order)}
    return batch.groupBy(key).agg(*[x.alias(c) for c, x in rules.items()])


def upsert(pool: DataFrame, batch: DataFrame, order: Column, key: str = "item_key") -> DataFrame:
    """The next snapshot. Columns of the batch replace, keep, take the maximum or fill by their rule; a changed
    content_sha, in the batch or against the pool, clears the verdict columns."""
    new = fold_batch(batch, order, key)
    joined = pool.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    old, hit, came = (lambda c: F.col(f"o.{c}")), F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    drift = hit & came & (F.col("n._drift") | ~F.col("n._first_sha").eqNullSafe(old("content_sha")))
    out = []
    for c in pool.columns:
        have = c in new.columns
        if c == key:
            x = F.coalesce(f"o.{c}", f"n.{c}")
        elif c in REPLACED and have:
            x = F.when(came, F.col(f"n.{c}")).otherwise(old(c))
        elif c == "date_published" and have:
            x = F.coalesce(f"n.{c}", f"o.{c}")
        elif c in ("signal", "last_seen") and have:
            x = F.greatest(f"o.{c}", f"n.{c}")
        elif c in VERDICTS:
            x = F.when(drift, None).otherwise(old(c))
        elif have:
            x = F.when(hit, old(c)).otherwise(F.col(f"n.{c}"))
        else:
            x = old(c)
        out.append(x.alias(c))
    return joined.select(*out)


def seen_counts(runs: DataFrame, key: str = "item_key") -> DataFrame:
    """key -> the number of distinct episodes that met it."""
    return runs.select(key, "episode").distinct().groupBy(key).agg(F.count("*").alias("seen_count"))


def write_columns(pool: DataFrame, rows: DataFrame, columns: list[str], key: str = "item_key") -> DataFrame:
    """Some columns of the pool from judged rows, one a key; unknown keys become rows of their own."""
    joined = pool.alias("o").join(rows.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    came = F.col(f"n.{key}").isNotNull()
    pick = lambda c: F.coalesce(f"o.{c}", f"n.{c}") if c == key else F.when(came, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in columns else F.col(f"o.{c}")
    return joined.select(*[pick(c).alias(c) for c in pool.columns])


def write_dedup(pool: DataFrame, rows: DataFrame) -> DataFrame:
    """Dedup verdicts (item_key, verdict, cluster_id); a later duplicate of an item's own cluster doesn't suppress it."""
    new = rows.select("item_key", F.col("verdict").alias("_v"), F.col("cluster_id").alias("_c"))
    joined = pool.join(new, "item_key", "left")
    own = (F.col("_v") == "suppressed") & (F.col("dedup_cluster_id") == F.col("_c"))
    take = F.col("_v").isNotNull() & ~F.coalesce(own, F.lit(False))
    return joined.withColumns({"dedup_verdict": F.when(take, F.col("_v")).otherwise(F.col("dedup_verdict")), "dedup_cluster_id": F.when(take, F.col("_c")).otherwise(F.col("dedup_cluster_id"))}).drop("_v", "_c")


def mark_used(pool: DataFrame, keys: DataFrame, episode: str) -> DataFrame:
    """used_in_episode for the keys, where it is still null."""
    hit = keys.select("item_key").distinct().withColumn("_hit", F.lit(True))
    return pool.join(hit, "item_key", "left").withColumn("used_in_episode", F.coalesce("used_in_episode", F.when(F.col("_hit"), F.lit(episode)))).drop("_hit")


def eligibility(episode: Column, start: Column, end: Column, grace_from: Column, floor: Column, pub="date_published", first_seen="first_seen", used="used_in_episode", daily="daily") -> Column:
    """A struct of ok and reason; the first rule that fits decides."""
    p, s, u = F.col(pub), F.col(first_seen), F.col(used)
    late = s >= grace_from
    reason = (
        F.when(u.isNotNull() & (u != episode), "used").when((p >= start) & (p < end), "window").when(p.isNull() & late, "carry-nodate").when(p.isNull(), "nodate-old")
        .when((p < start) & F.coalesce(F.col(daily), F.lit(False)), "stale-daily").when((p < start) & (p < floor), "stale-floor")
        .when((p < start) & late, "carry-stale").when(p < start, "stale").otherwise("future")
    )
    return F.struct(reason.isin("window", "carry-nodate", "carry-stale").alias("ok"), reason.alias("reason"))


def published_clusters(pool: DataFrame) -> DataFrame:
    return pool.where("used_in_episode is not null and dedup_cluster_id is not null").select("dedup_cluster_id").distinct()


def projected_dedup(pool: DataFrame, published: DataFrame) -> DataFrame:
    """Adds projected: suppressed stays; in a published cluster reissue stays and all else is suppressed; null is gray."""
    known = published.select("dedup_cluster_id").distinct().withColumn("_pub", F.lit(True))
    v = F.col("dedup_verdict")
    shown = F.when(v == "suppressed", "suppressed").when(F.col("_pub") & (v == "reissue"), "reissue").when(F.col("_pub"), "suppressed").otherwise(F.coalesce(v, F.lit("gray")))
    return pool.join(known, "dedup_cluster_id", "left").withColumn("projected", shown).drop("_pub")


def candidates(pool: DataFrame, runs: DataFrame, episode: Column, start: Column, end: Column, grace_from: Column, floor: Column, suppressed: bool = False) -> DataFrame:
    """Eligible rows that the episode's own run didn't bring, kept or in review, by value; suppressed: those instead."""
    rows = pool.where(F.col("filter_verdict").isin("keep", "review")).join(runs.where(F.col("episode") == episode).select("item_key").distinct(), "item_key", "left_anti")
    rows = projected_dedup(rows.withColumn("_e", eligibility(episode, start, end, grace_from, floor)).where("_e.ok"), published_clusters(pool))
    rows = rows.where(F.col("projected") == "suppressed" if suppressed else F.col("projected") != "suppressed")
    return rows.withColumn("reason", F.col("_e.reason")).drop("_e").orderBy(F.desc_nulls_last("news_value"), F.desc_nulls_last("ai_relevance"), "item_key")


def needs_summary(pool: DataFrame, episode: Column, start: Column, end: Column, grace_from: Column, floor: Column, limit: int) -> DataFrame:
    """The rows in the window or carried, whatever their source's rhythm, that lack a summary: the last seen first, at most limit."""
    rows = pool.where(F.col("filter_verdict").isin("keep", "review") & F.col("summary").isNull()).withColumn("_daily", F.lit(False))
    rows = rows.where(eligibility(episode, start, end, grace_from, floor, daily="_daily")["ok"]).drop("_daily")
    return rows.orderBy(F.desc("first_seen"), "item_key").limit(limit)


def latest_by(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key (key-value tables, source state), by one aggregation."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias("_r")).select("_r.*")


def save_state(old: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """Rows of new over old; a null column keeps the old value."""
    joined = old.alias("o").join(new.alias("n"), key, "full_outer")
    return joined.select(key, *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in old.columns if c != key])


def fail_streaks(runs: DataFrame, key: str, order: str, status: str) -> DataFrame:
    """key -> consecutive_fails at the end and whether it stands at 3 or more: ok resets, skipped counts as nothing.

    One aggregation: the failures after a key's last ok.
    """
    seen = runs.where(F.col(status) != "skipped")
    last_ok = seen.groupBy(key).agg(F.max(F.when(F.col(status) == "ok", F.col(order))).alias("_ok"))
    fails = seen.join(last_ok, key).groupBy(key).agg(F.count_if((F.col(status) != "ok") & (F.col("_ok").isNull() | (F.col(order) > F.col("_ok")))).alias("consecutive_fails"))
    return fails.withColumn("alert", F.col("consecutive_fails") >= 3)


VERDICT_VALUES = ("keep", "drop", "review")
SUMMARIES = ("title_zh", "summary", "entities", "facts", "section_guess", "summary_sha", "summary_prompt", "summary_model", "summary_at")
# Models and reasons that stand for a verdict that nobody gave, and the prompts of real ones.
PLACEHOLDER_MODELS, PLACEHOLDER_REASONS, VERDICT_PROMPT = ("l0-url-hash", "no-llm"), ("coverage-miss", "no-llm"), "filter-v2"


def write_judged(pool: DataFrame, base: DataFrame, rows: DataFrame, columns: tuple[str, ...], key: str = "item_key") -> DataFrame:
    """Some columns of the pool from judged rows, one a key; a key that the pool lacks becomes a row with the base columns
    of its item, where there is one."""
    new = rows.select(key, *columns).join(base.drop(*columns), key, "left")
    joined = pool.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    old, came = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(f"o.{c}", f"n.{c}")
        if c in columns:
            return F.when(came, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        return F.when(old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")) if c in new.columns else F.col(f"o.{c}")

    return joined.select(*[value(c).alias(c) for c in pool.columns])


def write_verdicts(pool: DataFrame, base: DataFrame, verdicts: DataFrame, prompt: str, now: Column) -> DataFrame:
    """Verdict rows (item_key, verdict, ai_relevance, news_value, reasons, prov) into the pool, with the content that was judged."""
    sha = base.select("item_key", F.col("content_sha").alias("judged_content_sha"))
    rows = verdicts.join(sha, "item_key", "left").select(
        "item_key", F.when(F.col("verdict").isin(*VERDICT_VALUES), F.col("verdict")).otherwise("review").alias("filter_verdict"), "judged_content_sha", F.coalesce("prov.prompt", F.lit(prompt)).alias("verdict_prompt"),
        F.col("prov.model").alias("verdict_model"), F.coalesce("prov.decided_at", now).alias("verdict_at"), "ai_relevance", "news_value", F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"),
    )
    return write_judged(pool, base, rows, VERDICTS)


def write_summaries(pool: DataFrame, base: DataFrame, summaries: DataFrame, now: Column) -> DataFrame:
    """Summary rows (item_key, title_zh, summary, entities, facts, section_guess, prov) into the pool, with the content's hash."""
    none = F.array().cast("array<string>")
    sha = base.select("item_key", F.col("content_sha").alias("summary_sha"))
    rows = summaries.join(sha, "item_key", "left").select(
        "item_key", "title_zh", "summary", F.coalesce("entities", none).alias("entities"), F.coalesce("facts", none).alias("facts"), "section_guess", "summary_sha", F.col("prov.prompt").alias("summary_prompt"),
        F.col("prov.model").alias("summary_model"), F.coalesce("prov.decided_at", now).alias("summary_at"),
    )
    return write_judged(pool, base, rows, SUMMARIES)


def _prov(model: Column, prompt: Column, key: Column, at: Column) -> Column:
    return F.struct(model.alias("model"), prompt.alias("prompt"), F.substring(F.sha2(key, 256), 1, 16).alias("input_sha"), at.alias("decided_at"))


def raw_of_pool(pool: DataFrame, now: Column) -> DataFrame:
    """Pool rows as raw items again, fetched from the cache."""
    body = F.coalesce("content_text", F.lit(""))
    source = F.struct(F.coalesce(F.nullif("source_name", F.lit("")), F.lit("?")).alias("name"), F.coalesce("source_feed_url", F.lit("")).alias("feed_url"), F.coalesce(F.nullif("source_kind", F.lit("")), F.lit("rss")).alias("kind"), "item_guid")
    fetch = F.struct(F.lit(200).alias("status"), F.lit("cache").alias("via"), F.lit(True).alias("reachable"), F.lit(None).cast("string").alias("etag"), F.when(body != "", F.substring(F.sha2(body, 256), 1, 16)).alias("content_sha256"))
    return pool.select(
        F.lit("raw_item/1").alias("schema"), "item_key", F.col("item_key").alias("id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("url_canon", F.lit("")).alias("url_canon"), F.coalesce("title", F.lit("")).alias("title"), "content_text",
        "date_published", F.coalesce("date_fetched", now).alias("date_fetched"), "language", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "image", source.alias("_source"), fetch.alias("_fetch"), F.col("raw_ref").alias("_raw_ref"),
    )


def summary_of_pool(pool: DataFrame, now: Column) -> DataFrame:
    """Pool rows as summary records."""
    none, text = F.array().cast("array<string>"), lambda c: F.coalesce(c, F.lit(""))
    prov = _prov(F.coalesce(F.nullif("summary_model", F.lit("")), F.lit("pool")), F.coalesce(F.nullif("summary_prompt", F.lit("")), F.lit("summary-v1")), F.col("item_key"), F.coalesce("summary_at", now))
    return pool.select(F.lit("summary/1").alias("schema"), "item_key", text("title_zh").alias("title_zh"), text("summary").alias("summary"), F.coalesce("entities", none).alias("entities"), F.coalesce("facts", none).alias("facts"), "section_guess", prov.alias("prov"))


def verdict_of_pool(pool: DataFrame, now: Column) -> DataFrame:
    """Pool rows as verdict records; a relevance of nothing counts as a half."""
    prov = _prov(F.coalesce(F.nullif("verdict_model", F.lit("")), F.lit("pool")), F.coalesce(F.nullif("verdict_prompt", F.lit("")), F.lit(VERDICT_PROMPT)), F.col("item_key"), F.coalesce("verdict_at", now))
    verdict = F.when(F.col("filter_verdict").isin(*VERDICT_VALUES), F.col("filter_verdict")).otherwise("review")
    return pool.select(F.lit("filter_verdict/1").alias("schema"), "item_key", verdict.alias("verdict"), F.coalesce(F.nullif("ai_relevance", F.lit(0.0)), F.lit(0.5)).alias("ai_relevance"), "news_value", F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"), prov.alias("prov"))


def is_real_verdict(prov: Column, reasons: Column, model: str) -> Column:
    """Whether a judge gave a verdict: by its prompt, the configured model, and a first reason that is no placeholder's."""
    first = F.coalesce(F.get(reasons, 0), F.lit(""))
    placeholder = F.exists(F.array(*[F.lit(x) for x in PLACEHOLDER_REASONS]), lambda x: F.startswith(first, x))
    return F.coalesce((prov["prompt"] == VERDICT_PROMPT) & (prov["model"] == model) & ~prov["model"].isin(*PLACEHOLDER_MODELS) & ~placeholder, F.lit(False))


def floor_cut(pool: DataFrame, runs: DataFrame, episode: Column, grace_from: Column, floor: Column) -> DataFrame:
    """One row: how many rows only the stale floor keeps out; sources of the day are not carried anyway."""
    rows = pool.where(F.col("filter_verdict").isin("keep", "review") & (F.col("used_in_episode").isNull() | (F.col("used_in_episode") == episode)) & F.col("title_zh").isNotNull() & F.col("summary").isNotNull())
    rows = rows.where((F.col("date_published") < floor) & (F.col("first_seen") >= grace_from) & ~F.coalesce("daily", F.lit(False)))
    return rows.join(runs.where(F.col("episode") == episode).select("item_key").distinct(), "item_key", "left_anti").agg(F.count("*").alias("n_stale_floor"))


def by_keys(pool: DataFrame, keys: DataFrame) -> DataFrame:
    return pool.join(keys.select("item_key").distinct(), "item_key", "left_semi")


def repairs(pool: DataFrame, batch: DataFrame, episode: Column, start: Column, end: Column, grace_from: Column, floor: Column, limit: int) -> DataFrame:
    """Carried rows that still lack a summary: the newest due ones that the day's batch doesn't bring itself."""
    return needs_summary(pool, episode, start, end, grace_from, floor, limit).join(batch.select("item_key").distinct(), "item_key", "left_anti")


def pool_stats(pool: DataFrame, days: int = 12) -> DataFrame:
    """what, value, n: rows in all, by verdict, by the latest days first seen, used, summarised, signals."""
    count = lambda rows, what, value: rows.groupBy(F.lit(what).alias("what"), value.alias("value")).agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    total = lambda rows, what: rows.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), none.alias("value"), "n")
    seen = count(pool, "first_seen", F.col("first_seen").cast("string")).orderBy(F.desc("value")).limit(days)
    out = total(pool, "items").union(count(pool, "verdict", F.coalesce("filter_verdict", F.lit("(unjudged)")))).union(seen)
    return out.union(total(pool.where("used_in_episode is not null"), "used")).union(total(pool.where("summary is not null"), "with_summary")).union(total(pool.where("signal = 1"), "signal"))


def is_pool_day(run: Column, today: Column) -> Column:
    """Whether a run's name is a day that has come: only such runs go into the pool."""
    return run.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(run, "yyyy-MM-dd").isNotNull() & (run <= today)


def is_past_deadline(decided: Column, now: Column, day: Column, clock: str) -> Column:
    """Whether a day is released without a decision: none was made and its deadline, local time, has passed."""
    hours, minutes = clock.split(":")
    local = day.cast("timestamp") + F.make_interval(hours=F.lit(int(hours)), mins=F.lit(int(minutes)))
    return ~F.coalesce(decided, F.lit(False)) & (now > F.to_utc_timestamp(local, "Asia/Shanghai"))


def state_maps(state: DataFrame) -> DataFrame:
    """Stored source state (name, seen and health as JSON) as maps; what is no JSON object is an empty map."""
    parsed = lambda c: F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return state.select("name", parsed("seen").alias("seen"), parsed("health").alias("health"))


def kv_get(table: DataFrame, key: str, schema: str) -> DataFrame:
    """The value of a key, decoded; no row where the key is absent."""
    return table.where(F.col("key") == key).select("key", F.from_json("value", schema).alias("value"))


def migrate(parts: dict[str, tuple[DataFrame, DataFrame]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables of two stores as one each, and table, expected, found for those whose counts don't add up."""
    merged = {name: a.unionByName(b, allowMissingColumns=True).distinct() for name, (a, b) in parts.items()}
    checks = None
    for name, (a, b) in parts.items():
        want = a.unionByName(b, allowMissingColumns=True).agg(F.count("*").alias("expected"))
        row = want.join(merged[name].agg(F.count("*").alias("found")), F.lit(True)).select(F.lit(name).alias("table"), "expected", "found")  # one row each
        checks = row if checks is None else checks.union(row)
    return merged, checks.where("expected <> found")


def open_pool(runs: DataFrame, episode: str, grace_days: int = 2, stale_days: int = 14) -> DataFrame:
    """One row of episode, start, end, grace_from, floor if the episode is a day and the pool has runs of it; else none:
    then the files of the run alone count."""
    day = F.try_to_date(F.lit(episode), "yyyy-MM-dd")
    row = runs.where((F.col("episode") == episode) & day.isNotNull()).select("episode").limit(1)
    start = window_start(day)
    return row.select("episode", start.alias("start"), window_end(day).alias("end"), F.date_sub(day, grace_days).cast("timestamp").alias("grace_from"), (start - F.make_interval(days=F.lit(stale_days))).alias("floor"))


def import_run(pool: DataFrame, items: DataFrame, verdicts: DataFrame, summaries: DataFrame, dedup: DataFrame, kept: DataFrame, episode: str, model: str, now: Column, order: Column) -> DataFrame:
    """A past run's artifacts replayed into the pool: its items upserted, the verdicts that a judge gave, summaries of
    known prompts, dedup rows, and the kept keys as used. items are base columns; all rows are one a key."""
    out = upsert(pool, items, order)
    out = write_verdicts(out, items, verdicts.where(is_real_verdict(F.col("prov"), F.col("reasons"), model)), VERDICT_PROMPT, now)
    out = write_summaries(out, items, summaries.where(F.col("prov.prompt").rlike(r"^summary-v\d+$")), now)
    return mark_used(write_dedup(out, dedup), kept, episode)
