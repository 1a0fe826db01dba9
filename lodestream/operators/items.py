"""Raw items: from a parsed row to the contract's record, its check, and the pool row that it becomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.dates import parse_date, rfc3339
from lodestream.functions.hashing import content_sha
from lodestream.functions.text import bounded_text, guess_lang, title_norm
from lodestream.functions.urls import item_key, slug_title, url_canon
from lodestream.operators.validate import quarantine

# The contract's caps and enumerations.
TEXT_CAP, LEAST_TEXT, TRUSTED_TEXT, DAYS_AHEAD = 8000, 200, 500, 2
VIAS, KINDS = ("direct", "mirror", "cache", "manual"), ("rss", "atom", "api", "scrape", "manual")
FEED_KINDS = ("rss", "atom", "api")

#: Columns that a parsed row may lack, and what stands for them.
OPTIONAL = {
    "title": "string", "summary": "string", "date": "string", "image": "string", "tags": "array<string>", "guid": "string", "language": "string", "source_name": "string", "feed_url": "string",
    "kind": "string", "date_fetched": "string", "status": "int", "via": "string", "reachable": "boolean", "etag": "string", "content_sha256": "string", "raw_ref": "string",
}


def raw_items(rows: DataFrame, unicode: bool = True) -> DataFrame:
    """Parsed rows (url and any of OPTIONAL) as records of the contract raw_item/1; other columns are dropped.

    A row without a title gets one from its URL; texts are capped; a route that is no contract value counts as a mirror.
    unicode=False normalises titles in the JVM alone.
    """
    for name, kind in OPTIONAL.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    canon = url_canon(F.col("url"))
    named = title_norm(F.col("title"), unicode=unicode)
    via = F.coalesce("via", F.lit("direct"))
    source = F.struct(F.coalesce("source_name", F.lit("?")).alias("name"), F.coalesce("feed_url", F.lit("")).alias("feed_url"), F.coalesce("kind", F.lit("rss")).alias("kind"), F.col("guid").alias("item_guid"))
    fetch = F.struct(F.coalesce("status", F.lit(200)).alias("status"), F.when(via.isin(*VIAS), via).otherwise("mirror").alias("via"), F.coalesce("reachable", F.lit(True)).alias("reachable"), "etag", "content_sha256")
    key = item_key(F.col("url"))
    return rows.select(
        F.lit("raw_item/1").alias("schema"), key.alias("item_key"), key.alias("id"), "url", canon.alias("url_canon"), F.coalesce(F.nullif(named, F.lit("")), slug_title(F.col("url"))).alias("title"),
        bounded_text(F.col("summary"), TEXT_CAP).alias("content_text"), F.col("date").alias("date_published"), "date_fetched",
        F.coalesce("language", guess_lang(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))))).alias("language"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "image",
        source.alias("_source"), fetch.alias("_fetch"), F.col("raw_ref").alias("_raw_ref"),
    )


def item_checks() -> tuple[tuple[str, Column], ...]:
    """The contract of raw_item/1 as named conditions."""
    return (
        ("schema", F.col("schema") == "raw_item/1"), ("item_key", F.col("item_key").rlike("^[0-9a-f]{16}$")), ("id", F.col("id") == F.col("item_key")), ("url", F.col("url").isNotNull()),
        ("title", F.col("title").isNotNull()), ("date_fetched", F.col("date_fetched").isNotNull()), ("kind", F.col("_source.kind").isin(*KINDS)), ("via", F.col("_fetch.via").isin(*VIAS)),
    )


def checked_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the contract, their texts capped once more, and the others with the names of what they break."""
    return quarantine(items.withColumn("content_text", bounded_text(F.col("content_text"), TEXT_CAP)), *item_checks())


def base_columns(items: DataFrame, episode: Column, now: Column) -> DataFrame:
    """The pool's base columns of raw items: dates in UTC seconds, a signal flag from the tags, the content's hash."""
    date = rfc3339(parse_date(F.col("date_published")))
    return items.select(
        "item_key", "url", "url_canon", "title", "content_text", date.alias("date_published"), F.coalesce("date_fetched", now).alias("date_fetched"), "language", "image", F.col("_raw_ref").alias("raw_ref"),
        F.col("_source.name").alias("source_name"), F.col("_source.feed_url").alias("source_feed_url"), F.col("_source.kind").alias("source_kind"), F.col("_source.item_guid").alias("item_guid"), "tags",
        F.array_contains("tags", "signal").cast("int").alias("signal"), F.lit(False).alias("daily"), content_sha(F.col("title"), F.col("date_published"), F.col("content_text"), F.col("_source.name")).alias("content_sha"),
        episode.alias("first_seen"), episode.alias("last_seen"), F.lit(1).cast("long").alias("seen_count"),
    )


def insert_manually(items: DataFrame, manual: DataFrame) -> DataFrame:
    """A batch with manual items, which replace those of their key."""
    return items.join(manual.select("item_key"), "item_key", "left_anti").unionByName(manual, allowMissingColumns=True)


def backfill(items: DataFrame, pages: DataFrame, now: Column, budget: int, order: str) -> DataFrame:
    """Items with what their pages gave, where the feed's own is short or the item is a signal.

    pages: url, ok, text, title, date, image, language, raw_ref. The first ``budget`` items in order that need it are
    filled: a longer text wins; a title where there was none but that of the URL, or for signals; a date only from a page
    with TRUSTED_TEXT characters, and not more than DAYS_AHEAD days ahead; image and language where they are missing.
    """
    signal = F.array_contains("tags", "signal")
    needs = signal | (F.length(F.coalesce("content_text", F.lit(""))) < LEAST_TEXT)
    first = items.where(needs).orderBy(order).limit(budget).select(F.col(order).alias("_o"))
    p = pages.select(F.col("url").alias("_u"), F.col("ok").alias("_ok"), *[F.col(c).alias(f"_p_{c}") for c in ("text", "title", "date", "image", "language", "raw_ref")])
    rows = items.join(first, F.col(order) == F.col("_o"), "left").join(p, (F.col("_o").isNotNull()) & (F.col("url") == F.col("_u")), "left")
    text = F.trim(F.coalesce("_p_text", F.lit("")))
    good = F.coalesce("_ok", F.lit(False))
    longer = good & (F.length(text) > F.length(F.coalesce("content_text", F.lit(""))))
    retitle = good & (F.coalesce("_p_title", F.lit("")) != "") & (signal | (F.coalesce("title", F.lit("")) == "") | (F.col("title") == slug_title(F.col("url"))))
    when = parse_date(F.col("_p_date"))
    dated = good & F.col("date_published").isNull() & (F.length(text) >= TRUSTED_TEXT) & (when <= now + F.make_interval(days=F.lit(DAYS_AHEAD)))
    filled = {
        "content_text": F.when(longer, bounded_text(text, TEXT_CAP)).otherwise(F.col("content_text")), "title": F.when(retitle, title_norm(F.col("_p_title"), unicode=False)).otherwise(F.col("title")),
        "date_published": F.when(dated, rfc3339(when)).otherwise(F.col("date_published")), "image": F.when(good, F.coalesce(F.nullif("image", F.lit("")), "_p_image")).otherwise(F.col("image")),
        "language": F.when(good, F.coalesce(F.nullif("language", F.lit("")), "_p_language")).otherwise(F.col("language")), "_raw_ref": F.when(good, F.col("_p_raw_ref")).otherwise(F.col("_raw_ref")),
        "_fetch": F.when(F.col("_ok") == F.lit(False), F.col("_fetch").withField("reachable", F.lit(False))).otherwise(F.col("_fetch")),
    }
    return rows.withColumns(filled).select(*items.columns)


def source_kind(url: Column, kind: Column, hosts: list[tuple[tuple[str, ...], str]]) -> Column:
    """The kind of a link by the first list that names a part of its host; else media for feeds, other for the rest."""
    host = F.lower(F.substring_index(F.regexp_replace(F.coalesce(url, F.lit("")), "^https?://", ""), "/", 1))
    found = F.when(kind == "manual", "other")
    for parts, name in hosts:
        found = found.when(F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(host, p)), name)
    return found.when(kind.isin(*FEED_KINDS), "media").otherwise("other")


def outbound(is_self: Column, url: Column, own_hosts: tuple[str, ...], media_host: str) -> Column:
    """The address that a link post leads to: empty for a site's own pages and for posts without one; hosted media stay."""
    host = F.substring_index(F.regexp_replace(F.coalesce(url, F.lit("")), r"^https?://(www\.|old\.|np\.)?", ""), "/", 1)
    own = F.exists(F.array(*[F.lit(h) for h in own_hosts]), lambda h: (host == h) | F.endswith(host, F.concat(F.lit("."), h)))
    return F.when(F.coalesce(is_self, F.lit(False)), "").when((host != "") & ~own, url).when(F.endswith(host, F.lit(media_host)), url).otherwise("")


def policy_action(rows: DataFrame, url: str, rules: DataFrame, default: str) -> DataFrame:
    """Adds action and rule: the first rule, by place, whose domain the URL's host is or ends in; else the default.

    rules: place, domain, action; a configured list. The host's own suffixes meet the domains in an equi-join.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z]+://([^/?#:]*)", 1)), F.lit(""))
    hosts = rows.select(host.alias("_host")).distinct()
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("_host", F.explode(suffixes).alias("domain")).join(rules, "domain").groupBy("_host").agg(F.min(F.struct("place", "domain", "action")).alias("_r"))
    out = rows.withColumn("_host", host).join(met, "_host", "left")
    return out.withColumns({"action": F.coalesce("_r.action", F.lit(default)), "rule": F.coalesce(F.concat(F.lit("rule:"), F.col("_r.domain")), F.lit("default"))}).drop("_host", "_r")


def data_block(key: Column, body: Column) -> Column:
    """An untrusted text between marks that name its item."""
    return F.concat(F.lit('<item_data id="'), key, F.lit('">\n'), body, F.lit("\n</item_data>"))


def first_rows(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_n") <= n).drop("_n")
