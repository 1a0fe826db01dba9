"""Fetched responses as rows: classes, source registry defaults and collection status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of bot walls and of pages that are a mount point for scripts.
WALL = (
    r"(?i)wappoc_appmsgcaptcha|TCaptcha\.js|cf-chl-|_cf_chl_opt|challenge-platform/(?!scripts/jsd)|Just a moment|环境异常|安全验证|awswaf"
    r"|aws-waf-token|geetest|Incapsula|ddos-guard|enable javascript and cookies|安全检查|access denied - godaddy|验证手机|访问过于频繁"
)
SHELL = (
    r"(?i)id=[\"'](?:root|app|react-root|__next|__nuxt)[\"']|enable javascript|javascript is (?:not available|disabled|required)"
    r"|需要启用\s*javascript|请开启\s*javascript|window\.__INITIAL_STATE__"
)
DOCUMENT_ROOTS = ("rss", "feed", "rdf", "opml", "urlset", "sitemapindex")
FEED_ROOTS = ("rss", "feed", "rdf", "opml")
PROBE = 1 << 18
#: What a source without the key has.
DEFAULTS = {"method": "rss", "enabled": True, "proxy": "prefer", "tier": "A", "max_items_per_source": 40, "freshness_sla_h": 36, "daily": False}
SOURCE_SCHEMA = "name string, feed_url string, method string, enabled boolean, proxy string, tier string, failover array<string>, max_items_per_source int, freshness_sla_h int, daily boolean"


def sources_table(spark, entries: list[dict]) -> DataFrame:
    """Registry entries with their defaults; those without a name are left out. The list is a configuration."""
    rows = [(e["name"], e.get("feed_url"), *[e.get(k, DEFAULTS[k]) for k in ("method", "enabled", "proxy", "tier")], e.get("failover", []), *[e.get(k, DEFAULTS[k]) for k in ("max_items_per_source", "freshness_sla_h", "daily")]) for e in entries if e.get("name")]
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def xml_root_tag(body: Column) -> Column:
    """The lower-case local name of the root element within the first 600 characters, else the empty string."""
    head = F.lower(F.regexp_replace(F.substring(F.coalesce(body, F.lit("")), 1, 600), r"^\s+", ""))
    rest = F.when(head.startswith("<?xml"), F.regexp_extract(F.substring(head, 6, 600), r"<\s*([a-z_][\w.:+-]*)", 1)).otherwise(F.regexp_extract(head, r"^<\s*([a-z_][\w.:+-]*)", 1))
    return F.substring_index(rest, ":", -1)


def looks_like_feed(body: Column) -> Column:
    return xml_root_tag(body).isin(*FEED_ROOTS)


def looks_shell(body: Column) -> Column:
    head = F.substring(F.coalesce(body, F.lit("")), 1, PROBE)
    visible = F.regexp_replace(F.regexp_replace(head, "<[^>]+>", " "), "\\s+", "")
    return head.contains("<") & head.rlike(SHELL) & (F.length(visible) < 80)


def classify(status: Column, body: Column) -> Column:
    """ok, walled, rate_limited, empty, shell_only or http_<status>; a wall comes before all but 304."""
    text = F.substring(F.coalesce(body, F.lit("")), 1, PROBE)
    wall = text.rlike(WALL) & ~xml_root_tag(body).isin(*DOCUMENT_ROOTS)
    good = status.between(200, 299)
    return (
        F.when(status == 304, "ok").when(wall, "walled").when(status == 429, "rate_limited").when(good & (text == ""), "empty")
        .when(good & looks_shell(body), "shell_only").when(good, "ok").otherwise(F.concat(F.lit("http_"), status.cast("string")))
    )


def collection_status(sources: DataFrame, fetches: DataFrame, known_methods: tuple[str, ...], proxy_up: bool) -> DataFrame:
    """Each source with its status: unknown_method, disabled, proxy_down, manual_entry, not_modified or its response's class."""
    rows = sources.join(fetches, "name", "left")
    status = (
        F.when(~F.col("method").isin(*known_methods), "unknown_method").when(~F.col("enabled"), "disabled").when((F.col("proxy") == "require") & F.lit(not proxy_up), "proxy_down")
        .when(F.col("method") == "manual", "manual_entry").when(F.col("http_status").isNull(), "collector_not_ready").when(F.col("http_status") == 304, "not_modified")
        .otherwise(classify(F.col("http_status"), F.col("body")))
    )
    return rows.withColumn("status", status)


def fallback_kind(method: Column, url: Column) -> Column:
    """Which public fallback a platform source has."""
    return F.when((method == "reddit") & url.rlike(r"\.rss(\?|$)"), "rss_fallback").when((method == "weibo") & url.contains("weibo"), "json_fallback")


def stamp_via(tags: Column, label: str) -> Column:
    return F.array_distinct(F.array_append(F.coalesce(tags, F.array().cast("array<string>")), F.lit(f"via:{label}")))


def save_raw(responses: DataFrame, path: str) -> None:
    """The raw landing zone, by day and source, the last body of a URL and day."""
    keyed = responses.withColumn("ref", F.substring(F.sha2("url", 256), 1, 8))
    last = keyed.groupBy("day", "source", "ref").agg(F.max_by(F.struct("url", "body"), "fetched_at").alias("r")).select("day", "source", "ref", "r.*")
    last.write.mode("append").partitionBy("day", "source").parquet(path)
