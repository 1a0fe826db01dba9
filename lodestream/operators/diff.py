"""What is new on a page, a sitemap or a source: links, signatures and signals against what was seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.hashing import sha16
from lodestream.functions.text import strip_tags
from lodestream.functions.urls import slug_title, url_canon, url_host, urljoin

# Paths that are never articles, and those that look like them.
NOISE = (
    r"(?i)login|signin|signup|subscribe|search|/tag|category|author|about|contact|privacy|terms|legal|rss|atom|feed|cdn"
    r"|static|assets|_next|wp-json|wp-admin|account|settings|share|comment"
)
NEWSISH = r"(?i)news|blog|changelog|release|article|post|docs|updates|announce|notes|engineering|research|/20\d\d"
LINK_CAP, ASSET_CAP, SEEN_CAP, SIGNATURE_LINKS = 120, 40, 5000, 80
HREF = r"(?i)<a\b[^>]*?href=[\"']([^\"'#]+)"
MARKDOWN = r"\[[^\]]*\]\(([^)\s]+)"
ASSET = r"(?i)<(?:script|link)\b[^>]*?(?:src|href)=[\"']([^\"']+)"


def _bare_host(host: Column) -> Column:
    """Leading w and . characters off, whatever their number: the host test's own rule."""
    return F.regexp_replace(host, r"^[w.]+", "")


def page_links(pages: DataFrame, key: str, base: str, text: str, markdown: bool = False, cap: int = LINK_CAP) -> DataFrame:
    """key, place, url, canon: article-like links of a page to its own host, the first of each canonical URL, at most cap."""
    raw = F.regexp_extract_all(F.col(text), F.lit(MARKDOWN if markdown else HREF), 1)
    links = pages.select(key, F.col(base).alias("_base"), F.posexplode(raw).alias("place", "_raw"))
    href = F.trim(F.replace("_raw", F.lit("&amp;"), F.lit("&")))
    links = links.withColumn("_href", href).where(~F.col("_href").rlike("^(javascript:|mailto:|data:|tel:)"))
    links = links.withColumn("url", urljoin(F.col("_base"), F.col("_href"))).where(F.col("url").rlike("^https?://"))
    host, own = url_host(F.col("url")), url_host(F.col("_base"))
    links = links.where((host == own) | (host == _bare_host(own)) | (host == F.concat(F.lit("www."), _bare_host(own))))
    path = F.regexp_extract("url", r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    depth = F.size(F.filter(F.split(path, "/"), lambda s: s != ""))
    links = links.where(~path.rlike(NOISE) & (path.rlike(NEWSISH) | (depth >= 2))).withColumn("canon", url_canon(F.col("url")))
    first = links.groupBy(key, "canon").agg(F.min(F.struct("place", "url")).alias("f")).select(key, "f.place", "f.url", "canon")
    rank = F.row_number().over(Window.partitionBy(key).orderBy("place"))
    return first.withColumn("_n", rank).where(F.col("_n") <= cap).drop("_n")


def asset_fingerprint(text: Column) -> Column:
    """The first absolute script and style addresses of a page."""
    found = F.transform(F.regexp_extract_all(F.substring(text, 1, 1 << 18), F.lit(ASSET), 1), lambda u: F.trim(F.replace(u, F.lit("&amp;"), F.lit("&"))))
    full = F.transform(found, lambda u: F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u))
    return F.slice(F.filter(full, lambda u: u.startswith("http")), 1, ASSET_CAP)


def page_signature(pages: DataFrame, links: DataFrame, key: str, text: str) -> DataFrame:
    """key, page_sig: a hash of the headings and the first links' canonical URLs; of the assets where there is neither."""
    listed = links.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "canon"))).alias("l"))
    rows = pages.select(key, text).join(listed, key, "left")
    heads = strip_tags(F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(r"(?s)<h[23][^>]*>(.*?)</h[23]>"), 1), 1, 80), " "))
    canons = F.array_join(F.transform(F.slice(F.coalesce("l", F.array().cast("array<struct<place:int,canon:string>>")), 1, SIGNATURE_LINKS), lambda x: x["canon"]), ",")
    bare = (F.trim(heads) == "") & F.col("l").isNull()
    basis = F.when(bare, F.concat(heads, F.lit("|assets:"), F.array_join(asset_fingerprint(F.col(text)), ","))).otherwise(heads)
    return rows.select(key, sha16(F.concat(basis, F.lit("|"), canons)).alias("page_sig"))


def unseen(urls: DataFrame, seen: DataFrame, source: str, canon: str, order: str, cap: int) -> DataFrame:
    """The URLs of each source that were not seen before, article-like paths first, at most cap a source."""
    new = urls.join(seen.select(source, canon).distinct(), [source, canon], "left_anti")
    path = F.regexp_extract("url", r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    rank = F.row_number().over(Window.partitionBy(source).orderBy((~path.rlike(NEWSISH)).cast("int"), order))
    return new.withColumn("rank", rank).where(F.col("rank") <= cap)


def signal_items(urls: DataFrame, url: str = "url", lastmod: str | None = None) -> DataFrame:
    """Signal rows: a title from the path, no date, the tag signal and the change date as a tag."""
    tags = F.array(F.lit("signal"))
    if lastmod:
        tags = F.when(F.col(lastmod).isNotNull(), F.array(F.lit("signal"), F.concat(F.lit("lastmod:"), F.substring(F.col(lastmod).cast("string"), 1, 10)))).otherwise(tags)
    return urls.withColumns({"title": slug_title(F.col(url)), "date_published": F.lit(None).cast("string"), "tags": tags})


def emitted(items: DataFrame, seen: DataFrame, source: str, order: str, cap: int) -> DataFrame:
    """What a source emits: ordinary rows, then signals that are new or page-wide, at most cap; with is_new."""
    known = seen.select(source, "url_canon").distinct().withColumn("_seen", F.lit(True))
    rows = items.join(known, [source, "url_canon"], "left")
    signal, page = F.array_contains("tags", "signal"), F.array_contains("tags", "page_sig")
    rows = rows.where(~signal | F.col("_seen").isNull() | page).withColumn("is_new", F.col("_seen").isNull())
    rank = F.row_number().over(Window.partitionBy(source).orderBy(signal.cast("int"), order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= cap).drop("_seen")


def seen_list(old: Column, new: Column, cap: int = SEEN_CAP) -> Column:
    """The new URLs before the old, each once, at most cap: a source's memory is bounded by design."""
    empty = F.array().cast("array<string>")
    return F.slice(F.array_distinct(F.concat(F.coalesce(new, empty), F.coalesce(old, empty))), 1, cap)


def first_success(attempts: DataFrame, key: list[str], order: str, status: str) -> DataFrame:
    """The first attempt that was ok or unchanged, else the last one."""
    good = F.col(status).isin("ok", "not_modified")
    row = F.struct(*attempts.columns)
    best = attempts.groupBy(*key).agg(F.min_by(row, F.when(good, F.col(order))).alias("a"), F.max_by(row, order).alias("z"))
    return best.select(F.coalesce("a", "z").alias("r")).select("r.*")


def endpoint_order(health: DataFrame, top: int, turn: int) -> DataFrame:
    """Endpoints by score and name, the best ``top`` turned by ``turn``."""
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "name")) - 1
    ranked = health.withColumn("rank", rank)
    return ranked.withColumn("place", F.when(F.col("rank") < top, F.pmod(F.col("rank") - turn, F.lit(top))).otherwise(F.col("rank")))


def health_scores(attempts: DataFrame, name: str, ok: Column) -> DataFrame:
    return attempts.groupBy(name).agg(F.sum(F.when(ok, 1).otherwise(-2)).alias("score"))
