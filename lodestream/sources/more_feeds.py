"""Sources of an own shape: RDF feeds, sitemap indexes, change logs, route catalogues, document trees, podcasts, microblogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.dates import epoch, parse_date, rfc3339
from lodestream.functions.text import strip_tags, title_norm
from lodestream.functions.urls import url_canon
from lodestream.operators.diff import NEWSISH, page_signature
from lodestream.sources.feeds import sitemap_urls
from lodestream.sources.fetch import looks_like_feed

_RDF = "struct<item:array<struct<title:string,link:string,description:string,`dc:date`:string,_about:string>>>"
# What counts as a sitemap of interest, how many children are read and after how many URLs reading stops.
SITEMAP_INTEREST, CHILD_CAP, URL_STOP = r"(?i)news|post|article|blog|changelog|release|research|engineering|docs|update", 5, 3000
# Caps of the catalogues and trees.
TREE_CAP, TREE_DEPTH, TITLE_CAP, HASHTAGS = 500, 12, 100, 8


def rdf_items(docs: DataFrame, source: str, body: str) -> DataFrame:
    """source, title, url, date_published, summary, guid of RSS 1.0 documents, whose items stand beside the channel."""
    bare = F.regexp_replace(F.col(body), r"rdf:about=", "about=")
    e = docs.select(source, F.explode(F.from_xml(bare, _RDF, {"mode": "PERMISSIVE"})["item"]).alias("_e"))
    return e.select(source, F.coalesce("_e.title", F.lit("")).alias("title"), F.trim("_e.link").alias("url"), parse_date(F.col("_e.`dc:date`")).alias("date_published"), F.nullif(strip_tags(F.col("_e.description")), F.lit("")).alias("summary"), F.col("_e._about").alias("guid")).where(F.coalesce("url", F.lit("")) != "")


def rescued(docs: DataFrame, body: str) -> DataFrame:
    """Responses that should have been feeds and are JSON instead: those go to the generic walker."""
    return docs.where(~looks_like_feed(F.col(body)) & F.try_parse_json(F.col(body)).isNotNull())


def sitemap_walk(indexes: DataFrame, fetched: DataFrame, source: str, body: str, children: int = CHILD_CAP, stop: int = URL_STOP) -> DataFrame:
    """source, place, loc, lastmod of sitemaps, those of an index taken from its children (fetched: loc, body).

    Of an index the children of interest count, or all where there are none; the first ``children`` are read, and no
    further one once more than ``stop`` URLs have come. place runs over a source's URLs.
    """
    found = sitemap_urls(indexes, source, body)
    own = found.where("kind = 'url'").select(source, F.lit(0).alias("child"), "place", "loc", "lastmod")
    kids = found.where("kind = 'sitemap'").withColumn("hot", F.col("loc").rlike(SITEMAP_INTEREST))
    kids = kids.withColumn("any_hot", F.max("hot").over(Window.partitionBy(source))).where(F.col("hot") | ~F.col("any_hot")).withColumn("child", F.row_number().over(Window.partitionBy(source).orderBy("place"))).where(F.col("child") <= children)
    inner = sitemap_urls(kids.select(source, "child", F.col("loc").alias("_at")).join(fetched.select(F.col("loc").alias("_at"), F.col("body").alias("_body")), "_at").withColumn("_key", F.struct(source, "child")), "_key", "_body").where("kind = 'url'")
    urls = inner.select(F.col(f"_key.{source}").alias(source), F.col("_key.child").alias("child"), "place", "loc", "lastmod")
    before = urls.groupBy(source, "child").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(source).orderBy("child").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    urls = urls.join(before.where(F.col("before") <= stop).select(source, "child"), [source, "child"], "left_semi")
    order = Window.partitionBy(source).orderBy("child", "place")
    return own.union(urls).withColumn("place", F.row_number().over(order) - 1).drop("child")


def sitemap_signals(urls: DataFrame, seen: DataFrame, source: str, cap: int) -> DataFrame:
    """source, rank, url, canon, date: a sitemap's URLs that were not seen, article-like paths first, at most cap a source."""
    rows = urls.withColumns({"canon": url_canon(F.col("loc")), "_path": F.regexp_extract("loc", r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)})
    new = rows.join(seen.select(source, "canon").distinct(), [source, "canon"], "left_anti")
    rank = F.row_number().over(Window.partitionBy(source).orderBy((~F.col("_path").rlike(NEWSISH)).cast("int"), "place"))
    return new.withColumn("rank", rank).where(F.col("rank") <= cap).select(source, "rank", F.col("loc").alias("url"), "canon", rfc3339(parse_date(F.col("lastmod"))).alias("date"))


def changelog_signals(pages: DataFrame, links: DataFrame, seen: DataFrame, old: DataFrame, key: str, text: str, cap: int) -> DataFrame:
    """key, url, what (link or page_sig): links of a page that were not seen, at most cap; else one row for the page
    itself if its signature differs from the stored one (old: key, page_sig)."""
    new = links.join(seen.select(key, "canon").distinct(), [key, "canon"], "left_anti")
    new = new.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("place"))).where(F.col("_n") <= cap).select(key, "url", F.lit("link").alias("what"))
    moved = page_signature(pages, links, key, text).join(old.select(key, F.col("page_sig").alias("_old")), key).where("_old <> '' and _old <> page_sig")
    alone = moved.join(new.select(key).distinct(), key, "left_anti").join(pages.select(key, "url"), key)
    return new.union(alone.select(key, "url", F.lit("page_sig")))


def route_signals(docs: DataFrame, source: str, body: str, page: str) -> DataFrame:
    """source, title, url, guid of a route catalogue: {site: {routes: {path: {categories}}}}, or paths on top."""
    route = "struct<categories:array<string>>"
    top = docs.select(source, F.explode(F.from_json(body, "map<string,string>")).alias("site", "value"))
    flat = top.where(F.startswith("site", F.lit("/"))).select(source, F.col("site").alias("path"), F.from_json("value", route).alias("route"))
    nested = top.where(~F.startswith("site", F.lit("/"))).select(source, F.explode(F.from_json("value", f"struct<routes:map<string,{route}>>")["routes"]).alias("path", "route"))
    rows = flat.union(nested.where(F.startswith("path", F.lit("/"))))
    category = F.coalesce(F.get("route.categories", 0), F.lit("other"))
    escaped = F.replace(F.url_encode("path"), F.lit("+"), F.lit("%20"))
    return rows.select(source, F.concat(F.lit("RSSHub route "), "path").alias("title"), F.concat(F.lit(page), category, F.lit("?route="), escaped).alias("url"), F.col("path").alias("guid"))


def tree_signals(docs: DataFrame, source: str, body: str, page: str, cap: int = TREE_CAP, depth: int = TREE_DEPTH) -> DataFrame:
    """source, title, url, guid of a tree of documents (busStructure, subs): its published English leaves, the last changed
    first, at most cap a source; a change makes a new address. The tree is opened level by level."""
    level = docs.select(source, F.explode(F.try_variant_get(F.try_parse_json(F.col(body)), "$.busStructure", "array<variant>")).alias("_n"))
    leaves = None
    for _ in range(depth):
        get = lambda path, kind="string": F.try_variant_get("_n", f"$.{path}", kind)
        own = level.where((get("lang") == "en") & ~F.coalesce(get("is_dir", "boolean"), F.lit(False)) & (F.coalesce(get("path"), F.lit("")) != "") & (get("status", "int") == 1))
        own = own.select(source, get("title").alias("title"), get("path").alias("path"), F.coalesce(get("updated_at"), F.lit("")).alias("updated"), get("_id").alias("id"))
        leaves = own if leaves is None else leaves.union(own)
        level = level.select(source, F.explode(get("subs", "array<variant>")).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(source).orderBy(F.desc("updated"), "path"))
    version = F.coalesce(F.nullif(F.substring("updated", 1, 10), F.lit("")), F.lit("na"))
    rows = leaves.withColumn("_k", rank).where(F.col("_k") <= cap)
    return rows.select(source, F.coalesce(F.nullif("title", F.lit("")), "path").alias("title"), F.concat(F.lit(page), "path", F.lit("?docv="), version).alias("url"), F.concat(F.coalesce("id", "path"), F.lit("@"), version).alias("guid"))


def podcast_items(docs: DataFrame, source: str, body: str, page: str) -> DataFrame:
    """source, title, url, date, summary, guid, image of a podcast's page data; its picture where an episode has none."""
    pod = docs.select(source, F.try_variant_get(F.try_parse_json(F.col(body)), "$.pageProps.podcast", "variant").alias("_p"))
    e = pod.select(source, F.try_variant_get("_p", "$.image.picUrl", "string").alias("_cover"), F.explode(F.try_variant_get("_p", "$.episodes", "array<variant>")).alias("_e"))
    get = lambda path: F.nullif(F.try_variant_get("_e", f"$.{path}", "string"), F.lit(""))
    key = F.coalesce(get("eid"), get("id"))
    rows = e.select(source, get("title").alias("title"), F.concat(F.lit(page), key).alias("url"), parse_date(get("pubDate")).alias("date"), strip_tags(F.coalesce(get("shownotes"), get("description"))).alias("summary"), key.alias("guid"), F.coalesce(get("image.picUrl"), "_cover").alias("image"))
    return rows.where("url is not null")


def microblogs(docs: DataFrame, source: str, body: str, depth: int = 3) -> DataFrame:
    """source, post (variant) of a microblog's cards, card groups and nested cards, each post once, the first."""
    get = lambda path, kind="variant": F.try_variant_get("_n", f"$.{path}", kind)
    level = docs.select(source, F.array(F.lit(0)).alias("_at"), F.try_variant_get(F.try_parse_json(F.col(body)), "$.data", "variant").alias("_n"))
    found = None
    for _ in range(depth):
        mine = level.where(get("mblog").isNotNull()).select(source, F.concat("_at", F.array(F.lit(-2))).alias("_at"), get("mblog").alias("post"))
        grouped = level.select(source, "_at", F.posexplode(get("card_group", "array<variant>")).alias("_i", "_c")).select(source, F.concat("_at", F.array(F.lit(-1), "_i")).alias("_at"), F.try_variant_get("_c", "$.mblog", "variant").alias("post")).where("post is not null")
        both = mine.union(grouped)
        found = both if found is None else found.union(both)
        level = level.select(source, "_at", F.posexplode(get("cards", "array<variant>")).alias("_i", "_c")).select(source, F.concat("_at", F.array(F.col("_i"))).alias("_at"), F.col("_c").alias("_n"))
    key = F.coalesce(F.try_variant_get("post", "$.bid", "string"), F.try_variant_get("post", "$.id", "string"))
    rows = found.withColumn("_k", key).where("_k <> ''")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(source, "_k").orderBy("_at"))).where("_n = 1").select(source, F.col("_k").alias("id"), "post")


def microblog_items(posts: DataFrame, source: str) -> DataFrame:
    """source, id, title, url, text, date, image of posts: a repost's text follows its own."""
    get = lambda path: F.nullif(F.try_variant_get("post", f"$.{path}", "string"), F.lit(""))

    def plain(c: Column) -> Column:
        """The text of a post, its line breaks kept and empty lines left out."""
        lines = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)<br\s*/?>", "\n"), "\n")
        return F.array_join(F.filter(F.transform(lines, lambda x: strip_tags(x, 1 << 20)), lambda x: x != ""), "\n")

    again = plain(get("retweeted_status.text"))
    text = F.when(again != "", F.concat(plain(get("text")), F.lit("\n\n// @"), F.coalesce(get("retweeted_status.user.screen_name"), F.lit("unknown")), F.lit(": "), again)).otherwise(plain(get("text")))
    bid, user = F.coalesce(get("bid"), get("mblogid")), get("user.id")
    url = F.when(bid.isNotNull() & user.isNotNull(), F.concat(F.lit("https://weibo.com/"), user, F.lit("/"), bid)).otherwise(F.concat(F.lit("https://m.weibo.cn/status/"), F.coalesce(bid, get("id"))))
    title = F.substring(title_norm(F.substring_index(plain(get("text")), "\n", 1), unicode=False), 1, 80)
    # a weekday, month, day, time, zone and year
    date = F.try_to_timestamp(F.regexp_replace(get("created_at"), r"^\w+ (\w+) (\d+) ([\d:]+) ([+-]\d+) (\d+)$", "$2 $1 $5 $3 $4"), F.lit("d MMM yyyy HH:mm:ss Z"))
    return posts.select(source, "id", F.coalesce(F.nullif(title, F.lit("")), F.concat(F.lit("微博 "), "id")).alias("title"), url.alias("url"), F.trim(text).alias("text"), date.alias("date"), F.coalesce(get("pics[0].large.url"), get("pics[0].url")).alias("image"))


def short_posts(rows: DataFrame, handle: Column) -> DataFrame:
    """title, content_text, tags, date of short posts (author, id, text, created_at_ms): a title of at most TITLE_CAP
    characters, the first hash tags, and the tag retweet where the author is another."""
    named = title_norm(F.col("text"), unicode=False)
    cut = F.when(F.length(named) > TITLE_CAP, F.concat(F.rtrim(F.substring(named, 1, TITLE_CAP - 1)), F.lit("…"))).otherwise(named)
    who = F.coalesce(F.nullif("author", F.lit("")), handle)
    tags = F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?U)#(\w+)"), 1), 1, HASHTAGS)
    return rows.select(
        "id", F.coalesce(F.nullif(cut, F.lit("")), F.concat(F.lit("@"), who, F.lit(" status "), F.col("id").cast("string"))).alias("title"), F.nullif("text", F.lit("")).alias("content_text"),
        F.when(F.lower(F.coalesce("author", F.lit(""))) != F.lower(handle), F.array_append(tags, F.lit("retweet"))).otherwise(tags).alias("tags"), epoch(F.col("created_at_ms").cast("double")).alias("date"),
    )
