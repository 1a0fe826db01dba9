"""RSS, Atom and sitemap documents, and JSON APIs by declarative field maps, to item rows."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.functions.dates import epoch, parse_date
from lodestream.functions.text import strip_tags

_LINK = "array<struct<_href:string,_rel:string,_type:string,_VALUE:string>>"
_TEXT = "array<struct<_VALUE:string,_term:string>>"
RSS_ITEM = f"struct<title:string,link:{_LINK},description:string,`content:encoded`:string,pubDate:string,`dc:date`:string,guid:struct<_VALUE:string>,category:{_TEXT},`media:thumbnail`:array<struct<_url:string>>,`media:content`:array<struct<_url:string,_medium:string,_type:string>>,enclosure:array<struct<_url:string,_type:string>>,`itunes:image`:struct<_href:string>,image:struct<_href:string,href:string>>"
RSS = f"struct<channel:struct<title:string,item:array<{RSS_ITEM}>>>"
ATOM = f"struct<title:struct<_VALUE:string>,entry:array<struct<title:struct<_VALUE:string>,link:{_LINK},summary:struct<_VALUE:string>,content:struct<_VALUE:string>,published:string,updated:string,id:string,category:{_TEXT},`media:group`:struct<`media:thumbnail`:array<struct<_url:string>>>>>>"
SITEMAP = "struct<url:array<struct<loc:string,lastmod:string>>,sitemap:array<struct<loc:string,lastmod:string>>>"
ITEM_COLUMNS = ("title", "url", "date_published", "summary", "guid", "image", "tags")


def rss_items(docs: DataFrame, source: str, body: str) -> DataFrame:
    """source, title, url, date_published, summary, guid, image, tags of RSS documents; items without a link are left out."""
    parsed = F.from_xml(F.col(body), RSS, {"ignoreNamespace": "false", "mode": "PERMISSIVE"})
    e = docs.select(source, F.explode(parsed["channel"]["item"]).alias("_entry"))
    link = F.trim(F.element_at(F.filter(F.transform("_entry.link", lambda x: F.coalesce(x["_VALUE"], x["_href"])), lambda u: F.trim(u) != ""), 1))
    is_image = lambda x: F.coalesce(x["_medium"], F.lit("")).startswith("image") | F.coalesce(x["_type"], F.lit("")).contains("image")
    image = F.coalesce(
        F.get(F.filter(F.col("_entry.`media:thumbnail`"), lambda x: x["_url"].isNotNull()), 0)["_url"], F.get(F.filter(F.col("_entry.`media:content`"), lambda x: is_image(x) & x["_url"].isNotNull()), 0)["_url"],
        F.col("_entry.`itunes:image`._href"), F.get(F.filter("_entry.enclosure", lambda x: F.coalesce(x["_type"], F.lit("")).contains("image")), 0)["_url"],
        F.coalesce("_entry.image._href", "_entry.image.href"),
    )
    text = F.coalesce(F.nullif(strip_tags(F.col("_entry.`content:encoded`")), F.lit("")), F.nullif(strip_tags(F.col("_entry.description")), F.lit("")))
    tags = F.slice(F.array_compact(F.transform("_entry.category", lambda c: F.nullif(F.trim(c["_VALUE"]), F.lit("")))), 1, 8)
    rows = e.select(source, F.coalesce("_entry.title", F.lit("")).alias("title"), link.alias("url"), F.coalesce(parse_date(F.col("_entry.pubDate")), parse_date(F.col("_entry.`dc:date`"))).alias("date_published"), text.alias("summary"), F.col("_entry.guid._VALUE").alias("guid"), image.alias("image"), F.coalesce(tags, F.array().cast("array<string>")).alias("tags"))
    return rows.where(F.coalesce("url", F.lit("")) != "")


def atom_items(docs: DataFrame, source: str, body: str) -> DataFrame:
    """The same of Atom documents (video feeds too)."""
    e = docs.select(source, F.explode(F.from_xml(F.col(body), ATOM, {"mode": "PERMISSIVE"})["entry"]).alias("_entry"))
    links = F.col("_entry.link")
    plain = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.trim(F.coalesce(F.get(plain, 0)["_href"], F.get(links, 0)["_href"]))
    image = F.coalesce(F.get(F.col("_entry.`media:group`.`media:thumbnail`"), 0)["_url"], F.get(F.filter(links, lambda x: (x["_rel"] == "enclosure") & F.coalesce(x["_type"], F.lit("")).contains("image")), 0)["_href"])
    text = F.coalesce(F.nullif(strip_tags(F.col("_entry.content._VALUE")), F.lit("")), F.nullif(strip_tags(F.col("_entry.summary._VALUE")), F.lit("")))
    tags = F.slice(F.array_compact(F.transform("_entry.category", lambda c: c["_term"])), 1, 8)
    rows = e.select(source, F.coalesce("_entry.title._VALUE", F.lit("")).alias("title"), link.alias("url"), F.coalesce(parse_date(F.col("_entry.published")), parse_date(F.col("_entry.updated"))).alias("date_published"), text.alias("summary"), F.col("_entry.id").alias("guid"), image.alias("image"), F.coalesce(tags, F.array().cast("array<string>")).alias("tags"))
    return rows.where(F.coalesce("url", F.lit("")) != "")


def sitemap_urls(docs: DataFrame, source: str, body: str) -> DataFrame:
    """source, kind (url or sitemap), place, loc, lastmod of sitemaps and sitemap indexes."""
    parsed = docs.select(source, F.from_xml(F.col(body), SITEMAP, {"mode": "PERMISSIVE"}).alias("_map"))
    one = lambda kind: parsed.select(source, F.lit(kind).alias("kind"), F.posexplode(f"_map.{kind}").alias("place", "_u"))
    rows = one("url").union(one("sitemap"))
    return rows.select(source, "kind", "place", F.trim("_u.loc").alias("loc"), F.trim("_u.lastmod").alias("lastmod")).where(F.coalesce("loc", F.lit("")) != "")


@dataclass(frozen=True)
class Adapter:
    """Where a JSON API keeps its rows and fields. Each field lists the places to try in order; a place is a path, or a
    template with {path} parts that is null if a part is missing."""

    rows: tuple[str, ...]
    title: tuple[str, ...]
    url: tuple[str, ...]
    date: tuple[str, ...] = ()
    summary: tuple[str, ...] = ()
    guid: tuple[str, ...] = ()
    image: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    tag_list: str | None = None
    unwrap: tuple[str, ...] = ()
    signal: bool = False
    rewrite: tuple[tuple[str, str], ...] = field(default=())
    blank: tuple[str, ...] = ()


# The field maps of the known APIs.
ADAPTERS = {
    "hn": Adapter(("$.hits",), ("title",), ("url", "https://news.ycombinator.com/item?id={objectID}"), ("created_at",), ("story_text",), ("objectID",), tags=("points:{points}",)),
    "lobsters": Adapter(("$",), ("title",), ("url", "short_id_url", "comments_url"), ("created_at",), ("description",), ("short_id",), tag_list="tags"),
    "github_search": Adapter(("$.items",), ("full_name", "name"), ("html_url",), ("created_at", "pushed_at"), ("description",), ("id",), ("owner.avatar_url",), ("stars:{stargazers_count}",)),
    "bilibili": Adapter(("$.data.archives",), ("title",), ("https://www.bilibili.com/video/{bvid}",), ("pubdate",), ("desc",), ("bvid", "aid"), ("pic",)),
    "huggingface": Adapter(("$",), ("title", "paper.title"), ("https://huggingface.co/papers/{paper.id}", "https://huggingface.co/papers/{id}"), ("publishedAt", "paper.publishedAt"), ("summary", "paper.summary"), ("paper.id", "id"), ("thumbnail",), ("upvotes:{upvotes}", "upvotes:{paper.upvotes}")),
    "jiqizhixin": Adapter(("$.articles",), ("title",), ("https://www.jiqizhixin.com/articles/{slug}",), ("publishedAt",), ("content",), ("id",), ("coverImageUrl",), tag_list="tagList"),
    "sspai": Adapter(("$.data",), ("morning_paper_title", "title"), ("https://sspai.com/post/{id}",), ("released_time", "created_time"), ("summary",), ("id",), ("banner",)),
    "tmtpost": Adapter(("$.data",), ("title",), ("short_url", "share_link"), ("time_published",), ("summary",), ("guid", "post_guid"), ("thumb_image.original[0].url",)),
    "zhihu_col": Adapter(("$.data",), ("title",), ("url",), ("created",), ("excerpt", "content"), ("id",), ("image_url", "title_image"), unwrap=("target",), rewrite=(("/questions/", "https://www.zhihu.com/question/{id}"), ("api.zhihu.com", "https://zhuanlan.zhihu.com/p/{id}"))),
    "qwen": Adapter(("$.data.articles", "$.data.list"), ("title",), ("https://qwen.ai/blog/{path}", "https://qwen.ai/blog/{slug}", "url"), ("extra.date", "date"), ("extra.introduction", "extra.description", "content"), ("id",)),
    "infoq": Adapter(("$.data",), ("article_title", "article_sharetitle"), ("https://www.infoq.cn/article/{uuid}",), ("publish_time", "ctime"), ("article_summary",), ("uuid", "aid"), ("article_cover",)),
    "juejin": Adapter(("$.data",), ("article_info.title",), ("https://juejin.cn/post/{article_info.article_id}", "https://juejin.cn/post/{article_id}"), ("article_info.ctime",), ("article_info.brief_content",), ("article_info.article_id", "article_id"), ("article_info.cover_image",), ("view:{article_info.view_count}", "digg:{article_info.digg_count}")),
    "oschina": Adapter(("$.result", "$.result.items", "$.result.list"), ("title", "obj_title"), ("url", "obj_url", "https://www.oschina.net/news/{obj_id}", "https://www.oschina.net/news/{id}"), ("time", "pub_time", "create_time"), ("summary", "obj_summary"), ("obj_id", "id")),
    "alphaxiv": Adapter(("$.papers", "$.data.papers"), ("title",), ("external_link", "https://www.alphaxiv.org/abs/{canonical_id}", "https://www.alphaxiv.org/abs/{id}"), ("publication_date", "first_publication_date"), ("feed_description", "paper_summary", "abstract"), ("canonical_id", "id"), ("image_url",), tag_list="topics"),
    "zenodo": Adapter(("$.data", "$.hits.hits"), ("titles[0].title", "titles[0]", "title"), ("url", "https://doi.org/{doi}"), ("published", "created", "publication_date"), ("descriptions[0].description", "description"), ("doi", "id"), unwrap=("attributes", "metadata")),
    "openrouter": Adapter(("$.data",), ("name", "id"), ("https://openrouter.ai/{id}",), ("created",), ("description",), ("id",), signal=True),
    "cohere": Adapter(("$.result", "$.data"), ("title",), ("https://cohere.com/blog/{slug}",), ("date",), ("subtitle",), ("slug", "_id")),
    "reddit": Adapter(("$.data.children",), ("title",), ("url_overridden_by_dest", "url", "https://www.reddit.com{permalink}"), ("created_utc",), ("selftext",), ("name", "id"), ("thumbnail",), ("flair:{link_flair_text}", "score:{score}"), unwrap=("data",), blank=("[removed]", "[deleted]")),
    "weibo_hot_band": Adapter(("$.data.band_list",), ("word", "note"), ("https://s.weibo.com/weibo?q={word}",), (), ("category",), ("mid", "word"), tags=("{category}",)),
    "weibo_posts": Adapter(("$.data.list", "$.data.cards"), ("text_raw", "text"), ("https://weibo.com/{user.idstr}/{mblogid}", "https://m.weibo.cn/status/{bid}"), ("created_at",), ("text_raw", "text"), ("mblogid", "bid", "id"), ("original_pic",), unwrap=("mblog",)),
    "x_syndication": Adapter(("$.props.pageProps.timeline.entries",), ("full_text", "text"), ("https://x.com/{user.screen_name}/status/{id_str}",), ("created_at",), ("full_text", "text"), ("id_str",), ("entities.media[0].media_url_https",), unwrap=("content", "tweet")),
    "bloomberglaw": Adapter(("$.data.articles.items",), ("headline",), ("url",), ("postedDate",), ("summary",), ("id",)),
}


def _place(row: Column, place: str) -> Column:
    if "{" not in place:
        return F.nullif(F.try_variant_get(row, f"$.{place}", "string"), F.lit(""))
    parts, rest = [], place
    while "{" in rest:
        before, _, rest = rest.partition("{")
        path, _, rest = rest.partition("}")
        parts += [F.lit(before), F.nullif(F.try_variant_get(row, f"$.{path}", "string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def _first(row: Column, places: tuple[str, ...]) -> Column:
    return F.coalesce(*[_place(row, p) for p in places], F.lit(None).cast("string"))


def json_items(docs: DataFrame, source: str, body: str, adapter: Adapter) -> DataFrame:
    """Item rows of JSON bodies by a field map; rows without a URL are left out, unreadable bodies have none."""
    v = docs.select(source, F.try_parse_json(F.col(body)).alias("_doc"))
    lists = F.coalesce(*[F.try_variant_get("_doc", p, "array<variant>") for p in adapter.rows])
    rows = v.select(source, F.explode(lists).alias("_row"))
    for inner in adapter.unwrap:
        rows = rows.withColumn("_row", F.coalesce(F.try_variant_get("_row", f"$.{inner}", "variant"), F.col("_row")))
    r = F.col("_row")
    url = _first(r, adapter.url)
    for mark, template in adapter.rewrite:
        url = F.when(url.contains(mark), F.coalesce(_place(r, template), url)).otherwise(url)
    date = _first(r, adapter.date)
    when = F.coalesce(F.when(date.rlike(r"^\d+(\.\d+)?$"), epoch(date.try_cast("double"))), parse_date(date))
    image, said = _first(r, adapter.image), _first(r, adapter.summary)
    if adapter.blank:
        said = F.when(~F.coalesce(F.trim(said).isin(*adapter.blank), F.lit(False)), said)
    tags = F.array_compact(F.array(*[_place(r, t) for t in adapter.tags])) if adapter.tags else F.array().cast("array<string>")
    if adapter.tag_list:
        tags = F.slice(F.coalesce(F.try_variant_get(r, f"$.{adapter.tag_list}", "array<string>"), tags), 1, 8)
    if adapter.signal:
        tags = F.array_append(tags, F.lit("signal"))
    shown = rows.select(source, _first(r, adapter.title).alias("title"), url.alias("url"), when.alias("date_published"), strip_tags(said).alias("summary"), F.coalesce(_first(r, adapter.guid), F.lit("")).alias("guid"), F.when(image.startswith("//"), F.concat(F.lit("https:"), image)).otherwise(image).alias("image"), tags.alias("tags"))
    return shown.where(F.coalesce("url", F.lit("")) != "")


# The keys by which the generic walker knows a field, in the order in which they are tried.
TITLE_KEYS = ("title", "name", "headline", "article_title", "morning_paper_title", "post_title")
URL_KEYS = ("url", "link", "share_url", "item_url", "html_url", "article_url", "short_url", "permalink", "web_url", "page_url", "post_url")
ID_KEYS = ("id", "guid", "article_id", "objectid", "aid", "uuid", "eid", "bvid", "slug", "path", "short_id")
DATE_KEYS = ("published", "published_at", "publishedat", "pubdate", "date", "created", "created_at", "createdat", "created_time", "ctime", "utime", "updated", "updated_at", "posteddate", "posted_at", "released_time", "release_time", "first_publication_date", "publication_date", "publish_time", "time_published", "post_time")
SUMMARY_KEYS = ("summary", "description", "desc", "brief_content", "excerpt", "article_summary", "subtitle", "feed_description", "introduction", "content", "abstract", "post_excerpt")
IMAGE_KEYS = ("image", "cover", "coverimageurl", "cover_url", "thumbnail", "thumb", "pic", "image_url", "share_pic", "article_cover", "banner", "post_cover_image")


#: Field and preference of every known key; the lower preference wins where a row has several keys of a field.
_FIELD_OF = {
    key: (field_name, place)
    for field_name, keys in (("title", TITLE_KEYS), ("url", URL_KEYS), ("id", ID_KEYS), ("date", DATE_KEYS), ("summary", SUMMARY_KEYS), ("image", IMAGE_KEYS))
    for place, key in enumerate(keys)
}
# Where the walker looks, and how much it wants to see.
WALK_DEPTH, WALK_CHILDREN, SCORED_ROWS, LEAST_ROWS = 6, 200, 50, 3
#: In which parts of a nested value its text is looked for.
_TEXT_PARTS = ("rendered", "name", "title", "term", "url")


def _fields(row: dict) -> dict[str, object]:
    """The values of a JSON object by field."""
    best: dict[str, tuple[int, object]] = {}
    for key, value in row.items():
        name, place = _FIELD_OF.get(key.lower(), ("", 0))
        if name and (name not in best or place < best[name][0]):
            best[name] = (place, value)
    return {name: value for name, (_, value) in best.items()}


def _plain(value: object) -> str | None:
    """A value as text: a string, the first of a list, or an object's first part with text; else null."""
    match value:
        case str():
            return value or None
        case [first, *_]:
            return _plain(first)
        case dict():
            texts = (value.get(part) for part in _TEXT_PARTS)
            return next((t for t in texts if isinstance(t, str) and t), None)
    return None


def _lists(doc: object) -> Iterator[tuple[tuple[int, ...], list[dict]]]:
    """The objects of every list within reach, by the place of the list in the document: places compare in its order."""
    todo: list[tuple[tuple[int, ...], object]] = [((), doc)]
    while todo:
        place, node = todo.pop()
        within = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
        if isinstance(node, list):
            yield place, [x for x in node if isinstance(x, dict)]
        if len(place) < WALK_DEPTH:
            todo += [((*place, i), child) for i, child in enumerate(within[: WALK_CHILDREN if isinstance(node, list) else None]) if isinstance(child, dict | list)]


def walk_json(body: str | None, base: str) -> list[tuple]:
    """(title, url, date, summary, guid, image) of the list of a document that looks most like items.

    Score: among the first SCORED_ROWS objects of a list, those with a title and an address or id. The highest score
    counts, the earliest list of equal ones, and none of under LEAST_ROWS. Rows without an address are left out.
    """
    try:
        doc = json.loads(body or "")
    except ValueError:
        return []
    best, rows = (LEAST_ROWS, ()), []
    for place, objects in _lists(doc):
        known = [_fields(x) for x in objects]
        score = sum("title" in f and ("url" in f or "id" in f) for f in known[:SCORED_ROWS])
        if len(objects) >= LEAST_ROWS and (score > best[0] or score == best[0] and (not rows or place < best[1])):
            best, rows = (score, place), known
    out = []
    for f in rows:
        url = _plain(f.get("url"))
        if url:
            date = f.get("date")
            full = url if url.startswith("http") else urljoin(base, url)
            out.append((_plain(f.get("title")), full, None if date is None else str(date), _plain(f.get("summary")), str(f.get("id") or ""), _plain(f.get("image"))))
    return out


@F.udtf(returnType=T.StructType([T.StructField(n, T.StringType()) for n in ("title", "url", "date", "summary", "guid", "image")]))
class WalkJson:
    """The generic walker as a table function: SELECT * FROM docs, LATERAL walk_json(body, base)."""

    def eval(self, body: str, base: str):
        yield from walk_json(body, base or "")


def read_jsonl(spark, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines that end with \\n alone; bad rows stop the reading (strict) or go to the column _corrupt."""
    reader = spark.read.option("lineSep", "\n")
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    return reader.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in which no line separator but \\n stands: U+0085, U+2028 and U+2029 are escaped."""
    text = F.to_json(F.struct(*df.columns))
    for char, escape in (("\u0085", "\\u0085"), (" ", "\\u2028"), (" ", "\\u2029")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    df.select(text.alias("value")).write.mode("errorifexists").text(path)
