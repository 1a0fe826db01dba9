"""Queries over sources, feeds, APIs and links, and the SQL that must give the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import dates, urls
from lodestream.operators import diff, items
from lodestream.plans.queries import _FORMS
from lodestream.plans.storage import read
from lodestream.sources import feeds, fetch, more_feeds

_s = lambda c: F.col(c).cast("string")
_WHEN, _LOCAL = 1704164645, 1704135845  # 2024-01-02 03:04:05 in UTC, and in the sources' zone
#: An API's response with one row, {id} standing for a document's id, and title, url, date, summary, guid, image, tags of that row.
RESPONSES = {
    "hn": ('{"hits":[{"title":"T{id}","url":null,"objectID":"{id}","created_at":"2024-01-02T03:04:05Z","story_text":"S","points":7}]}', "T{id}", "https://news.ycombinator.com/item?id={id}", _WHEN, "S", "{id}", None, "points:7"),
    "github_search": ('{"items":[{"full_name":"o/{id}","html_url":"https://github.com/{id}","created_at":"2024-01-02T03:04:05Z","description":"D","id":"{id}","owner":{"avatar_url":"a.png"},"stargazers_count":5}]}', "o/{id}", "https://github.com/{id}", _WHEN, "D", "{id}", "a.png", "stars:5"),
    "bilibili": ('{"data":{"archives":[{"title":"T{id}","bvid":"BV{id}","pubdate":1704164645,"desc":"D","pic":"//i.example/p.jpg"}]}}', "T{id}", "https://www.bilibili.com/video/BV{id}", _WHEN, "D", "BV{id}", "https://i.example/p.jpg", ""),
    "huggingface": ('[{"paper":{"id":"{id}","title":"P{id}","summary":"S","publishedAt":"2024-01-02T03:04:05Z","upvotes":3},"thumbnail":"t.png"}]', "P{id}", "https://huggingface.co/papers/{id}", _WHEN, "S", "{id}", "t.png", "upvotes:3"),
    "jiqizhixin": ('{"articles":[{"title":"T{id}","slug":"s-{id}","publishedAt":"2024-01-02 03:04:05","content":"<p>C &amp; D</p>","id":"{id}","coverImageUrl":"c.png","tagList":["a","b"]}]}', "T{id}", "https://www.jiqizhixin.com/articles/s-{id}", _LOCAL, "C & D", "{id}", "c.png", "a,b"),
    "sspai": ('{"data":[{"title":"T{id}","id":"{id}","released_time":1704164645,"summary":"S","banner":"b.png"}]}', "T{id}", "https://sspai.com/post/{id}", _WHEN, "S", "{id}", "b.png", ""),
    "tmtpost": ('{"data":[{"title":"T{id}","short_url":"https://t.example/{id}","time_published":1704164645,"summary":"S","guid":"{id}","thumb_image":{"original":[{"url":"i.png"}]}}]}', "T{id}", "https://t.example/{id}", _WHEN, "S", "{id}", "i.png", ""),
    "zhihu_col": ('{"data":[{"target":{"title":"T{id}","url":"https://api.zhihu.com/articles/{id}","created":1704164645,"excerpt":"E","id":"{id}","image_url":"i.png"}}]}', "T{id}", "https://zhuanlan.zhihu.com/p/{id}", _WHEN, "E", "{id}", "i.png", ""),
    "qwen": ('{"data":{"list":[{"title":"T{id}","path":"p{id}","extra":{"date":"2024-01-02 03:04:05","introduction":"I"},"id":"{id}"}]}}', "T{id}", "https://qwen.ai/blog/p{id}", _LOCAL, "I", "{id}", None, ""),
    "infoq": ('{"data":[{"article_title":"T{id}","uuid":"u{id}","publish_time":1704164645000,"article_summary":"S","article_cover":"c.png"}]}', "T{id}", "https://www.infoq.cn/article/u{id}", _WHEN, "S", "u{id}", "c.png", ""),
    "juejin": ('{"data":[{"article_info":{"title":"T{id}","article_id":"{id}","ctime":"1704164645","brief_content":"B","cover_image":"c.png","view_count":9,"digg_count":2}}]}', "T{id}", "https://juejin.cn/post/{id}", _WHEN, "B", "{id}", "c.png", "view:9,digg:2"),
    "oschina": ('{"result":{"items":[{"obj_title":"T{id}","obj_id":"{id}","pub_time":"2024-01-02 03:04:05","summary":"S"}]}}', "T{id}", "https://www.oschina.net/news/{id}", _LOCAL, "S", "{id}", None, ""),
    "alphaxiv": ('{"data":{"papers":[{"title":"T{id}","canonical_id":"c{id}","publication_date":"2024-01-02T03:04:05Z","abstract":"A","image_url":"i.png","topics":["x","y"]}]}}', "T{id}", "https://www.alphaxiv.org/abs/c{id}", _WHEN, "A", "c{id}", "i.png", "x,y"),
    "zenodo": ('{"hits":{"hits":[{"metadata":{"title":"T{id}","publication_date":"2024-01-02T03:04:05Z","doi":"10.1/{id}"}}]}}', "T{id}", "https://doi.org/10.1/{id}", _WHEN, "", "10.1/{id}", None, ""),
    "openrouter": ('{"data":[{"id":"m/{id}","name":"N{id}","created":1704164645,"description":"D"}]}', "N{id}", "https://openrouter.ai/m/{id}", _WHEN, "D", "m/{id}", None, "signal"),
    "cohere": ('{"data":[{"title":"T{id}","slug":"s{id}","date":"2024-01-02T03:04:05Z","subtitle":"U","_id":"x"}]}', "T{id}", "https://cohere.com/blog/s{id}", _WHEN, "U", "s{id}", None, ""),
    "bloomberglaw": ('{"data":{"articles":{"items":[{"headline":"H{id}","url":"https://b.example/{id}","postedDate":"2024-01-02T03:04:05Z","summary":"S","id":"{id}"}]}}}', "H{id}", "https://b.example/{id}", _WHEN, "S", "{id}", None, ""),
    "reddit": ('{"data":{"children":[{"data":{"title":"T{id}","permalink":"/r/x/{id}","created_utc":1704164645,"selftext":" [removed] ","name":"t3_{id}","link_flair_text":"F","score":3}}]}}', "T{id}", "https://www.reddit.com/r/x/{id}", _WHEN, "", "t3_{id}", None, "flair:F,score:3"),
    "weibo_hot_band": ('{"data":{"band_list":[{"word":"w{id}","category":"c","mid":"m{id}"}]}}', "w{id}", "https://s.weibo.com/weibo?q=w{id}", None, "c", "m{id}", None, "c"),
    "weibo_posts": ('{"data":{"list":[{"text_raw":"T{id}","mblogid":"b{id}","user":{"idstr":"9"},"created_at":"2024-01-02T03:04:05Z","original_pic":"p.png"}]}}', "T{id}", "https://weibo.com/9/b{id}", _WHEN, "T{id}", "b{id}", "p.png", ""),
    "x_syndication": ('{"props":{"pageProps":{"timeline":{"entries":[{"content":{"tweet":{"full_text":"T{id}","id_str":"{id}","user":{"screen_name":"u"},"created_at":"2024-01-02T03:04:05Z"}}}]}}}}', "T{id}", "https://x.com/u/status/{id}", _WHEN, "T{id}", "{id}", None, ""),
}


def _filled(template: str) -> Column:
    return F.replace(F.lit(template), F.lit("{id}"), _s("doc_id"))


def api_items(spark: SparkSession, d: str) -> DataFrame:
    """A response of every known API for each document, through its field map."""
    docs = read(spark, d, "documents").select("doc_id")

    def one(name: str) -> DataFrame:
        got = feeds.json_items(docs.select("doc_id", _filled(RESPONSES[name][0]).alias("body")), "doc_id", "body", feeds.ADAPTERS[name])
        return got.select(F.lit(name).alias("api"), "doc_id", "title", "url", F.unix_timestamp("date_published").alias("published"), "summary", "guid", "image", F.array_join("tags", ",").alias("tags"))

    return reduce(DataFrame.union, map(one, RESPONSES))


_WALKED = '{"meta":{"n":[1,2,3]},"feed":{"pages":[{"rows":[{"Title":"A{id}","link":"/p/{id}","created":1704164645,"Desc":{"name":"D"},"id":"i{id}","pic":[{"url":"i.png"}]},{"name":"B{id}","url":"https://y.example/{id}"},{"headline":"C{id}","uuid":5},{"title":"D{id}","permalink":"q"}]}]},"few":[{"title":"x","url":"u"},{"title":"y","url":"u"}]}'


def walked_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of JSON bodies of unknown shape; feeds and broken bodies go elsewhere."""
    n = F.col("doc_id")
    body = F.when(n % 5 == 0, F.lit("<rss><channel/></rss>")).when(n % 5 == 1, F.lit("{broken")).otherwise(_filled(_WALKED))
    docs = more_feeds.rescued(read(spark, d, "documents").select("doc_id", body.alias("body")), "body")
    found = docs.lateralJoin(feeds.WalkJson(F.col("body").outer(), F.lit("https://x.example/b/")))
    return found.select("doc_id", "title", "url", "date", "summary", "guid", "image")


def feed_forms(spark: SparkSession, d: str) -> DataFrame:
    """Pages as entries of Atom, RDF and RSS documents, with and without pictures."""
    n, link = F.col("page_id"), F.replace("url", F.lit("&"), F.lit("&amp;"))
    page = read(spark, d, "pages").where("url is not null")
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="text">p'), n.cast("string"), F.lit('</title><link rel="self" href="x"/><link rel="alternate" href="'), link, F.lit('"/><summary type="html">S &lt;b&gt;x&lt;/b&gt;</summary><updated>2024-01-02T03:04:05Z</updated><id>i'), n.cast("string"), F.lit('</id><category term="a"/><category term="b"/></entry></feed>'))
    rdf = F.concat(F.lit('<rdf:RDF xmlns:rdf="r" xmlns:dc="d"><channel><title>c</title></channel><item rdf:about="g'), n.cast("string"), F.lit('"><title>p'), n.cast("string"), F.lit("</title><link>"), link, F.lit("</link><description>D</description><dc:date>2024-01-02T03:04:05Z</dc:date></item></rdf:RDF>"))
    image = F.when(n % 3 == 0, F.lit('<media:thumbnail url="t.png"/>')).when(n % 3 == 1, F.lit('<enclosure url="e.png" type="image/png"/>')).otherwise('<itunes:image href="it.png"/><enclosure url="e.png" type="image/png"/>')
    rss = F.concat(F.lit('<rss xmlns:media="m" xmlns:itunes="i"><channel><item><title>p'), n.cast("string"), F.lit("</title><link>"), link, F.lit("</link><description>D &lt;i&gt;x&lt;/i&gt;</description><guid>g</guid>"), image, F.lit("</item><item><title>no link</title></item></channel></rss>"))
    cols = lambda df, form, image: df.select(F.lit(form).alias("form"), "page_id", "title", "url", F.unix_timestamp("date_published").alias("published"), "summary", "guid", image.alias("image"))
    a = cols(feeds.atom_items(page.select("page_id", atom.alias("body")), "page_id", "body"), "atom", F.array_join("tags", ","))
    b = cols(more_feeds.rdf_items(page.select("page_id", rdf.alias("body")), "page_id", "body"), "rdf", F.lit(None).cast("string"))
    return a.union(b).union(cols(feeds.rss_items(page.select("page_id", rss.alias("body")), "page_id", "body"), "rss", F.col("image")))


def sitemaps(spark: SparkSession, d: str) -> DataFrame:
    """Five sitemap indexes, one without children of interest, read through their children; what is new of them, at most 40."""
    r = read(spark, d, "region").select(_s("r_regionkey").alias("source"), F.col("r_regionkey").alias("r"))
    at = F.concat(F.lit("https://x.example/"), F.col("source"), F.when((F.col("r") > 0) & (F.col("k") % 2 == 0), F.lit("/blog-")).otherwise("/map-"), _s("k"), F.lit(".xml"))
    kids = r.join(spark.range(1, 9).withColumnRenamed("id", "k")).withColumn("loc", at)
    index = kids.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "loc"))), lambda x: F.concat(F.lit("<sitemap><loc> "), x["loc"], F.lit("</loc></sitemap>"))), "").alias("b"))
    index = index.select("source", F.concat(F.lit("<sitemapindex>"), "b", F.lit("</sitemapindex>")).alias("body"))
    n = F.col("n_nationkey")
    listed = read(spark, d, "nation").agg(F.array_sort(F.collect_list(F.struct(n.alias("n"), F.when(n % 4 == 0, F.lit("news")).otherwise("a").alias("p")))).alias("l"))
    body = lambda k: F.array_join(F.transform("l", lambda x: F.concat(F.lit("<url><loc>https://x.example/"), x["p"], F.lit("/"), "source", F.lit("-"), k, F.lit("-"), x["n"].cast("string"), F.lit("</loc><lastmod>2024-01-02T03:04:05Z</lastmod></url>"))), "")
    fetched = kids.join(listed).select("loc", F.concat(F.lit("<urlset>"), body(_s("k")), F.lit("</urlset>")).alias("body"))
    found = more_feeds.sitemap_walk(index, fetched, "source", "body")
    seen = found.where("place % 3 = 0").select("source", urls.url_canon(F.col("loc")).alias("canon"))
    new = more_feeds.sitemap_signals(found, seen, "source", 40)
    return found.select("source", F.col("place").cast("long").alias("place"), "loc", F.lit(None).cast("string").alias("date")).union(new.select("source", -F.col("rank").cast("long"), "url", "date"))


def changelogs(spark: SparkSession, d: str) -> DataFrame:
    """New links of pages of which every second was seen whole; where there is none, a changed signature."""
    pages = read(spark, d, "pages").withColumn("html", F.replace("html", F.lit('href="/'), F.lit('href="/news/')))
    links = diff.page_links(pages, "page_id", "url", "html")
    old = pages.select("page_id", F.when(F.col("page_id") % 3 == 0, F.lit("old")).otherwise("").alias("page_sig"))
    return more_feeds.changelog_signals(pages, links, links.where("page_id % 2 = 0"), old, "page_id", "html", 3)


def page_signatures(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages").withColumn("html", F.concat(F.lit("<h2>Head <b>one</b></h2>"), F.replace("html", F.lit('href="/'), F.lit('href="/news/'))))
    return diff.page_signature(pages, diff.page_links(pages, "page_id", "url", "html"), "page_id", "html")


def markdown_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of pages' addresses written as markdown."""
    origin = F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]*)", 1)
    md = F.concat(F.lit("see [one](/news/a) and [two]("), origin, F.lit("/blog/b/), [three](https://else.example/news/c), [four](mailto:x) [five](/login/x) [six](/news/a/)"))
    pages = read(spark, d, "pages").select("page_id", "url", md.alias("text"))
    return diff.page_links(pages, "page_id", "url", "text", markdown=True).select("page_id", F.col("place").cast("long").alias("place"), "url", "canon")


def catalogues(spark: SparkSession, d: str) -> DataFrame:
    """Routes, document trees, podcasts and microblogs of each document's id."""
    docs = read(spark, d, "documents").select("doc_id")
    of = lambda template: docs.select("doc_id", _filled(template).alias("body"))
    routes = more_feeds.route_signals(of('{"site{id}":{"routes":{"/a/:x/{id}":{"categories":["blog"]},"b":{}}},"/top/{id}":{"categories":[]}}'), "doc_id", "body", "https://docs.rsshub.app/routes/")
    tree = more_feeds.tree_signals(of('{"busStructure":[{"lang":"en","is_dir":true,"path":"d","status":1,"subs":[{"lang":"en","path":"p{id}","status":1,"title":"T{id}","updated_at":"2024-01-02T00:00","_id":"x{id}"},{"lang":"zh","path":"z","status":1}]},{"lang":"en","path":"q{id}","status":1}]}'), "doc_id", "body", "https://docs.trae.ai/ide/")
    pod = more_feeds.podcast_items(of('{"pageProps":{"podcast":{"image":{"picUrl":"c.png"},"episodes":[{"eid":"e{id}","title":"T{id}","pubDate":"2024-01-02T03:04:05Z","shownotes":"<p>N</p>"},{"title":"no id"}]}}}'), "doc_id", "body", "https://www.xiaoyuzhoufm.com/episode/")
    blog = more_feeds.microblog_items(more_feeds.microblogs(of('{"data":{"cards":[{"mblog":{"bid":"b{id}","text":"Hi {id}<br/>there","user":{"id":9},"created_at":"Tue Aug 25 11:59:06 +0800 2026","retweeted_status":{"text":"<a>old</a>","user":{"screen_name":"w"}}}},{"card_group":[{"mblog":{"id":"{id}7","text":"solo"}},{"mblog":{"bid":"b{id}","text":"again"}}]}]}}'), "doc_id", "body"), "doc_id")
    row = lambda df, kind, guid, more: df.select(F.lit(kind).alias("kind"), "doc_id", "title", "url", guid.alias("guid"), more.alias("more"))
    a = row(routes, "route", F.col("guid"), F.lit("")).union(row(tree, "tree", F.col("guid"), F.lit("")))
    a = a.union(row(pod, "podcast", F.col("guid"), F.concat_ws("|", "summary", "image", F.unix_timestamp("date").cast("string"))))
    return a.union(row(blog, "microblog", F.col("id"), F.concat_ws("|", F.replace("text", F.lit("\n"), F.lit("/")), F.unix_timestamp("date").cast("string"))))


def short_posts(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    rows = read(spark, d, "documents").select(n.alias("id"), F.when(n % 2 == 0, F.lit("Me")).when(n % 3 == 0, F.lit("you")).alias("author"), F.when(n % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("#one "), F.col("text"), F.lit(" #two"))).alias("text"), (F.lit(1704164645123) + n * 1000).alias("created_at_ms"))
    got = more_feeds.short_posts(rows, F.lit("me"))
    return got.select("id", "title", F.length("content_text").cast("long").alias("chars"), F.array_join("tags", ",").alias("tags"), F.unix_timestamp("date").alias("date"))


def source_states(spark: SparkSession, d: str) -> DataFrame:
    """A registry with defaults against its fetches, the addresses with dates filled in, and routes as tags."""
    methods, bodies = ("rss", "json", "odd", "manual"), ("<rss/>", "", "Just a moment...", '<div id="root"></div>')
    entries = [{"name": f"s{i}", "feed_url": f"https://h.example/{{T-{i}d}}/{{T}}?a={{T+1d_ts}}", "method": methods[i % 4], "enabled": i % 5 != 0, "proxy": "require" if i % 7 == 0 else "prefer"} for i in range(40)] + [{"feed_url": "nameless"}]
    table = fetch.sources_table(spark, entries)
    fetches = read(spark, d, "nation").select(F.concat(F.lit("s"), _s("n_nationkey")).alias("name"), F.when(F.col("n_nationkey") % 6 == 0, 304).when(F.col("n_nationkey") % 6 == 1, 429).otherwise(200).alias("http_status"), F.element_at(F.array(*map(F.lit, bodies)), (F.col("n_nationkey") % 4 + 1).cast("int")).alias("body"))
    got = fetch.collection_status(table, fetches, ("rss", "json", "manual"), False)
    rendered = dates.render_dates(F.col("feed_url"), F.lit("2024-01-19 22:30:00").cast("timestamp"))
    number = F.regexp_extract("name", r"(\d+)", 1).cast("int")
    kind = fetch.fallback_kind(F.when(number % 3 == 0, F.lit("reddit")).when(number % 3 == 1, F.lit("weibo")).otherwise("rss"), F.when(number % 2 == 0, F.lit("https://r.example/x.rss?y")).otherwise("https://m.weibo.cn/z"))
    tags = F.array_join(fetch.stamp_via(F.when(F.col("enabled"), F.array(F.lit("a"), F.lit("via:m"))), "m"), ",")
    return got.select("name", "status", "tier", "max_items_per_source", rendered.alias("url"), kind.alias("fallback"), tags.alias("tags"))


def emitted_items(spark: SparkSession, d: str) -> DataFrame:
    """What sources emit of their items: ordinary ones, then new signals, at most 40, and how many are new or fresh."""
    n = F.col("doc_id")
    rows = read(spark, d, "documents").select(n, F.col("source").alias("source"), F.concat(F.lit("u"), (n % 700).cast("string")).alias("url_canon"), F.when(n % 3 == 0, F.array(F.lit("signal"))).when(n % 31 == 1, F.array(F.lit("signal"), F.lit("page_sig"))).otherwise(F.array().cast("array<string>")).alias("tags"), (n % 2 == 0).alias("in_window"))
    seen = rows.where("doc_id % 5 = 0").select("source", "url_canon")
    out = diff.emitted(rows, seen, "source", "doc_id", 40)
    fresh = ~F.array_contains("tags", "signal") & F.col("in_window")
    return out.groupBy("source").agg(F.count("*").alias("items"), F.count_if("is_new").alias("items_new"), F.count_if(fresh).alias("items_fresh"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


_HOSTS = [(("github.", "gitlab."), "repo"), (("arxiv.org",), "paper"), (("example.com", "example.net"), "official")]


def link_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of pages by their host, what a link post leads to, and the policy for its address."""
    p, n = read(spark, d, "pages").select("page_id", "url"), F.col("page_id")
    rules = spark.sql("SELECT * FROM VALUES (1, 'example.net', 'card'), (2, 'net', 'skip'), (3, 'org', 'placeholder') AS t(place, domain, action)")
    got = items.policy_action(p, "url", rules, "screenshot")
    kind = items.source_kind(F.col("url"), F.when(n % 5 == 0, F.lit("manual")).when(n % 5 == 1, F.lit("rss")).otherwise("scrape"), _HOSTS)
    return got.select("page_id", kind.alias("kind"), items.outbound(n % 7 == 0, F.col("url"), ("example.com", "redd.it", "example.org"), "example.org").alias("outbound"), "action", "rule")


def items_filled(spark: SparkSession, d: str) -> DataFrame:
    """Items with what their pages gave, within a budget, and one put in by hand."""
    n = F.col("doc_id")
    rows = read(spark, d, "documents").select(
        n, F.concat(F.lit("https://x.example/a/p-"), n.cast("string")).alias("url"), F.when(n % 4 == 0, F.concat(F.lit("p "), n.cast("string"))).otherwise("given").alias("title"), F.substring("text", 1, 150).alias("summary"), F.when(n % 3 == 0, F.lit("2024-01-01")).alias("date"),
        F.when(n % 10 == 0, F.array(F.lit("signal"))).alias("tags"), F.lit("2024-01-02").alias("date_fetched"), F.lit("en").alias("language"),
    )
    built = items.raw_items(rows, unicode=False).withColumn("n", F.regexp_extract("url", r"(\d+)$", 1).cast("long"))
    pages = read(spark, d, "documents").where("doc_id % 2 = 0").select(
        F.concat(F.lit("https://x.example/a/p-"), n.cast("string")).alias("url"), (n % 6 != 0).alias("ok"), F.when(n % 8 == 0, F.lit("short")).otherwise(F.repeat(F.lit("long "), 150)).alias("text"), F.lit("Page  title").alias("title"), F.when(n % 14 == 0, F.lit("2030-01-01T00:00:00Z")).otherwise("2024-01-03T00:00:00Z").alias("date"),
        F.lit("i.png").alias("image"), F.lit("de").alias("language"), F.lit("raw/1").alias("raw_ref"),
    )
    out = items.backfill(built, pages, F.lit("2024-01-04 00:00:00").cast("timestamp"), 600, "n")
    manual = out.where("n = 7").withColumn("title", F.lit("by hand"))
    both = items.insert_manually(out, manual)
    return both.select("n", "title", F.length("content_text").cast("long").alias("chars"), "date_published", "image", "language", F.col("_fetch.reachable").alias("reachable"), "_raw_ref")


QUERIES = {f.__name__: f for f in (api_items, walked_items, feed_forms, sitemaps, changelogs, page_signatures, markdown_links, catalogues, short_posts, source_states, emitted_items, link_kinds, items_filled)}


def _expected() -> str:
    quoted = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x + "'"
    return ", ".join(f"('{name}', " + ", ".join(map(quoted, row[1:])) + ")" for name, row in RESPONSES.items())


_LINKS = r""", l AS (SELECT page_id, host, unnest(hs) AS href, generate_subscripts(hs, 1) - 1 AS place, scheme, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) AS origin
    FROM (SELECT *, regexp_extract_all(replace(html, 'href="/', 'href="/news/'), '(?i)<a\b[^>]*?href=["'']([^"''#]+)', 1) AS hs FROM f JOIN (SELECT page_id, html FROM pages) USING (page_id))),
    n AS (SELECT page_id, place, origin || trim(replace(href, '&amp;', '&')) AS url, scheme || '://' || regexp_replace(host, '^(www\.|m\.|amp\.)', '') || regexp_replace(trim(replace(href, '&amp;', '&')), '/+$', '') AS canon FROM l WHERE starts_with(href, '/')
        AND NOT regexp_matches(href, 'login|signin|signup|subscribe|search|/tag|category|author|about|contact|privacy|terms|legal|rss|atom|feed|cdn|static|assets|_next|wp-json|wp-admin|account|settings|share|comment', 'i')),
    d AS (SELECT *, row_number() OVER (PARTITION BY page_id, canon ORDER BY place) AS k FROM n), u AS (SELECT * FROM d WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY place) <= 120)
"""
_X = "'{id}', doc_id::VARCHAR)"

ORACLES = {
    "api_items": f"""SELECT api, doc_id, replace(title, {_X} AS title, replace(url, {_X} AS url, published::BIGINT AS published, replace(summary, {_X} AS summary, replace(guid, {_X} AS guid, image, tags
        FROM documents, (VALUES {_expected()}) AS t(api, title, url, published, summary, guid, image, tags)""",
    "walked_items": """SELECT doc_id, column0 || doc_id AS title, replace(column1, '{id}', doc_id::VARCHAR) AS url, column2 AS date, column3 AS summary, replace(column4, '{id}', doc_id::VARCHAR) AS guid, column5 AS image
        FROM documents, (VALUES ('A', 'https://x.example/p/{id}', '1704164645', 'D', 'i{id}', 'i.png'), ('B', 'https://y.example/{id}', NULL, NULL, '', NULL), ('D', 'https://x.example/b/q', NULL, NULL, '', NULL)) AS t(column0, column1, column2, column3, column4, column5) WHERE doc_id % 5 > 1""",
    "feed_forms": """SELECT 'atom' AS form, page_id, 'p' || page_id AS title, url, 1704164645 AS published, 'S x' AS summary, 'i' || page_id AS guid, 'a,b' AS image FROM pages WHERE url IS NOT NULL
        UNION ALL SELECT 'rdf', page_id, 'p' || page_id, url, 1704164645, 'D', 'g' || page_id, NULL FROM pages WHERE url IS NOT NULL
        UNION ALL SELECT 'rss', page_id, 'p' || page_id, url, NULL, 'D x', 'g', CASE page_id % 3 WHEN 0 THEN 't.png' WHEN 1 THEN 'e.png' ELSE 'it.png' END FROM pages WHERE url IS NOT NULL""",
    "sitemaps": """WITH c AS (SELECT r_regionkey AS r, k, row_number() OVER (PARTITION BY r_regionkey ORDER BY k) AS c FROM region, range(1, 9) AS t(k) WHERE r_regionkey = 0 OR k % 2 = 0),
        u AS (SELECT r::VARCHAR AS source, 'https://x.example/' || CASE WHEN n_nationkey % 4 = 0 THEN 'news' ELSE 'a' END || '/' || r || '-' || k || '-' || n_nationkey AS loc, row_number() OVER (PARTITION BY r ORDER BY c, n_nationkey) - 1 AS place FROM c, nation WHERE c <= 5),
        n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY NOT contains(loc, '/news/'), place) AS rank FROM u WHERE place % 3 <> 0)
        SELECT source, place, loc, NULL::VARCHAR AS date FROM u UNION ALL SELECT source, -rank, loc, '2024-01-02T03:04:05+00:00' FROM n WHERE rank <= 40""",
    "changelogs": _FORMS + _LINKS + """, x AS (SELECT page_id, url, 'link' AS what FROM u WHERE page_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY place) <= 3)
        SELECT * FROM x UNION ALL SELECT page_id, url, 'page_sig' FROM pages WHERE page_id % 3 = 0 AND page_id NOT IN (SELECT page_id FROM x)""",
    "page_signatures": _FORMS + _LINKS + r""", hh AS (SELECT page_id, list_aggregate((regexp_extract_all('<h2>Head <b>one</b></h2>' || html, '(?s)<h[23][^>]*>(.*?)</h[23]>', 1))[1:80], 'string_agg', ' ') AS h FROM pages),
        cc AS (SELECT page_id, string_agg(canon, ',' ORDER BY place) AS c FROM (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY place) <= 80) GROUP BY 1)
        SELECT page_id, substr(sha256(substr(trim(regexp_replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 4000) || '|' || coalesce(c, '')), 1, 16) AS page_sig FROM hh LEFT JOIN cc USING (page_id)""",
    "markdown_links": _FORMS + r"""SELECT page_id, column0 AS place, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || column1 AS url, scheme || '://' || regexp_replace(host, '^(www\.|m\.|amp\.)', '') || column2 AS canon FROM f, (VALUES (0, '/news/a', '/news/a'), (1, '/blog/b/', '/blog/b')) AS t(column0, column1, column2) WHERE scheme IN ('http', 'https')""",
    "catalogues": """WITH t AS (SELECT doc_id AS n FROM documents)
        SELECT 'route' AS kind, n AS doc_id, 'RSSHub route /a/:x/' || n AS title, 'https://docs.rsshub.app/routes/blog?route=%2Fa%2F%3Ax%2F' || n AS url, '/a/:x/' || n AS guid, '' AS more FROM t
        UNION ALL SELECT 'route', n, 'RSSHub route /top/' || n, 'https://docs.rsshub.app/routes/other?route=%2Ftop%2F' || n, '/top/' || n, '' FROM t
        UNION ALL SELECT 'tree', n, 'T' || n, 'https://docs.trae.ai/ide/p' || n || '?docv=2024-01-02', 'x' || n || '@2024-01-02', '' FROM t UNION ALL SELECT 'tree', n, 'q' || n, 'https://docs.trae.ai/ide/q' || n || '?docv=na', 'q' || n || '@na', '' FROM t
        UNION ALL SELECT 'podcast', n, 'T' || n, 'https://www.xiaoyuzhoufm.com/episode/e' || n, 'e' || n, 'N|c.png|1704164645' FROM t
        UNION ALL SELECT 'microblog', n, 'Hi ' || n, 'https://weibo.com/9/b' || n, 'b' || n, 'Hi ' || n || '/there//// @w: old|' || epoch(TIMESTAMP '2026-08-25 03:59:06')::BIGINT FROM t UNION ALL SELECT 'microblog', n, 'solo', 'https://m.weibo.cn/status/' || n || '7', n || '7', 'solo' FROM t""",
    "short_posts": r"""WITH x AS (SELECT doc_id AS n, CASE WHEN doc_id % 2 = 0 THEN 'Me' WHEN doc_id % 3 = 0 THEN 'you' END AS a, CASE WHEN doc_id % 5 = 0 THEN '' ELSE '#one ' || text || ' #two' END AS t FROM documents), y AS (SELECT *, trim(regexp_replace(coalesce(t, ''), '\s+', ' ', 'g')) AS w FROM x)
        SELECT n AS id, CASE WHEN length(w) > 100 THEN rtrim(substr(w, 1, 99)) || '…' WHEN w <> '' THEN w ELSE '@' || coalesce(a, 'me') || ' status ' || n END AS title, length(nullif(t, '')) AS chars,
            array_to_string(list_concat(coalesce(regexp_extract_all(t, '#(\w+)', 1), [])[1:8], CASE WHEN coalesce(lower(a), '') <> 'me' THEN ['retweet'] ELSE [] END), ',') AS tags, 1704164645 + n AS date FROM y""",
    "source_states": """WITH s AS (SELECT i, 's' || i AS name, ['rss', 'json', 'odd', 'manual'][i % 4 + 1] AS m FROM range(40) AS t(i)), f AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 6 = 0 THEN 304 WHEN n_nationkey % 6 = 1 THEN 429 ELSE 200 END AS c, ['ok', 'empty', 'walled', 'shell_only'][n_nationkey % 4 + 1] AS b FROM nation)
        SELECT name, CASE WHEN m = 'odd' THEN 'unknown_method' WHEN i % 5 = 0 THEN 'disabled' WHEN i % 7 = 0 THEN 'proxy_down' WHEN m = 'manual' THEN 'manual_entry' WHEN c IS NULL THEN 'collector_not_ready' WHEN c = 304 THEN 'not_modified' WHEN b = 'walled' THEN 'walled' WHEN c = 429 THEN 'rate_limited' ELSE b END AS status,
            'A' AS tier, 40 AS max_items_per_source, 'https://h.example/' || (DATE '2024-01-20' - i::INT) || '/2024-01-20?a=' || (epoch(TIMESTAMP '2024-01-19 22:30:00')::BIGINT + 86400) AS url, CASE WHEN i % 3 = 0 AND i % 2 = 0 THEN 'rss_fallback' WHEN i % 3 = 1 AND i % 2 = 1 THEN 'json_fallback' END AS fallback, CASE WHEN i % 5 <> 0 THEN 'a,via:m' ELSE 'via:m' END AS tags FROM s LEFT JOIN f ON k = i""",
    "emitted_items": """WITH r AS (SELECT doc_id, source, 'u' || doc_id % 700 AS u, doc_id % 3 = 0 OR doc_id % 31 = 1 AS sig, doc_id % 31 = 1 AND doc_id % 3 <> 0 AS page, doc_id % 2 = 0 AS w FROM documents), s AS (SELECT DISTINCT source, u FROM r WHERE doc_id % 5 = 0),
        e AS (SELECT r.*, s.u IS NULL AS new FROM r LEFT JOIN s ON s.source = r.source AND s.u = r.u WHERE NOT sig OR s.u IS NULL OR page QUALIFY row_number() OVER (PARTITION BY r.source ORDER BY sig, doc_id) <= 40)
        SELECT source, count(*) AS items, count_if(new) AS items_new, count_if(NOT sig AND w) AS items_fresh, min(doc_id) AS first, max(doc_id) AS last FROM e GROUP BY 1""",
    "link_kinds": r"""WITH x AS (SELECT page_id, url, lower(split_part(regexp_replace(coalesce(url, ''), '^https?://', ''), '/', 1)) AS h, split_part(regexp_replace(coalesce(url, ''), '^https?://(www\.|old\.|np\.)?', ''), '/', 1) AS o, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z]+://([^/?#:]*)', 1)) AS p FROM pages),
        y AS (SELECT *, list_contains(['example.com', 'redd.it', 'example.org'], o) OR ends_with(o, '.example.com') OR ends_with(o, '.redd.it') OR ends_with(o, '.example.org') AS own, CASE WHEN p = 'example.net' OR ends_with(p, '.example.net') THEN 'example.net' WHEN p = 'net' OR ends_with(p, '.net') THEN 'net' WHEN p = 'org' OR ends_with(p, '.org') THEN 'org' END AS r FROM x)
        SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'other' WHEN contains(h, 'github.') OR contains(h, 'gitlab.') THEN 'repo' WHEN contains(h, 'arxiv.org') THEN 'paper' WHEN contains(h, 'example.com') OR contains(h, 'example.net') THEN 'official' WHEN page_id % 5 = 1 THEN 'media' ELSE 'other' END AS kind,
            CASE WHEN page_id % 7 = 0 THEN '' WHEN o <> '' AND NOT own THEN url WHEN ends_with(o, 'example.org') THEN url ELSE '' END AS outbound, CASE r WHEN 'example.net' THEN 'card' WHEN 'net' THEN 'skip' WHEN 'org' THEN 'placeholder' ELSE 'screenshot' END AS action, coalesce('rule:' || r, 'default') AS rule FROM y""",
    "items_filled": """WITH x AS (SELECT doc_id AS n, CASE WHEN doc_id % 4 = 0 THEN 'p ' || doc_id ELSE 'given' END AS t, nullif(substr(text, 1, 150), '') AS s, doc_id % 10 = 0 AS sig, CASE WHEN doc_id % 3 = 0 THEN '2024-01-01' END AS dt FROM documents),
        b AS (SELECT *, n IN (SELECT n FROM x ORDER BY n LIMIT 600) AND n % 2 = 0 AS had FROM x), g AS (SELECT *, had AND n % 6 <> 0 AS good, CASE WHEN n % 8 = 0 THEN 'short' ELSE trim(repeat('long ', 150)) END AS p FROM b)
        SELECT n, CASE WHEN n = 7 THEN 'by hand' WHEN good AND (sig OR n % 4 = 0) THEN 'Page title' ELSE t END AS title, CASE WHEN good AND length(p) > length(coalesce(s, '')) THEN length(p) ELSE length(s) END AS chars,
            CASE WHEN dt IS NULL AND good AND length(p) >= 500 AND n % 14 <> 0 THEN '2024-01-03T00:00:00+00:00' ELSE dt END AS date_published, CASE WHEN good THEN 'i.png' END AS image, 'en' AS language, NOT (had AND n % 6 = 0) AS reachable, CASE WHEN good THEN 'raw/1' END AS _raw_ref FROM g""",
}
