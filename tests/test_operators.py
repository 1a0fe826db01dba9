"""Fixtures for what SQL can't say."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lodestream.functions import dates, hashing, text, urls
from lodestream.operators import dedup, diff, graph, pool, select, timeline, validate
from lodestream.sources import feeds, fetch
from lodestream.streaming import pool_stream


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long' if isinstance(v, int) else 'double'}" for k, v in values.items()))
    return row.select(expression.alias("x")).first().x


@pytest.mark.parametrize(("url", "want"), [
    ("HTTPS://WWW.Example.com:443/a/b/?utm_source=x&b=2&a=1#top", "https://example.com/a/b?a=1&b=2"), ("http://m.example.com:8080/", "http://example.com:8080/"), ("example.com/x//", "https://example.com/x"),
    ("  ", ""), (None, ""), ("https://www.m.example.com/?q=a+b&ref=1", "https://m.example.com/?q=a+b"), ("https://user:pw@example.com/p?x", "https://example.com/p?x="),
])
def test_url_canon(spark, url, want):
    assert one(spark, urls.url_canon(F.col("u")), u=url) == want
    if "//m." not in want:  # one prefix goes at a time
        assert one(spark, urls.url_canon(F.col("u")), u=want) == want


def test_history_form_strips_all_prefixes_and_ports(spark):
    assert one(spark, urls.canon_url(F.col("u")), u="http://www.m.amp.example.com:8080/a/") == "http://example.com/a"


def test_idna(spark):
    assert one(spark, urls.url_canon(F.col("u"), idna=True), u="https://bücher.example/") == "https://xn--bcher-kva.example/"


@pytest.mark.parametrize(("date", "want"), [
    ("1700000000", 1700000000), ("1700000000000", 1700000000), ("2024-01-02T03:04:05Z", 1704164645), ("2024-01-02 03:04", 1704135840), ("Tue, 02 Jan 2024 03:04:05 GMT", 1704164645),
    ("Tue, 02 Jan 2024 03:04:05 +0800", 1704135845), ("2024/01/02", 1704124800), ("2024-01-02T03:04garbage", 1704135840), ("nonsense", None), ("", None),
])
def test_parse_date(spark, date, want):
    assert one(spark, F.unix_timestamp(dates.parse_date(F.col("d"))), d=date) == want


def test_text(spark):
    assert one(spark, text.title_norm(F.col("t"), lower=True), t="ＡＢＣ​ “Straße” …") == 'abc "strasse" ...'
    assert one(spark, text.strip_html(F.col("t")), t="&lt;b&gt;x&lt;/b&gt; &eacute; <i>y</i>") == "x é y"
    assert one(spark, text.guess_lang(F.col("t")), t="中文标题测试内容很多字") == "zh"
    assert one(spark, text.slugify(F.col("t"), F.lit("abcdef0123")), t="中文") == "nabcdef01"
    assert one(spark, text.slugify(F.col("t"), F.lit("k")), t="Crème Brûlée 2!") == "creme-brulee-2"
    assert one(spark, text.apply_aliases(F.col("t"), {"OpenAI": ["open ai"], "AI": []}), t="OPEN  AI said ai-x, fail") == "OpenAI said AI-x, fail"
    assert one(spark, text.score01(F.col("t"), 0.5), t="90") == 0.9
    assert one(spark, text.md_to_html(F.col("t")), t="**a** <`b`>") == "<strong>a</strong> &lt;<code>b</code>&gt;"


def test_display_features(spark):
    assert one(spark, F.array_join(hashing.display_features(F.col("t")), "|"), t="Hello, big 中文字 world 好") == "hello|big|中文|文字|world|好|hello big"


def test_hamming_join_equals_brute_force(spark):
    import random

    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = base + [x ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 9))) for x in base for _ in range(4)] + [0] * 20
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame(list(enumerate(signed)), "k long, fp long")
    for most in (4, 8):
        links = graph.components(dedup.hamming_pairs(df, "k", "fp", most).select("a", "b"))
        mine = {r.node: r.component for r in links.collect()}
        parent = list(range(len(fps)))

        def find(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= most:
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
        assert all(mine.get(i, i) == find(i) for i in range(len(fps)))


def test_components_of_a_path_and_nothing(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.component for r in graph.components(path).collect()} == {0}
    assert graph.components(path.where("a < 0")).count() == 0


def _history(spark):
    members = spark.createDataFrame([(1, 1, "h1", 0b1111, [1.0, 0.0]), (2, 2, "h2", -1, [0.0, 1.0])], "item_id long, cluster_id long, url_hash string, simhash long, vector array<double>")
    clusters = spark.createDataFrame([(1, "open", dt.date(2024, 2, 1), [1.0, 0.0]), (2, "expired", dt.date(2024, 1, 1), [0.0, 1.0])], "cluster_id long, state string, expires_at date, centroid array<double>")
    return members, clusters


def test_cascade_outcomes(spark):
    members, clusters = _history(spark)
    far = 0x00FF00FF00FF0000
    rows = [(10, "h2", far, [1.0, 0.0]), (11, "x", 0b0111, [0.0, 1.0]), (12, "y", far, [0.8, 0.6]), (13, "z", far, [0.0, 1.0]), (14, "w", 0b1111 | 0x3F00, [1.0, 0.1])]
    items = spark.createDataFrame(rows, "key long, url_hash string, simhash long, vector array<double>")
    got = {r.key: (r.verdict, r.via, r.cluster_id) for r in dedup.cascade(items, members, clusters, F.lit("2024-01-15").cast("date")).collect()}
    assert got == {10: ("suppressed", "dup_exact", 2), 11: ("suppressed", "dup_near", 1), 12: ("gray", "judge_na", 1), 13: ("fresh", "embed_lo", None), 14: ("suppressed", "dup_same", 1)}
    judged = {r.key: r.via for r in dedup.cascade(items, members, clusters, F.lit("2024-01-15").cast("date"), F.lit("B")).collect()}
    assert judged[12] == "judge_b"
    empty = dedup.cascade(items, members.limit(0), clusters.limit(0), F.lit("2024-01-15").cast("date"))
    assert {r.via for r in empty.collect()} == {"no_history"}


def test_cascade_in_order_sees_earlier_items(spark):
    members, clusters = _history(spark)
    far = 0x00FF00FF00FF0000
    items = spark.createDataFrame([("e", 0, 20, "n", far, [0.0, 1.0]), ("e", 1, 21, "n", 5, [0.5, 0.5]), ("e", 2, 22, "m", far ^ 3, [1.0, 0.0])], "episode string, ord long, key long, url_hash string, simhash long, vector array<double>")
    got = {r.key: (r.verdict, r.via) for r in dedup.cascade_in_order(items, members.where("cluster_id = 1"), clusters.where("state = 'open'")).collect()}
    assert got == {20: ("fresh", "embed_lo"), 21: ("suppressed", "dup_exact"), 22: ("suppressed", "dup_near")}


def test_cluster_upkeep(spark):
    day = F.lit("2024-01-10").cast("date")
    c = spark.createDataFrame([(1, "open", dt.date(2023, 12, 1), dt.date(2023, 12, 5)), (2, "merged", dt.date(2023, 1, 1), dt.date(2023, 1, 2)), (3, "open", dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "cluster_id long, state string, last_seen date, expires_at date")
    assert {r.cluster_id: r.state for r in dedup.expire(c, day).collect()} == {1: "expired", 2: "merged", 3: "open"}
    m = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), "a", "candidate", [3.0, 4.0]), (2, 1, dt.date(2024, 1, 2), "a", "reissue", [3.0, 4.0]), (3, 1, dt.date(2024, 1, 2), "a", "reported", [0.0, 0.0])], "item_id long, cluster_id long, day date, url_hash string, verdict string, vector array<double>")
    r = dedup.recompute_clusters(m).first()
    assert (r.item_count, r.n_reissues, r.published, r.expires_at) == (3, 1, True, dt.date(2024, 1, 23)) and [round(x, 6) for x in r.centroid] == [0.6, 0.8]
    assert sorted(x.cluster_id for x in dedup.split_cluster(m, 1, 9).collect()) == [1, 9, 9]
    assert {x.item_id for x in dedup.one_per_url_and_day(m).collect()} == {1, 2}
    assert {x.cluster_id for x in dedup.merge_clusters(m, 7, 1).collect()} == {7}
    assert dedup.replay(m.select("url_hash", "day").distinct(), m).where("replayed = 'fresh'").count() == 1


def test_upsert_rules(spark):
    schema = "item_key string, title string, content_sha string, date_published string, signal int, first_seen int, filter_verdict string"
    old = spark.createDataFrame([("a", "t", "1", "d0", 1, 1, "keep"), ("b", "t", "1", "d0", 0, 1, "keep"), ("c", "t", "1", None, 0, 1, "drop")], schema)
    batch = spark.createDataFrame([("a", "u", "2", None, 0, 5, None, 1), ("a", "v", "1", "d1", 0, 6, None, 2), ("b", "w", "1", None, 0, 5, None, 3), ("n", "x", "9", None, 1, 5, None, 4)], schema + ", ord int")
    got = {r.item_key: (r.title, r.date_published, r.signal, r.first_seen, r.filter_verdict) for r in pool.upsert(old, batch, F.col("ord")).collect()}
    assert got == {"a": ("v", "d1", 1, 1, None), "b": ("w", "d0", 0, 1, "keep"), "c": ("t", None, 0, 1, "drop"), "n": ("x", None, 1, 5, None)}


def test_projected_and_used(spark):
    p = spark.createDataFrame([("a", "fresh", 1, "e1"), ("b", "reissue", 1, None), ("c", None, 1, None), ("d", None, 2, None)], "item_key string, dedup_verdict string, dedup_cluster_id long, used_in_episode string")
    got = {r.item_key: r.projected for r in pool.projected_dedup(p, pool.published_clusters(p)).collect()}
    assert got == {"a": "suppressed", "b": "reissue", "c": "suppressed", "d": "gray"}
    used = pool.mark_used(p, p.select("item_key"), "e2")
    assert {r.item_key: r.used_in_episode for r in used.collect()} == {"a": "e1", "b": "e2", "c": "e2", "d": "e2"}
    # the cluster that a row is stored under never suppresses it, whatever its verdict; another one does
    own = pool.write_dedup(p, spark.createDataFrame([("a", "suppressed", 1), ("d", "suppressed", 2), ("b", "suppressed", 3), ("c", "gray", 1)], "item_key string, verdict string, cluster_id long"))
    assert {r.item_key: r.dedup_verdict for r in own.collect()} == {"a": "fresh", "b": "suppressed", "c": "gray", "d": None}


def test_decisions(spark):
    items = spark.createDataFrame([("a", "h", "1", "p", "m", "x"), ("b", "i", "1", "p", "m", "x"), ("c", "j", "1", "p", "m", "verdict: keep"), ("d", "k", "1", "p", "m", "x")], "item_key string, url_hash string, content_sha string, prompt string, model string, text string")
    cache = spark.createDataFrame([("b", "1", "p", "m", "keep", ["c"])], "item_key string, content_sha string, prompt string, model string, verdict string, reasons array<string>")
    judged = spark.createDataFrame([("c", "keep", ["r"])], "item_key string, verdict string, reasons array<string>")
    got = {r.item_key: (r.verdict, r.via) for r in select.decide(items, spark.createDataFrame([("h", "t")], "url_hash string, title string"), cache, judged, F.col("text")).collect()}
    assert got == {"a": ("drop", "history"), "b": ("keep", "cache"), "c": ("drop", "judge"), "d": ("review", "missed")}


def test_slugs_and_picks(spark):
    rows = spark.createDataFrame([(1, "a", "kkkkk"), (2, "a", "lllll"), (3, "a", "lllll")], "ord int, slug string, key string")
    assert [r.slug for r in select.unique_slugs(rows, "ord", "slug", "key").orderBy("ord").collect()] == ["a", "a-llll", "a-2"]
    picks = spark.createDataFrame([(1, "x"), (2, "x"), (3, "?"), (4, "y")], "ord int, key string")
    known = spark.createDataFrame([("x",), ("y",)], "key string")
    assert {(r.ord, r.status) for r in select.decision(picks, known, "key", "ord", cap=1).collect()} == {(1, "kept"), (2, "duplicate"), (3, "unknown"), (4, "over_max_items")}


def test_windows_and_frames(spark):
    w = spark.createDataFrame([(1, 0, 100, "short"), (1, 1000, 2000, None), (1, 2100, 3000, "b"), (1, 5000, 9000, "c")], "g int, start_ms long, end_ms long, src string").withColumns({"low": F.lit(0), "high": F.lit(8000)})
    got = {(r.start_ms, r.end_ms, r.src) for r in timeline.merge_windows(w, "g", "low", "high", "src").collect()}
    assert got == {(1000, 3000, "b"), (5000, 8000, "c")}
    frames = spark.createDataFrame([("i", 100, 200, "f1"), ("i", 300, 400, "f2")], "item string, t0 long, t1 long, path string")
    wanted = spark.createDataFrame([("i", 430), ("i", 900), ("j", 1)], "item string, at long")
    assert {(r["item"], r["at"], r["frame"]) for r in timeline.find_frame(wanted, frames, ["item"], "at").collect()} == {("i", 430, "f2"), ("i", 900, "f1"), ("j", 1, None)}
    track = spark.createDataFrame([(1, 0, 500, "a'b")], "g int, show_from long, show_to long, src string")
    assert timeline.ffconcat(track, "g").first()["text"].count("file 'a'\\''b'") == 2


def test_fetch_classes(spark):
    c = lambda status, body: one(spark, fetch.classify(F.lit(status), F.col("b")), b=body)
    assert c(304, "") == "ok" and c(429, "") == "rate_limited" and c(200, "") == "empty" and c(503, "x") == "http_503"
    assert c(429, "Just a moment") == "walled" and c(200, "<?xml version='1.0'?><rss>Just a moment</rss>") == "ok"
    assert c(200, '<html><div id="root"></div></html>') == "shell_only"


def test_feeds(spark):
    atom = '<feed><entry><title>T</title><link href="https://x.example/1" rel="alternate"/><updated>2024-01-02T03:04:05Z</updated><id>i</id><summary>a &lt;b&gt;c&lt;/b&gt;</summary></entry><entry><title>no link</title></entry></feed>'
    rows = feeds.atom_items(spark.createDataFrame([("s", atom)], "s string, b string"), "s", "b").collect()
    assert [(r.title, r.url, r.guid, r.summary) for r in rows] == [("T", "https://x.example/1", "i", "a c")]
    site = "<urlset><url><loc> https://x.example/a </loc><lastmod>2024-01-01</lastmod></url></urlset>"
    assert feeds.sitemap_urls(spark.createDataFrame([("s", site)], "s string, b string"), "s", "b").first().loc == "https://x.example/a"
    body = json.dumps({"data": {"x": [{"name": f"n{i}", "Link": f"/p/{i}", "ctime": 1700000000 + i} for i in range(4)]}})
    assert [r[1] for r in feeds.walk_json(body, "https://x.example/q")] == [f"https://x.example/p/{i}" for i in range(4)]
    hn = json.dumps({"hits": [{"title": "t", "objectID": "7", "points": 3, "created_at": "2024-01-02T03:04:05Z"}]})
    r = feeds.json_items(spark.createDataFrame([("s", hn), ("s", "not json")], "s string, b string"), "s", "b", feeds.ADAPTERS["hn"]).collect()
    assert [(x.url, x.tags) for x in r] == [("https://news.ycombinator.com/item?id=7", ["points:3"])]


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b\u0085c")], "k int, t string")
    feeds.write_jsonl(df, str(tmp_path / "x"))
    assert feeds.read_jsonl(spark, str(tmp_path / "x"), "k int, t string").select("k", "t").collect() == df.collect()


def test_signatures_and_state(spark):
    pages = spark.createDataFrame([(1, "https://x.example/", '<h2>A</h2><a href="/news/1">n</a>'), (2, "https://x.example/", "<div></div>")], "k int, base string, html string")
    sig = {r.k: r.page_sig for r in diff.page_signature(pages, diff.page_links(pages, "k", "base", "html"), "k", "html").collect()}
    assert len(set(sig.values())) == 2
    seen = spark.createDataFrame([("s", "u1")], "source string, url_canon string")
    items = spark.createDataFrame([("s", "u1", ["signal"], 1), ("s", "u1", ["signal", "page_sig"], 2), ("s", "u2", [], 3)], "source string, url_canon string, tags array<string>, ord int")
    assert [r.ord for r in diff.emitted(items, seen, "source", "ord", 5).orderBy("rank").collect()] == [3, 2]


def test_quarantine(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    good, bad = validate.quarantine(rows, ("has text", F.col("t").isNotNull()))
    assert [r.k for r in good.collect()] == [1] and bad.first().errors == ["has text"]


def test_streamed_pool(spark, tmp_path):
    schema = "item_key string, title string, content_sha string, ord int"
    spark.createDataFrame([("a", "t", "1", 1), ("b", "t", "1", 2)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = pool_stream.keep_pool(spark, stream, str(tmp_path / "pool"), str(tmp_path / "ck"), "ord")
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "pool/v=0")).count() == 2
