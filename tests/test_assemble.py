import json

import pytest
from pyspark.sql import functions as F

from lodestream.operators import assemble
from lodestream.sources import sinks


def test_items_and_gate(spark):
    raw = spark.createDataFrame([("a", "old", "x", "u", "d", "s", 1), ("a", "new", "y", "u", "d", "s", 2)], "item_key string, title string, content_text string, url string, date_published string, source_name string, ord int")
    filtered = spark.createDataFrame([("a", 0.5, 0.5, "keep", 1), ("b", 0.1, 0.1, "drop", 1)], "item_key string, news_value double, ai_relevance double, verdict string, ord int")
    items = assemble.load_items(raw, filtered, spark.createDataFrame([("a", "", None), ("b", "t", "s")], "item_key string, title_zh string, summary string"), "ord")
    assert {(r.item_key, r.title_zh, r.summary) for r in items.collect()} == {("a", "new", "y"), ("b", "t", "s")}
    ok = F.struct(F.lit(True).alias("ok"), F.lit("window").alias("reason"))
    got = {r.item_key: (r.place, r.reason, r.recommended) for r in assemble.gate(items, spark.createDataFrame([("a", "fresh")], "item_key string, verdict string"), ok).collect()}
    assert got == {"a": ("kept", "fresh", True), "b": ("skipped", "dropped", False)}


def test_kept_items(spark):
    now = spark.createDataFrame([("a", 1)], "item_key string, v int")
    old = spark.createDataFrame([("a", 9), ("b", 2)], "item_key string, v int")
    pick = spark.createDataFrame([("a", 1), ("b", 2)], "item_key string, rank int")
    assert {(r.item_key, r.v) for r in assemble.kept_items(pick, now, old).collect()} == {("a", 1), ("b", 2)}
    with pytest.raises(Exception, match="missing: c"):
        assemble.kept_items(spark.createDataFrame([("c", 1)], "item_key string, rank int"), now, old).collect()


def test_sources_sentences_links(spark):
    s = spark.createDataFrame([(1, "u", 1, None), (1, "u", 2, True), (1, "v", 3, True)], "g int, url string, ord int, is_primary boolean")
    assert [(r.url, r.is_primary) for r in assemble.primary_sources(s, "g", "url", "ord", "is_primary").orderBy("ord").collect()] == [("u", False), ("v", True)]
    t = spark.range(40).select(F.lit(1).alias("g"), "id", F.lit("long enough").alias("t"))
    assert [r.id for r in assemble.sample_sentences(t, "g", "id", "t").orderBy("id").collect()] == list(range(0, 40, 5))
    links = spark.createDataFrame([("u", "b"), ("u", "a"), ("v", "a")], "url string, id string")
    got = {(r.url, r["class"], r.n, tuple(r.owners)) for r in assemble.link_audit(links, spark.createDataFrame([("u", "ok")], "url string, class string")).collect()}
    assert got == {("u", "ok", 2, ("a", "b")), ("v", "unchecked", 1, ("a",))}
    v = spark.createDataFrame([("k", [1.0, 0.0])], "k string, vector array<double>")
    assert assemble.leak_audit(v, v, "k").count() == 1


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", "kept", 2), ("b", "y", "kept", 1), ("c", "z", "unknown", None)], "item_key string, id string, status string, rank int")
    d = json.loads(sinks.selected_document(rows, "auto").first().document)
    assert [k["id"] for k in d["kept"]] == ["y", "x"] and d["dropped"] == [{"item_key": "c", "reason": "unknown"}]
    items = spark.createDataFrame([("x", 1, "h", "t", "b\nc")], "id string, ord int, headline string, tldr string, body string")
    assert tuple(sinks.import_review(sinks.export_review(items, "ord")).first()) == ("x", "h", "t", "b\nc")
    stats = sinks.items_stats(spark.createDataFrame([("a", "text")], "item_key string, content_text string"))
    assert stats.first().texts == 1
    m = sinks.manifest("r", F.lit("f"), F.lit("t"), stats, spark.createDataFrame([("s", 1)], "name string, n int"))
    assert json.loads(m.first().manifest)["sources"] == [{"name": "s", "n": 1}]
    (tmp_path / "f.bin").write_bytes(b"x")
    assert sinks.file_manifest(spark, str(tmp_path)).first().bytes == 1
