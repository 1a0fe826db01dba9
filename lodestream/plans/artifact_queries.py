"""Queries over artifacts, titles, dates, names, spoken text and external hooks, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import dates, hashing, speech, text
from lodestream.operators import dedup, diff, judges, pool, timeline
from lodestream.plans.queries import _DISPLAY_ALL, _DOCS, _TIMELINE
from lodestream.plans.queries import ORACLES as _CORE
from lodestream.plans.storage import materialize, read, shared_dir
from lodestream.sources import feeds, sinks

_s = lambda c: F.col(c).cast("string")


def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Documents with line separators of every kind written as JSON lines and read again, with broken lines among them."""
    path, n = shared_dir(spark), F.col("doc_id")
    rows = read(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.when(n % 2 == 0, F.lit(" x\u0085y\u2028z")).otherwise("")).alias("text"))
    feeds.write_jsonl(rows, f"{path}/rows")
    spark.sql("SELECT * FROM VALUES ('{broken'), ('[1]') AS t(value)").write.mode("append").text(f"{path}/rows")
    got = feeds.read_jsonl(spark, f"{path}/rows", "doc_id long, text string")
    good = got.where("_corrupt is null").select("doc_id", F.sha1("text").alias("sha"), F.length("text").cast("long").alias("chars"))
    return good.union(materialize(got).where("_corrupt is not null").select(F.lit(None).cast("long"), "_corrupt", F.lit(None).cast("long")))


def run_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """A run's statistics, read back out of its manifest, and the selected document of a decision."""
    rows = read(spark, d, "documents").select(_s("doc_id").alias("id"), text.bounded_text(F.col("text"), 1000).alias("content_text"))
    stats = sinks.items_stats(rows)
    per_source = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("items")).select(F.coalesce("source", F.lit("?")).alias("name"), "items")
    envelope = sinks.manifest("2024-01-20", F.lit("a"), F.lit("b"), stats, per_source)
    got = envelope.select(F.get_json_object("manifest", "$.stats.n").alias("a"), F.get_json_object("manifest", "$.stats.cut").alias("b"), F.concat_ws("|", F.get_json_object("manifest", "$.schema"), F.get_json_object("manifest", "$.run"), F.get_json_object("manifest", "$.stats.longest_text"), F.get_json_object("manifest", "$.sources[0].items")).alias("c"))
    picks = read(spark, d, "nation").select(F.when(F.col("n_nationkey") % 3 == 0, "kept").otherwise("unpicked").alias("status"), (100 - F.col("n_nationkey")).alias("rank"), F.col("n_name").alias("item_key"), _s("n_nationkey").alias("id"))
    chosen = sinks.selected_document(picks, "human").select(F.get_json_object("document", "$.kept[0].item_key"), F.get_json_object("document", "$.dropped[1].reason"), F.concat_ws("|", F.get_json_object("document", "$.decided_by"), F.get_json_object("document", "$.kept[2].id"), F.get_json_object("document", "$.dropped[0].item_key")))
    return got.union(chosen)


def review_round(spark: SparkSession, d: str) -> DataFrame:
    """Items exported for review, some of them edited, and read again."""
    n = F.col("doc_id")
    rows = read(spark, d, "documents").select(n, F.concat(F.lit("i-"), _s("doc_id")).alias("id"), F.concat(F.lit("Head "), _s("doc_id")).alias("headline"), F.col("source").alias("tldr"), F.trim(F.regexp_replace(F.substring("text", 1, 300), r"\s+", " ")).alias("body"))
    blocks = sinks.export_review(rows, "doc_id").withColumn("markdown", F.when(n % 3 == 0, F.replace("markdown", F.lit("Head"), F.lit("Edited"))).otherwise(F.col("markdown")))
    return sinks.import_review(blocks)


def file_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Size and hash of written files."""
    path = shared_dir(spark)
    names = read(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("value"))
    for i in range(3):
        names.where(F.col("n_nationkey") % 3 == i).orderBy("n_nationkey").select("value").coalesce(1).write.text(f"{path}/f{i}")
    return sinks.file_manifest(spark, path, "*.txt").select("bytes", "sha256")


_TITLES = (
    (1, "  Ｆｕｌｌ　ｗｉｄｔｈ​ “Quotes” — dash…  ", 'Full width "Quotes" - dash...'), (2, "tab\there\u0007bell", "tab here bell"), (3, None, ""), (4, "ﬁne ① ½", "fine 1 1⁄2"), (5, "İstanbul STRASSE ß", "İstanbul STRASSE ß"),
)
_MARKUP = ((1, "&lt;b&gt;bold&lt;/b&gt; &amp;amp; &eacute; <i>x</i>", "bold &amp; é x"), (2, "a<br>b &nbsp; c", "a b c"), (3, None, ""), (4, "1 &lt; 2", "1 < 2"))
_DATES = (
    ("Tue, 02 Jan 2024 03:04:05 +0800", "2024-01-01T19:04:05"), ("2 Jan 2024 03:04:05 GMT", "2024-01-02T03:04:05"), ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05"), ("2024-01-02T03:04:05+08:00", "2024-01-01T19:04:05"), ("2024-01-02T03:04:05", "2024-01-01T19:04:05"),
    ("2024-01-02 03:04", "2024-01-01T19:04:00"), ("2024/01/02 03:04", "2024-01-01T19:04:00"), ("2024.01.02 03:04", "2024-01-01T19:04:00"), ("2024/01/02", "2024-01-01T16:00:00"), ("1704164645", "2024-01-02T03:04:05"), ("1704164645000", "2024-01-02T03:04:05"), ("99", None), ("no date", None), ("2024-01-02T03:04:05 (broken", "2024-01-01T19:04:00"),
)


def normal_forms(spark: SparkSession, d: str) -> DataFrame:
    """Titles, markup and dates of planted spellings, and the documents' titles and markup."""
    t = spark.createDataFrame([r[:2] for r in _TITLES], "k long, t string").select(F.lit("title").alias("what"), F.concat_ws("/", _s("k")).alias("k"), text.title_norm(F.col("t")).alias("v"))
    m = spark.createDataFrame([r[:2] for r in _MARKUP], "k long, t string").select(F.lit("markup"), _s("k"), text.strip_html(F.col("t")))
    w = spark.createDataFrame([(r[0],) for r in _DATES], "t string").select(F.lit("date"), "t", F.substring(dates.rfc3339(dates.parse_date(F.col("t"))), 1, 19))
    docs = read(spark, d, "documents").select(F.lit("doc"), _s("doc_id"), F.concat_ws("|", F.sha1(text.title_norm(F.col("text"), lower=True)), F.length(text.strip_html(F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit("</p>")))).cast("string")))
    return t.union(m).union(w).union(docs)


_ALIASES = {"GPT": ["the", "g p t"], "Theater": ["theatre", "thea tre"]}


def named(spark: SparkSession, d: str) -> DataFrame:
    """Texts with canonical names, stored summaries with today's, and entities that no table knows."""
    docs = read(spark, d, "documents").select("doc_id", F.coalesce(F.substring("text", 1, 400), F.lit("")).alias("text"))
    said = docs.select("doc_id", F.lit("the end").alias("title_zh"), F.lit("no theatre, ggpt").alias("summary"), F.array(F.lit("the"), F.lit("GPT"), F.lit("other"), F.concat(F.lit("e"), (F.col("doc_id") % 3).cast("string"))).alias("entities"))
    cached = judges.cached_summaries(said, _ALIASES)
    unknown = judges.unknown_entities(cached, spark.sql("SELECT * FROM VALUES ('GPT'), ('other') AS t(name)"))
    a = docs.select(_s("doc_id").alias("k"), text.apply_aliases(F.col("text"), _ALIASES).alias("v"))
    return a.union(cached.select(F.concat(F.lit("c"), _s("doc_id")), F.concat_ws("|", "title_zh", "summary", F.array_join("entities", ",")))).union(unknown.select("entity", _s("n")))


_SPOKEN = (
    ("GPT-6 发布", "GPT六发布。"), ("份额从5-7%升到9%", "份额从百分之五到七升到百分之九。"), ("2026年9月22日发布，支持1500万用户。", "二零二六年九月二十二日发布，支持一千五百万用户。"), ("Xing4.0-29B-A4B 开源", "Xing四点零二百九十亿 A四B 开源。"), ("Thinker-Talker 双模块架构", "Thinker-Talker 双模块架构。"),
    ("下降了-3%，回收价 $5", "下降了负百分之三，回收价美元五。"), ("下一代模型 2 个版本、2 款芯片", "下一代模型两个版本、两款芯片。"), ("2024-2025 财年营收 424,911 美元", "二千零二十四到二零二五财年营收四十二万四千九百一十一美元。"), ("DeepSeek V3.2 同日开源", "深求 V三点二同日开源。"),
)


def spoken_forms(spark: SparkSession, d: str) -> DataFrame:
    """Planted sentences, whole numbers and plain words, as a synthesiser gets them."""
    planted = spark.createDataFrame([(t,) for t, _ in _SPOKEN], "t string").select(F.col("t").alias("k"), speech.spoken_text(F.col("t"), {"DeepSeek": "深求", "Deep": "x"}).alias("v"))
    numbers = read(spark, d, "orders").select((F.col("o_orderkey") * 7 % 10000).alias("n")).distinct().select(_s("n"), speech.read_number_column(F.col("n")))
    words = read(spark, d, "nation").select(F.lower("n_name").alias("w")).select(F.concat(F.lit("w"), "w"), speech.spoken_text(F.concat("w", F.lit(" <b>and</b>,  (again); https://x.example/y"))))
    return planted.union(numbers).union(words)


def hooks(spark: SparkSession, d: str) -> DataFrame:
    """An embedder and a judge from outside, and what becomes of their answers."""
    docs = read(spark, d, "documents").select("doc_id", "text", "source")

    def embedder(texts: list[str]):
        return [[len(t), t.count("e"), 1.0] for t in texts]

    v = judges.embed(docs, "doc_id", "text", embedder)
    q = judges.embed(docs, "doc_id", "source", embedder, query=True, instruction="find")
    both = v.join(q.withColumnRenamed("vector", "q"), "doc_id").select(_s("doc_id").alias("k"), F.concat_ws("|", *[F.round(c * 100000).cast("long").cast("string") for c in (F.get("vector", 1), F.get("q", 0))]).alias("v"))
    n = F.col("doc_id")
    answer = F.concat(F.when(n % 3 == 0, F.lit('sure:\n```json\n{"a": ')).when(n % 3 == 1, F.lit('{"a": ')).otherwise('well {"a": '), _s("doc_id"), F.when(n % 3 == 0, F.lit("}\n```")).when(n % 3 == 1, F.lit("}")).otherwise("} so"))
    parsed = docs.select(F.concat(F.lit("j"), _s("doc_id")), judges.extract_json(F.when(n % 5 == 0, F.lit("nothing")).otherwise(answer)))
    r = judges.summary_row(F.col("source"), F.lit("body"), F.when(n % 2 == 0, F.lit(" said ")), F.lit(None).cast("string"), F.array(F.lit(" the "), F.lit("GPT"), F.lit(""), F.col("source")), F.array(F.lit(" f "), F.lit("")), _ALIASES)
    rows = docs.where("source is not null").select(F.concat(F.lit("s"), _s("doc_id")), F.concat_ws("|", r["title_zh"], r["summary"], F.array_join(r["entities"], ","), F.array_join(r["facts"], ",")))
    return both.union(parsed).union(rows)


def small_rules(spark: SparkSession, d: str) -> DataFrame:
    """Judge answers, fingerprints of parts, days, and the gate of the pool."""
    o, n = read(spark, d, "orders"), F.col("o_orderkey")
    a = o.select(F.concat(F.lit("j"), _s("o_orderkey")).alias("k"), dedup.judged(F.when(n % 4 == 0, F.lit(" a ")).when(n % 4 == 1, F.lit("C")).when(n % 4 == 2, F.lit("yes")), F.when(n % 3 != 0, F.lit(0.7))).alias("v"))
    b = o.select(F.concat(F.lit("d"), _s("o_orderkey")), F.date_add(dates.checked_day(F.date_format("o_orderdate", "yyyy-MM-dd")), dedup.TTL_DAYS).cast("string"))
    runs = spark.sql("SELECT * FROM VALUES ('2024-01-20', 'x'), ('2024-01-20', 'y'), ('_doctor', 'z') AS t(episode, item_key)")
    opened = [pool.open_pool(runs, e).select("episode", F.concat_ws("|", _s("start"), _s("end"), _s("grace_from"), _s("floor"))) for e in ("2024-01-20", "2024-01-21", "_doctor")]
    w = o.select(F.concat(F.lit("w"), _s("o_orderkey")), dedup.worth_judging(F.col("o_totalprice") % 1000 / 1000, n % 2 == 0, n % 3 == 0).cast("string"))
    return a.union(b).union(w).union(opened[0]).union(opened[1]).union(opened[2])


def imported_run(spark: SparkSession, d: str) -> DataFrame:
    """A past run in the pool: items of all documents, verdicts of a judge and of nobody, summaries, dedup rows and picks."""
    from lodestream.operators import items
    from lodestream.plans.state_queries import _EPISODE, _NOW, _rows

    base = items.base_columns(items.raw_items(_rows(spark, d), unicode=False), F.lit(_EPISODE), F.lit(_NOW)).withColumn("n", F.regexp_extract("url_canon", r"/p/(-?\d+)", 1).cast("long"))
    n = F.pmod("n", F.lit(12))
    kinds = dict.fromkeys((*pool.VERDICTS, *pool.SUMMARIES, "dedup_verdict", "used_in_episode"), "string") | {"ai_relevance": "double", "news_value": "double", "reasons": "array<string>", "entities": "array<string>", "facts": "array<string>", "dedup_cluster_id": "long"}
    empty = base.drop("n").withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()}).limit(0)
    prov = lambda prompt, model: F.struct(F.lit(model).alias("model"), prompt.alias("prompt"), F.lit(None).cast("string").alias("decided_at"))
    verdicts = base.where(n % 2 == 0).select("item_key", F.lit("keep").alias("verdict"), F.lit(0.5).alias("ai_relevance"), F.lit(0.5).alias("news_value"), F.when(n % 4 == 0, F.array(F.lit("no-llm"))).alias("reasons"), prov(F.lit("filter-v2"), "m").alias("prov"))
    said = base.where(n % 3 == 0).select("item_key", F.lit("z").alias("title_zh"), F.lit("s").alias("summary"), F.lit(None).cast("array<string>").alias("entities"), F.lit(None).cast("array<string>").alias("facts"), F.lit("g").alias("section_guess"), prov(F.when(n % 6 == 0, F.lit("summary-v2")).otherwise("draft"), "m").alias("prov"))
    got = pool.import_run(empty, base.drop("n"), verdicts, said, base.where(n % 5 == 0).select("item_key", F.lit("fresh").alias("verdict"), F.lit(1).cast("long").alias("cluster_id")), base.where(n == 1).select("item_key"), _EPISODE, "m", F.lit(_NOW), F.col("item_key"))
    return pool.by_keys(got, base.where(n < 10)).select("url_canon", "filter_verdict", "summary", "dedup_verdict", "used_in_episode")


def shots(spark: SparkSession, d: str) -> DataFrame:
    """Windows of shots by overlay or by sentences, any card, and the text for the demuxer."""
    turns = read(spark, d, "conversations").withColumn("dur", (F.length(F.coalesce("text", F.lit(""))) * 10).cast("long"))
    segs = timeline.timeline(timeline.script(turns, "conv_id", "role", ["turn", "text"], "text"), "conv_id", "role", "ord", "dur").select(F.concat_ws("-", _s("conv_id"), "role").alias("item"), F.col("si").cast("int").alias("si"), "start_ms", "end_ms", "conv_id", "ord")
    ids = segs.select("item").distinct()
    overlays = segs.where("si = 1 and conv_id % 2 = 0").select("item", F.when(F.col("conv_id") % 4 == 0, F.lit("shot")).otherwise("card").alias("kind"), "start_ms", "end_ms", F.lit("o.png").alias("src"))
    issue = ids.select("item", F.lit(1).alias("first"), F.lit(2).alias("last"))
    found = timeline.shot_windows(overlays, issue, segs)
    cards = timeline.any_card(segs.select("conv_id", "item", F.when(F.col("ord") > 0, F.lit("card")).otherwise("shot").alias("kind"), F.col("ord").alias("place"), F.concat(F.lit("c"), _s("ord")).alias("path")), "conv_id")
    track = segs.select("conv_id", F.col("start_ms").alias("show_from"), F.col("end_ms").alias("show_to"), F.concat(F.lit("it's "), _s("ord")).alias("src"))
    a = found.select("item", F.concat_ws("|", _s("start_ms"), _s("end_ms"), "src").alias("v"))
    return a.union(cards.select(_s("conv_id"), "path")).union(timeline.ffconcat(track, "conv_id").select(F.concat(F.lit("f"), _s("conv_id")), F.sha1("text")))


def plan_faults(spark: SparkSession, d: str) -> DataFrame:
    """Planted faults of render plans: late audio, missing files, totals apart, an open seam."""
    turns = read(spark, d, "conversations").withColumn("dur", (F.length(F.coalesce("text", F.lit(""))) * 10).cast("long"))
    timed = timeline.timeline(timeline.script(turns, "conv_id", "role", ["turn", "text"], "text"), "conv_id", "role", "ord", "dur")
    spans = timeline.spans(timed, "conv_id", "role").withColumn("end", F.max("end_ms").over(timeline.Window.partitionBy("conv_id")))
    n, c = F.col("span"), F.col("conv_id")
    video = timeline.tile(spans.withColumn("total", F.when(c % 4 == 0, F.col("end") + 100).otherwise(F.col("end"))), "conv_id", "total")
    video = video.withColumns({"show_to": F.when((c % 3 == 0) & (n == 0), F.col("show_to") - 500).otherwise(F.col("show_to")), "src": F.concat(F.lit("v"), (n % 4).cast("string"))})
    audio = timed.where("conv_id % 7 <> 0 or ord <> 1").select("conv_id", "ord", (F.col("start_ms") + F.when(F.col("ord") % 5 == 0, 2).otherwise(1)).alias("at"), F.lit("a").alias("src"))
    files = spark.sql("SELECT * FROM VALUES ('a'), ('v0'), ('v1'), ('v2') AS t(path)")
    return timeline.plan_faults(video, audio, timed, files, "conv_id", "total", "end")


def endpoints(spark: SparkSession, d: str) -> DataFrame:
    """Endpoints in order of health, the best turned, and the title prints of documents by parts."""
    e = read(spark, d, "events").select(F.concat(F.lit("u"), _s("user_id")).alias("name"), (F.col("event_type") != "error").alias("ok"))
    ranked = diff.endpoint_order(diff.health_scores(e, "name", F.col("ok")), 3, 1)
    return ranked.select("name", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"), F.col("place").cast("long").alias("place"))


def asked_pairs(spark: SparkSession, d: str) -> DataFrame:
    """What the cascade would ask a judge."""
    from lodestream.plans.queries import cascade

    return dedup.gray_pairs(cascade(spark, d))


def part_prints(spark: SparkSession, d: str) -> DataFrame:
    """Display fingerprints of a title and a summary together."""
    docs = read(spark, d, "documents").select("doc_id", "text", "source")
    whole = F.concat(text.title_norm(F.col("source"), unicode=False), F.lit(" "), F.coalesce("text", F.lit("")))
    return hashing.simhash(docs, "doc_id", hashing.display_features(whole))


QUERIES = {f.__name__: f for f in (json_lines, run_artifacts, review_round, file_hashes, normal_forms, named, spoken_forms, hooks, small_rules, imported_run, shots, plan_faults, endpoints, asked_pairs, part_prints)}


def _zh(n: str) -> str:
    """How DuckDB reads a number below ten thousand."""
    d = lambda x: f"substr('零一二三四五六七八九', ({x})::INT + 1, 1)"
    th, h, t, o = f"({n} // 1000)", f"({n} // 100 % 10)", f"({n} // 10 % 10)", f"({n} % 10)"
    return (
        f"(CASE WHEN {n} = 0 THEN '零' ELSE CASE WHEN {th} > 0 THEN {d(th)} || '千' ELSE '' END || CASE WHEN {h} > 0 THEN {d(h)} || '百' WHEN {th} > 0 AND {n} % 100 > 0 THEN '零' ELSE '' END "
        f"|| CASE WHEN {t} > 0 THEN CASE WHEN {n} < 20 THEN '十' ELSE {d(t)} || '十' END WHEN {o} > 0 AND {h} > 0 THEN '零' ELSE '' END || CASE WHEN {o} > 0 THEN {d(o)} ELSE '' END END)"
    )


def _quoted(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


_PLANTED_FORMS = ", ".join([f"('title', '{k}', {_quoted(v)})" for k, _, v in _TITLES] + [f"('markup', '{k}', {_quoted(v)})" for k, _, v in _MARKUP] + [f"('date', {_quoted(t)}, {_quoted(v)})" for t, v in _DATES])
_FILE = "'file ' || chr(39) || 'it' || chr(39) || chr(92) || chr(39) || chr(39) || 's ' || {ord} || chr(39)"

ORACLES = {
    "json_lines": "SELECT doc_id, sha1(t) AS sha, length(t) AS chars FROM (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN ' x' || chr(133) || 'y' || chr(8232) || 'z' ELSE '' END AS t FROM documents) UNION ALL VALUES (NULL, '{broken', NULL), (NULL, '[1]', NULL)",
    "run_artifacts": """WITH s AS (SELECT coalesce(source, '?') AS name, count(*) AS n FROM documents GROUP BY 1 ORDER BY 1 LIMIT 1)
        SELECT count(*)::VARCHAR AS a, count_if(length(text) > 1000)::VARCHAR AS b, 'raw_manifest/1|2024-01-20|' || max(CASE WHEN length(text) > 1000 THEN 1005 ELSE length(text) END) || '|' || (SELECT n FROM s) AS c FROM documents
        UNION ALL SELECT (SELECT n_name FROM nation WHERE n_nationkey % 3 = 0 ORDER BY n_nationkey DESC LIMIT 1), 'unpicked', 'human|' || (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 = 0 ORDER BY n_nationkey DESC LIMIT 1 OFFSET 2) || '|' || (SELECT min(n_name) FROM nation WHERE n_nationkey % 3 <> 0)""",
    "review_round": r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS t, coalesce(trim(regexp_replace(substr(text, 1, 300), '\s+', ' ', 'g')), '') AS b FROM documents)
        SELECT 'i-' || doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'Edited ' ELSE 'Head ' END || doc_id AS headline, trim(CASE WHEN doc_id % 3 = 0 THEN replace(t, 'Head', 'Edited') ELSE t END) AS tldr, trim(CASE WHEN doc_id % 3 = 0 THEN replace(b, 'Head', 'Edited') ELSE b END) AS body FROM d""",
    "file_hashes": "SELECT strlen(c) AS bytes, sha256(c) AS sha256 FROM (SELECT string_agg(n_name, chr(10) ORDER BY n_nationkey) || chr(10) AS c FROM nation GROUP BY n_nationkey % 3)",
    "normal_forms": f"SELECT * FROM (VALUES {_PLANTED_FORMS}) AS t(what, k, v)" + r""" UNION ALL SELECT 'doc', doc_id::VARCHAR, sha1(replace(lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))), 'ß', 'ss')) || '|'
        || length(substr(trim(regexp_replace(regexp_replace('<p>' || coalesce(text, '') || '</p>', '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 4000)) FROM documents""",
    "named": r"""SELECT doc_id::VARCHAR AS k, regexp_replace(regexp_replace(regexp_replace(coalesce(substr(text, 1, 400), ''), '\bthea\s*tre\b', 'Theater', 'gi'), '\bg\s*p\s*t\b', 'GPT', 'gi'), '\bthe\b', 'GPT', 'gi') AS v FROM documents
        UNION ALL SELECT 'c' || doc_id, 'GPT end|no Theater, ggpt|GPT,other,e' || doc_id % 3 FROM documents UNION ALL SELECT 'e' || doc_id % 3, count(*)::VARCHAR FROM documents GROUP BY 1""",
    "spoken_forms": f"SELECT * FROM (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in _SPOKEN)}) AS t(k, v) UNION ALL SELECT n::VARCHAR, {_zh('n')} FROM (SELECT DISTINCT o_orderkey * 7 % 10000 AS n FROM orders) UNION ALL SELECT 'w' || lower(n_name), 'nation ' || {_zh('n_nationkey')} || ' and， again。' FROM nation",
    "hooks": """WITH x AS (SELECT doc_id AS n, source, length(coalesce(text, '')) AS l, length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')) AS e, 5 + length(coalesce(source, '')) AS ql, length(coalesce(source, '')) - length(replace(coalesce(source, ''), 'e', '')) AS qe FROM documents)
        SELECT n::VARCHAR AS k, round(100000 * (e / sqrt(l::DOUBLE * l + e * e + 1)))::BIGINT || '|' || round(100000 * (ql / sqrt(ql * ql + qe * qe + 1.0)))::BIGINT AS v FROM x
        UNION ALL SELECT 'j' || n, CASE WHEN n % 5 <> 0 THEN '{"a": ' || n || '}' END FROM x UNION ALL SELECT 's' || n, CASE WHEN n % 2 = 0 THEN 'said' ELSE substr(source, 1, 30) END || '|body|GPT,' || source || '|f' FROM x WHERE source IS NOT NULL""",
    "small_rules": """SELECT 'j' || o_orderkey AS k, CASE WHEN o_orderkey % 4 > 1 THEN 'PARSE' WHEN o_orderkey % 3 = 0 THEN 'LOWCONF' WHEN o_orderkey % 4 = 0 THEN 'A' ELSE 'C' END AS v FROM orders UNION ALL SELECT 'd' || o_orderkey, (o_orderdate::DATE + 21)::VARCHAR FROM orders
        UNION ALL SELECT 'w' || o_orderkey, (c >= 0.80 OR (o_orderkey % 2 = 0 AND c >= 0.55) OR (o_orderkey % 3 = 0 AND c >= 0.62))::VARCHAR FROM (SELECT o_orderkey, o_totalprice % 1000 / 1000 AS c FROM orders)
        UNION ALL VALUES ('2024-01-20', '2024-01-18 22:30:00|2024-01-19 22:30:00|2024-01-18 00:00:00|2024-01-04 22:30:00')""",
    "imported_run": """WITH x AS (SELECT doc_id AS d, doc_id % 12 AS n FROM documents) SELECT 'https://x.example/p/' || d || '?b=' || d AS url_canon, CASE WHEN n % 4 = 2 THEN 'keep' END AS filter_verdict, CASE WHEN n % 6 = 0 THEN 's' END AS summary,
        CASE WHEN n % 5 = 0 THEN 'fresh' END AS dedup_verdict, CASE WHEN n = 1 THEN '2024-01-20' END AS used_in_episode FROM x WHERE n < 10""",
    "shots": _TIMELINE + """, s AS (SELECT *, conv_id || '-' || role AS item FROM m), o AS (SELECT item, start_ms, end_ms FROM s WHERE si = 1 AND conv_id % 4 = 0),
        w AS (SELECT item, min(CASE WHEN si = 0 THEN start_ms END) AS a, min(CASE WHEN si = 1 THEN end_ms END) AS b FROM s WHERE item NOT IN (SELECT item FROM o) GROUP BY 1)
        SELECT item, start_ms || '|' || end_ms || '|o.png' AS v FROM o UNION ALL SELECT item, a || '|' || b FROM w WHERE a IS NOT NULL AND b IS NOT NULL UNION ALL SELECT conv_id::VARCHAR, arg_min('c' || ord, (item, ord)) FROM s WHERE ord > 0 GROUP BY conv_id
        UNION ALL SELECT 'f' || conv_id, sha1('ffconcat version 1.0' || chr(10) || string_agg(""" + _FILE.format(ord="ord") + """ || chr(10) || 'duration ' || printf('%.3f', (end_ms - start_ms) / 1000.0), chr(10) ORDER BY ord) || chr(10) || """ + _FILE.format(ord="max(ord)") + """ || chr(10)) FROM s GROUP BY conv_id""",
    "plan_faults": _TIMELINE + """, s0 AS (SELECT conv_id, span, min(start_ms) AS a, max(end_ms) AS b FROM m GROUP BY ALL), s AS (SELECT *, max(b) OVER (PARTITION BY conv_id) AS e FROM s0), v AS (SELECT *, CASE WHEN conv_id % 4 = 0 THEN e + 100 ELSE e END AS total, row_number() OVER w = 1 AS first, lead(a) OVER w AS n FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY a)),
        x AS (SELECT *, CASE WHEN first THEN 0 ELSE a END AS f, coalesce(n, total) - CASE WHEN conv_id % 3 = 0 AND span = 0 THEN 500 ELSE 0 END AS t FROM v), y AS (SELECT *, lag(t) OVER (PARTITION BY conv_id ORDER BY f) AS p FROM x)
        SELECT conv_id, 'seam' AS fault, f::VARCHAR AS detail FROM y WHERE abs(f - p) > 40 UNION ALL SELECT conv_id, 'no_length', f::VARCHAR FROM y WHERE t <= f UNION ALL SELECT conv_id, 'last_not_total', f::VARCHAR FROM y WHERE n IS NULL AND abs(t - total) > 40
        UNION ALL SELECT DISTINCT conv_id, 'total', total::VARCHAR FROM y WHERE abs(total - e) > 50 UNION ALL SELECT conv_id, 'audio', ord::VARCHAR FROM m WHERE ord % 5 = 0 OR (conv_id % 7 = 0 AND ord = 1) UNION ALL SELECT DISTINCT conv_id, 'file', 'v3' FROM s WHERE span % 4 = 3""",
    "endpoints": """WITH h AS (SELECT 'u' || user_id AS name, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE -2 END)::BIGINT AS score FROM events GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, name) - 1 AS rank FROM h)
        SELECT name, score, rank, CASE WHEN rank < 3 THEN (rank + 2) % 3 ELSE rank END AS place FROM r""",
    "asked_pairs": "SELECT key, cluster_id, cos FROM (" + _CORE["cascade"] + ") WHERE via = 'judge_na'",
    "part_prints": _DISPLAY_ALL.replace(_DOCS, "docs AS (SELECT doc_id, trim(coalesce(source, '')) || ' ' || coalesce(text, '') AS text FROM documents)") + "SELECT doc_id, simhash FROM s",
}
