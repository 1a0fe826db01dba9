"""An issue's items: prompts and cards from them, normalised answers, and the checks of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.text import clip, grouped_numbers, md_to_html, numbers, slugify, strip_inline_html, tts_text_fix
from lodestream.operators.validate import violations

# Caps of fields in prompts, cards and titles.
BODY_CAP, TITLE_CAP, CARDS, LONG_SENTENCE, NAV, ENTITIES, FACTS = 600, 30, 8, 45, 12, 20, 30
MAGNITUDES = {"万": 1e4, "亿": 1e8, "k": 1e3, "K": 1e3, "m": 1e6, "M": 1e6, "b": 1e9, "B": 1e9}
# The characters of identifiers, and those that a number counts.
IDENTIFIER, COUNTED = r"A-Za-z0-9._\-", "个只条款位名次种类型套天周月日号倍层部台件篇则起例版代季轮档元角分秒页行字段节章集站校院厂省市县人岁期"
# How sure an item may be said to be, and what counts as markup.
CONFIDENCES = ("confirmed", "reported", "rumor", "speculation")
TAG, BLOCK = r"<[a-zA-Z/!][^>]*>", r"(?m)^\s*(#{1,6}\s|[-*+]\s|>\s|\d+\.\s|```)"
_NONE = "array<string>"


def section_slug(text: Column, key: Column, vocabulary: dict[str, str]) -> Column:
    """A section's slug: that of the vocabulary (slug -> name) by either, else one made of the text, else misc."""
    t = F.trim(F.coalesce(text, F.lit("")))
    found = F.when(t == "", "misc")
    for slug, name in vocabulary.items():
        found = found.when(t.isin(slug, name), slug)
    made = slugify(t, key, unicode=False)
    own = F.concat(F.lit("n"), F.substring(F.coalesce(key, F.lit("")), 1, 8))
    return found.when(~made.rlike("^[a-z0-9-]{2,24}$") | made.isin("item-0") | (made == own), "misc").otherwise(made)


def item_body(rows: DataFrame, cap: int = BODY_CAP) -> Column:
    """The labelled lines of an item in a prompt, each field with a cap of its own; absent columns have no line.

    Reads title, source, date, section, facts, entities, labels, summary, content_text, voice.
    """

    def line(label: str, name: str, n: int, joint: str | None = None) -> Column:
        if name not in rows.columns:
            return F.lit(None).cast("string")
        value = F.array_join(name, joint) if joint else F.col(name)
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), clip(value, n)))

    links = F.lit(None).cast("string")
    if "labels" in rows.columns:
        shown = F.transform(F.slice("labels", 1, 12), lambda x, i: F.concat(F.lit("u"), (i + 1).cast("string"), F.lit("="), clip(x, 60)))
        links = F.when(F.size("labels") > 0, F.concat(F.lit("链接: "), F.array_join(shown, "  "), F.when(F.size("labels") > 12, "  …").otherwise("")))
    return F.concat_ws(
        "\n", line("标题", "title", 240), line("来源", "source", 80), line("日期", "date", 40), line("分区", "section", 40), line("事实", "facts", 1000, "；"), line("实体", "entities", 400, "、"), links,
        line("概要", "summary", 600), line("正文", "content_text", cap), line("口播", "voice", cap, " "),
    )


def _flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def item_card(key: Column, cards: Column, tldr: Column, headline: Column, short: Column) -> Column:
    """An item's card: its own cards with a text, at most CARDS, else one of its summary; and a main title.

    cards: array<struct<label, body, icon>>.
    """
    own = F.transform(F.coalesce(cards, F.array().cast("array<struct<label:string,body:string,icon:string>>")), lambda c: F.struct(_flat(c["label"]).alias("title"), md_to_html(_flat(c["body"])).alias("desc"), F.coalesce(F.nullif(F.trim(c["icon"]), F.lit("")), F.lit("article")).alias("icon")))
    good = F.filter(own, lambda c: (c["title"] != "") | (c["desc"] != ""))
    text = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], key)
    spare = F.array(F.struct(F.lit("要点").alias("title"), md_to_html(text(tldr, headline)).alias("desc"), F.lit("article").alias("icon")))
    return F.struct(key.alias("id"), F.trim(text(short, headline)).alias("main_title"), F.slice(F.when(F.size(good) > 0, good).otherwise(spare), 1, CARDS).alias("cards"))


def cards_document(rows: DataFrame, key: str, card: str, episode: str, template: str) -> DataFrame:
    """A JSON document for each episode: its cards in order of key."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(key).alias("_k"), F.col(card).alias("c"))))
    body = F.struct(F.lit("cards/1").alias("schema"), F.col(episode).alias("episode"), F.lit(template).alias("template"), F.transform(listed, lambda x: x["c"]).alias("items"))
    return rows.groupBy(episode).agg(F.to_json(body).alias("document"))


def spare_voice(tldr: Column, headline: Column, key: Column) -> Column:
    """One spoken sentence of an item that the judge gave none."""
    text = F.coalesce(F.nullif(tldr, F.lit("")), F.nullif(headline, F.lit("")), key)
    return F.array(F.concat(F.regexp_replace(F.trim(F.regexp_replace(text, r"\*\*|`", "")), "。+$", ""), F.lit("。")))


def mapped_cards(cards: Column, icons: tuple[str, ...]) -> Column:
    """Generated cards (title, desc, icon) as an issue's: inline tags to markdown, unknown icons to article, each with the
    flags that it earns."""

    def one(c: Column) -> Column:
        icon, body = F.trim(F.coalesce(c["icon"], F.lit(""))), strip_inline_html(_flat(c["desc"]))
        off = (icon != "") & ~icon.isin(*icons)
        flags = F.array_compact(F.array(F.when(off, "icon_offlist"), F.when((F.length(body) > 0) & ~F.length(body).between(20, 60), "card_desc_len")))
        return F.struct(_flat(c["title"]).alias("label"), body.alias("body"), F.when(off | (icon == ""), "article").otherwise(icon).alias("icon"), flags.alias("flags"))

    return F.slice(F.filter(F.transform(cards, one), lambda c: (c["label"] != "") | (c["body"] != "")), 1, CARDS)


def spoken_sentences(sentences: Column) -> Column:
    """Sentences made fit to be spoken, with the flags of each."""

    def one(s: Column) -> Column:
        fixed, flat = tts_text_fix(s), _flat(s)
        return F.struct(fixed.alias("text"), F.array_compact(F.array(F.when(fixed != flat, "voice_hyphen_fixed"), F.when(F.length(fixed) > LONG_SENTENCE, "voice_too_long"))).alias("flags"))

    return F.transform(sentences, one)


def normal_items(said: DataFrame, kept: DataFrame) -> DataFrame:
    """A judge's items (id, section, nav, headline, tldr, body, confidence, entities, facts) in the form of the issue.

    One row for each kept item (id, section, title, summary, entities, facts, image, url), in whose section it stays
    whatever the judge said; missing fields come from it. flags: section_overridden where the judge moved it.
    """
    names = ("section", "nav", "headline", "tldr", "body", "confidence", "entities", "facts")
    rows = kept.join(said.select("id", *[F.col(c).alias(f"_{c}") for c in names]), "id", "left")
    text = lambda *cs: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cs], F.lit(""))
    listed = lambda a, b, n: F.slice(F.coalesce(F.when(F.size(a) > 0, F.col(a)), F.when(F.size(b) > 0, F.col(b)), F.array().cast(_NONE)), 1, n)
    body = F.filter(F.transform(F.split(F.coalesce("_body", F.lit("")), r"\n\s*\n"), lambda p: F.trim(p)), lambda p: p != "")
    body = F.when(F.size(body) > 0, body).otherwise(F.array(F.coalesce(F.nullif("summary", F.lit("")), F.nullif("title", F.lit("")), "id")))
    media = F.when(F.coalesce("image", F.lit("")) != "", F.array(F.struct(F.lit("image").alias("kind"), F.col("image").alias("src"), F.nullif("url", F.lit("")).alias("origin"))))
    return rows.select(
        "id", "section", F.coalesce(F.nullif(F.substring(text("_nav", "title"), 1, NAV), F.lit("")), "id").alias("nav"), strip_inline_html(_flat(text("_headline", "title"))).alias("headline"), strip_inline_html(_flat(text("_tldr", "summary"))).alias("tldr"),
        F.transform(body, lambda p: strip_inline_html(p)).alias("body"), F.when(F.col("_confidence").isin(*CONFIDENCES), F.col("_confidence")).otherwise("reported").alias("confidence"), listed("_entities", "entities", ENTITIES).alias("entities"),
        listed("_facts", "facts", FACTS).alias("facts"), media.alias("media"), F.when(F.coalesce("_section", "section") != F.col("section"), F.array(F.lit("section_overridden"))).otherwise(F.array().cast(_NONE)).alias("flags"),
    )


def normal_sections(said: DataFrame, kept: DataFrame, names: dict[str, str]) -> DataFrame:
    """slug, name, place: the sections that the judge declared (slug, name, place), each once, then those of kept items
    (section, place) that are missing, in order."""
    known = F.coalesce(*[F.when(F.col("slug") == s, n) for s, n in names.items()], F.col("slug"))
    declared = said.where(F.coalesce("slug", F.lit("")) != "").select("slug", F.coalesce(F.nullif("name", F.lit("")), known).alias("name"), F.lit(0).alias("part"), "place")
    needed = kept.select(F.coalesce(F.nullif("section", F.lit("")), F.lit("top-news")).alias("slug"), "place").select("slug", known.alias("name"), F.lit(1).alias("part"), "place")
    first = declared.union(needed).groupBy("slug").agg(F.min(F.struct("part", "place", "name")).alias("f"))
    order = Window.orderBy("f.part", "f.place", "slug")  # a row a section
    return first.select("slug", F.col("f.name").alias("name"), (F.row_number().over(order) - 1).alias("place"))


def fact_numbers(facts: Column) -> Column:
    """The numbers of a list of facts, and with a magnitude behind them also what that makes of them."""
    found = F.regexp_extract_all(F.array_join(F.coalesce(facts, F.array().cast(_NONE)), "\n"), F.lit(r"(?:\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)[万亿kKmMbB]?"), 0)
    value = lambda x: F.replace(F.regexp_replace(x, "[万亿kKmMbB]$", ""), F.lit(","), F.lit("")).cast("double")
    times = lambda x: F.coalesce(*[F.when(F.endswith(x, F.lit(m)), F.lit(k)) for m, k in MAGNITUDES.items()])
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.transform(found, value), F.transform(found, lambda x: value(x) * times(x))))))


def loose_numbers(text: Column, allowed: Column) -> Column:
    """The numbers of a text that nothing allows: not the facts' or the issue's own (allowed, doubles), not years, ordinals
    or counts of things, and not part of a name.

    A number is read with what it hangs together with: an ordinal mark before it, the letters and signs that it is
    written into, a measure word after it.
    """
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?:第[ *`]*)?[{IDENTIFIER}]*[0-9][{IDENTIFIER},]*(?:[ *`]*[{COUNTED}])?"), 0)
    bare = F.filter(runs, lambda r: ~F.startswith(r, F.lit("第")) & ~r.rlike("[A-Za-z]") & ~r.rlike(f"[{COUNTED}]$"))
    found = F.flatten(F.transform(bare, lambda r: grouped_numbers(r)))
    year = lambda v: (v == F.floor(v)) & v.between(1900, 2100)
    near = lambda v: F.exists(allowed, lambda a: F.abs(v - a) <= F.greatest(F.abs(v), F.abs(a)) * 1e-9)
    return F.filter(found, lambda x: ~year(x.cast("double")) & ~near(x.cast("double")))


def input_numbers(rows: DataFrame) -> Column:
    """All numbers of an item's inputs: title, summary, content_text and facts."""
    texts = [F.col(c) for c in ("title", "summary", "content_text")]
    return F.array_distinct(F.concat(*[numbers(t) for t in texts], numbers(F.array_join(F.coalesce("facts", F.array().cast(_NONE)), "\n"))))


def issue_violations(items: DataFrame, sections: DataFrame, sources: DataFrame, kept: DataFrame) -> DataFrame:
    """Broken rules of an issue, as rows of rule, level, place, message.

    items: id, section, headline, tldr, body, facts, voice. sections: slug. sources: id, url, primary. kept: id, url,
    url_canon, title, summary, content_text, facts.
    """
    place, error = F.col("id"), "error"
    none = F.array().cast(_NONE)
    twice = items.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    homeless = items.join(sections.select(F.col("slug").alias("section")).distinct(), "section", "left_anti")
    primaries = sources.groupBy("id").agg(F.count_if("primary").alias("n")).where("n > 1")
    listed = kept.select(F.explode(F.array("url", "url_canon")).alias("url")).where("url <> ''").distinct()
    strange = sources.where(F.col("url").rlike("^https?://")).join(listed, "url", "left_anti")
    spoken = items.select("id", F.explode("voice").alias("s"))
    found = [
        violations(twice, "duplicate-id", place, F.concat(F.lit("times "), F.col("n").cast("string"))), violations(homeless, "section", place, F.col("section")),
        violations(primaries, "primary", place, F.col("n").cast("string")), violations(sources.where(~F.col("url").rlike("^https?://")), "bad-url", place, F.col("url")), violations(strange, "url-membership", place, F.col("url")),
        violations(items.join(sources.select("id").distinct(), "id", "left_anti"), "no-sources", place, F.lit(""), "warning"), violations(spoken.where(F.trim("s") == ""), "empty-sentence", place, F.lit("")),
        violations(spoken.where(F.col("s").rlike(TAG) | F.col("s").rlike(BLOCK) | F.contains("s", F.lit("**")) | F.contains("s", F.lit("`"))), "markup-spoken", place, F.col("s")),
        violations(items.where(F.col("tldr").rlike(TAG) | F.exists(F.coalesce("body", none), lambda p: p.rlike(TAG))), "markup", place, F.lit("")), violations(items.where(F.contains("tldr", F.lit("\n"))), "line-break", place, F.lit("")),
    ]
    spine = numbers(F.concat_ws(" ", "headline", "tldr", F.array_join(F.coalesce("body", none), " "), F.array_join(F.coalesce("facts", none), " ")))
    new = items.select("id", F.explode("voice").alias("s"), spine.alias("spine")).select("id", F.explode(F.array_except(numbers(F.col("s")), F.col("spine"))).alias("n"))
    allowed = kept.select("id", input_numbers(kept).alias("pool"))
    rows = items.join(allowed, "id").withColumn("own", numbers(F.array_join(F.coalesce("facts", none), " ")))
    invented = rows.select("id", F.explode(F.array_except("own", "pool")).alias("n"))
    written = numbers(F.concat_ws(" ", "headline", "tldr", F.array_join(F.coalesce("body", none), " ")))
    loose = rows.select("id", F.explode(F.array_except(written, F.array_union("pool", "own"))).alias("n"))
    flags = [violations(r, rule, place, F.col("n"), "flag") for r, rule in ((new, "number_not_in_spine"), (invented, "fact_not_in_input"), (loose, "number_not_in_facts"))]
    out = found[0]
    for part in [*found[1:], *flags]:
        out = out.union(part)
    return out


def audit_flags(found: DataFrame) -> DataFrame:
    """Violations as flags: id, kind, severity, snippet."""
    return found.select(F.col("place").alias("id"), F.concat(F.lit("validate_"), "rule").alias("kind"), F.when(F.col("level") == "error", "high").otherwise("low").alias("severity"), F.substring("message", 1, 80).alias("snippet"))


def selected_errors(doc: DataFrame) -> DataFrame:
    """Rows of a selection (episode, decided_at, decided_by, item_key, id, section, note, place) with what is wrong in each,
    by the document's own rules; an id that came before counts against the later row."""
    w = Window.partitionBy("id").orderBy("place")
    wrong = F.array_compact(F.array(
        F.when(~F.coalesce("item_key", F.lit("")).rlike("^[0-9a-f]{16}$"), "item_key"), F.when(~F.coalesce("id", F.lit("")).rlike("^[a-z0-9-]{2,24}$"), "id"),
        F.when(F.coalesce("id", F.lit("")).rlike("^[a-z0-9-]{2,24}$") & (F.col("_n") > 1), "repeated"), F.when(F.coalesce("section", F.lit("")) == "", "section"), F.when(F.col("note").isNull(), "note"),
        F.when(~F.coalesce("decided_by", F.lit("")).isin("human", "auto"), "decided_by"), F.when(F.coalesce("decided_at", F.lit("")) == "", "decided_at"), F.when(~F.coalesce("episode", F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}$"), "episode"),
    ))
    return doc.withColumn("_n", F.row_number().over(w)).withColumn("errors", wrong).drop("_n")


def spare_titles(items: DataFrame, order: str, episode: str, cap: int = TITLE_CAP) -> DataFrame:
    """place, title, id: titles made of the first two items, with the day behind them, at most cap characters."""
    suffix = f"【AI 早报 {episode}】"
    head = lambda c: F.regexp_replace(F.coalesce(F.nullif(F.col("headline"), F.lit("")), F.nullif("nav", F.lit("")), c), r"\s+", "")
    rows = items.withColumn("place", F.row_number().over(Window.orderBy(order))).where("place <= 2")  # an issue's items
    rows = rows.withColumn("_h", F.when(F.col("place") == 1, head(F.lit("AI 早报"))).otherwise(head(F.lit("")))).where("place = 1 or _h <> ''")
    return rows.select("place", F.concat(F.substring("_h", 1, cap - len(suffix)), F.lit(suffix)).alias("title"), "id")


def sound_titles(said: DataFrame, day: str, most: int = 5, cap: int = TITLE_CAP) -> DataFrame:
    """place, title: a judge's titles in order, each once, those that name the day and are short enough, at most so many."""
    flat = F.trim(F.regexp_replace("title", r"\s+", " "))
    rows = said.withColumn("title", flat).where((F.length("title") <= cap) & F.contains("title", F.lit(day)) & (F.col("title") != ""))
    first = rows.groupBy("title").agg(F.min("place").alias("place"))
    return first.orderBy("place").limit(most)


def edited(before: DataFrame, after: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """key, change: rows that an editor added, removed or changed, by a hash of their fields."""
    mark = F.sha2(F.to_json(F.struct(*fields)), 256)
    a, b = before.select(key, mark.alias("_a")), after.select(key, mark.alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def summaries_for(items: DataFrame, pool: DataFrame, judged: DataFrame) -> DataFrame:
    """item_key, title_zh, summary, via: the pool's summary of the same content, else the judge's, else the item's own."""
    cached = pool.where("summary is not null").select("item_key", F.col("summary_sha").alias("content_sha"), F.col("title_zh").alias("_ct"), F.col("summary").alias("_cs"))
    # the item's own is cut before the joins, which would move whole texts otherwise
    spare = F.substring(F.coalesce(F.nullif("content_text", F.lit("")), "title", F.lit("")), 1, 120)
    own = items.select("item_key", "content_sha", F.substring("title", 1, 30).alias("_t"), spare.alias("_s"))
    rows = own.join(cached, ["item_key", "content_sha"], "left").join(judged.select("item_key", F.col("title_zh").alias("_jt"), F.col("summary").alias("_js")), "item_key", "left")
    via = F.when(F.col("_cs").isNotNull(), "cache").when(F.col("_js").isNotNull(), "judge").otherwise("missed")
    return rows.select("item_key", F.coalesce("_ct", "_jt", "_t").alias("title_zh"), F.coalesce("_cs", "_js", "_s").alias("summary"), via.alias("via"))


def stage_ledger(old: DataFrame, done: DataFrame) -> DataFrame:
    """A run's ledger with newly done stages over the old entries: stage, status, artifact, seconds from start to end."""
    new = done.select("stage", "status", "artifact", (F.unix_timestamp("ended") - F.unix_timestamp("started")).alias("seconds"))
    return old.join(new.select("stage"), "stage", "left_anti").select("stage", "status", "artifact", "seconds").union(new)


def listed_words(lines: DataFrame) -> DataFrame:
    """Words of a list file (a column value): blank lines and comments are left out."""
    word = F.trim("value")
    return lines.select(word.alias("word")).where((F.col("word") != "") & ~F.startswith("word", F.lit("#"))).distinct()


def word_hits(rows: DataFrame, key: str, texts: tuple[str, ...], words: DataFrame) -> DataFrame:
    """key, field, word, snippet for each listed word in each text field; the list is configured and broadcast as one array."""
    fields = F.array(*[F.struct(F.lit(t).alias("field"), F.coalesce(t, F.lit("")).alias("text")) for t in texts])
    listed = F.broadcast(words.agg(F.array_sort(F.collect_set("word")).alias("_words")))
    each = rows.select(key, F.explode(fields).alias("_f")).join(listed, F.lit(True))  # one row of words
    found = each.select(key, "_f.field", "_f.text", F.explode(F.filter("_words", lambda w: F.contains(F.col("_f.text"), w))).alias("word"))
    at = F.expr("locate(word, text)")
    return found.select(key, "field", "word", F.substring(F.col("text"), F.greatest(at - 15, F.lit(1)), F.length("word") + 30).alias("snippet"))
