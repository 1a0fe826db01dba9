"""The training-data operators: brute force, round trips, odd rows and held-out accuracy."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestream.llm import arrow_words, decontaminate, language_model, minhash, mixing, quality_model, quality_rules, registry, token_ids, toxicity, url_filter, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d e f"), (6, "a b c d e f"), (6, "a b c d e f"), (None, "a b c d e f g"), (7, "x" * 5000 + " y  z\n z"), (8, "w " * 3000)]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, None, None if i == 4 else "s", 0, -1) for i, t in rows], SCHEMA)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    c = sorted(df.columns)
    rel = con.sql(registry.ORACLES[name])
    key = lambda rows: sorted(map(str, rows))
    assert key(tuple(r[x] for x in c) for r in df.collect()) == key(tuple(r[rel.columns.index(x)] for x in c) for r in rel.fetchall())


def test_urls_odd_rows(spark):
    rows = [(1, None, "h"), (2, "no scheme", "h"), (3, "http://A.net/x", "h"), (3, "http://A.net/x", "h"), (4, "https://b.example.net/en/1?q", "h"), (5, "https://example.com/de", "h"), (6, "http://net", "h"), (7, "http://x.org/fr/?a://b", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, url_filter.rule_table(spark)).collect())
    assert got == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.net", "/x", "net/", "block"), (3, "a.net", "/x", "net/", "block"), (4, "b.example.net", "/en/1", "example.net/en/", "allow"), (5, "example.com", "/de", None, "allow"), (6, "net", "", None, "allow"), (7, "x.org", "/fr/", "org/fr/", "allow")]
    assert url_filter.filter_urls(df.limit(0), url_filter.rule_table(spark)).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(df, url_filter.rule_table(spark, ())).collect()} == {"allow"}


def test_bloom_passes_every_listed_url(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks, n = url_filter.bloom_blocks(keys, 500)
    probe = lambda df: df.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n))).join(blocks, "block").where(" and ".join(f"(w{w} & m{w}) = m{w}" for w in range(8)))
    with_masks = lambda df: df.select("key", *[url_filter._mask(F.col("key"), w).alias(f"m{w}") for w in range(8)])
    assert probe(with_masks(keys)).count() == 500
    assert probe(with_masks(spark.range(1000, 6000).select(F.concat(F.lit("k"), "id").alias("key")))).count() < 250


def test_simple8b_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 119, 120, 255, 256, 257, 3000):
        for top in (1, 2, 300, 50257, 1 << 33, 1 << 63):
            ids = r.integers(0, top, n, dtype=np.uint64)
            ids[: n // 7] = (1 << 64) - 1 if top > 1 << 40 else 0
            words, offsets = token_ids.pack(ids)
            assert (token_ids.unpack(words, offsets, n) == ids).all()
    keys, n_tokens, ids = token_ids.read_shard(token_ids.shard_bytes([None, 5], np.array([1, 2]), np.array([0, 7, 0])))
    assert keys == [None, 5] and n_tokens.tolist() == [1, 2] and ids.tolist() == [0, 7, 0]


def test_pieces_encode_as_whole_texts():
    plain = Tokenizer.from_file(token_ids.tokenizer_file())
    e = token_ids.PieceEncoder(token_ids.tokenizer_file())
    texts = ["", None, " ", "a  b", "a \n b", "it's  don't  x y  z", "<|endoftext|> a", "\x1c a \x1c", " 12 3", "a, b. c!? d?!x .", "½, ². é̀", "日本語 テスト。 ok", "x" * 3000 + " " * 50 + "y"]
    for _ in range(2):
        ids, n = e.encode(texts)
        for t, part in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
            assert part.tolist() == [*plain.encode(t or "", add_special_tokens=False).ids, 0]


def test_memo_is_bounded_and_merged(monkeypatch):
    monkeypatch.setattr(token_ids, "MEMO_PIECES", 300)
    plain, e, r = Tokenizer.from_file(token_ids.tokenizer_file()), token_ids.PieceEncoder(token_ids.tokenizer_file()), np.random.default_rng(0)
    for i in range(30):
        texts = [" ".join(f"w{x}" for x in r.integers(0, 60 * (i + 1), 20)) for _ in range(6)]
        ids, _ = e.encode(texts)
        assert ids.tolist() == [x for t in texts for x in [*plain.encode(t, add_special_tokens=False).ids, 0]]
    assert len(e.large[0]) + len(e.small[0]) <= 300 + 120


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "b" * 50, "c", "", "d" * 9])], names=["i", "t"])
    parts = list(arrow_words.pieces([batch], rows=3, most=12))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1], [2], [3, 4, 5]]
    assert list(arrow_words.pieces([batch.slice(0, 0)])) == []


def test_token_files(spark):
    got = [tuple(r) for r in token_ids.encode_and_read(odd(spark)).collect()]
    tokenizer, at = Tokenizer.from_file(token_ids.tokenizer_file()), 0
    for want, row in zip(sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)), sorted(got, key=lambda r: r[1]), strict=True):
        ids = [*tokenizer.encode(want[1] or "", add_special_tokens=False).ids, 0]
        assert row == (want[0], at, len(ids), zlib.crc32(np.array(ids, "<u4")))
        at += len(ids)
    assert token_ids.encode_and_read(odd(spark).limit(0)).count() == 0


def test_quality_rules_odd_rows(spark):
    rows = quality_rules.ledger(odd(spark)).select("doc_id", "n_words", "word_chars", "n_repeat_words", "failures", "lang", "size").collect()
    assert len(rows) == len(ODD) and all(r.failures & 1 for r in rows if r.doc_id != 8)
    by = {r.doc_id: r for r in rows}
    assert (by[8].n_words, by[8].n_repeat_words) == (3000, 3000) and by[3].n_words == 0 and by[7].word_chars == 5003
    kept = quality_rules.keep_good(docs(spark))
    assert kept.columns == docs(spark).columns and 0 < kept.count() < docs(spark).count()
    total = quality_rules.ledger(docs(spark)).agg(F.count_if(quality_rules.passes("standard-1"))).first()[0]
    table = {r.rule: r for r in quality_rules.ablations(quality_rules.ledger(docs(spark)), "standard-1").collect()}
    assert len(table) == len(quality_rules.RULES) and all(r.n_kept == total and r.n_kept_without == total + r.n_failed_alone for r in table.values())


def test_mixing_targets(spark):
    rows = mixing.mix(docs(spark)).collect()
    sizes, targets, taken = collections.Counter(), {}, collections.Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        targets[r.source] = r.target
        taken[r.source] += r["size"] * r.reps
    names = sorted(sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, want = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 2 * sizes[s]]
        if not over:
            want |= {s: share * weight[s] for s in free}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
            free.discard(s)
    biggest = max(r["size"] for r in rows)
    assert all(math.isclose(targets[s], want[s]) and abs(taken[s] - want[s]) <= biggest for s in names)
    assert sorted(map(tuple, mixing.mix(docs(spark)).select("doc_id", "reps").collect())) == sorted((r.doc_id, r.reps) for r in rows)
    strange = mixing.mix(odd(spark))
    assert strange.count() == len(ODD) and all(0 <= r.reps <= 2 for r in strange.collect())
    assert mixing.mix(odd(spark).limit(0)).count() == 0


def _sets(rows):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def test_near_duplicates_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).select("doc_id", "text").collect()]
    r = np.random.default_rng(2)
    long = [t for _, t in rows if t and len(t.split()) > 150][:8]
    for g, t in enumerate(long):  # chains of copies with more and more edits, and exact copies
        w = t.split()
        for i in range(12):
            rows.append((10_000 + 100 * g + i, " ".join(w)))
            w[int(r.integers(len(w)))] = f"edit{g}_{i}"
        rows.append((10_090 + 100 * g, t.upper()))
    sets, ids = _sets(rows), [i for i, _ in rows]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            seen[g].append(k)
    common = collections.Counter((a, b) for ks in seen.values() for x, b in enumerate(ks) for a in ks[:x])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(ids[a]), find(ids[b])
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.judge(df).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in zip(ids, sets, strict=True)}
    left = minhash.drop_duplicates(df.withColumn("size", F.lit(1)))
    assert left.columns == ["doc_id", "text", "size"] and {r.doc_id for r in left.collect()} == {i for i in ids if find(i) == i}


def test_near_duplicates_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.judge(odd(spark)).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 2, 5), (6, 2, 5), (6, 2, 5), (None, 3, None), (7, 1, 7), (8, 1, 8)], key=str)
    assert minhash.judge(odd(spark).limit(0)).count() == 0


def test_one_id_with_several_texts(spark):
    """Each row by its own text: 9 stands for its first text and not for its second."""
    rows = [(9, "p q r s t u"), (9, "a b c d e f"), (5, "a b c d e f"), (12, "p q r s t u"), (12, "v w x y z")]
    df = odd(spark, rows).withColumn("text_key", F.lit("mine"))
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.judge(df).collect())
    assert got == [(5, 2, 5, True), (9, 2, 5, False), (9, 2, 9, True), (12, 1, 12, True), (12, 2, 9, False)]
    left = minhash.drop_duplicates(df)
    assert left.columns == df.columns and sorted((r.doc_id, r.text[0], r.text_key) for r in left.collect()) == [(5, "a", "mine"), (9, "p", "mine"), (12, "v", "mine")]


def test_blocks_of_a_bucket():
    r = np.random.default_rng(0)
    base, rows = r.integers(0, 2**63, 300, dtype=np.uint64), []
    for i in range(40):
        s = base.copy()
        k = int(r.integers(0, 110))
        s[r.choice(300, k, replace=False)] = r.integers(0, 2**63, k, dtype=np.uint64)
        m = minhash.pack_low_bits(minhash.minima(s)[None])[0]
        rows.append({"bucket": 0, "i": 0, "j": 0, "block": 0, "id": i, "label": i, "n_shingles": 300, "bands": np.zeros(32, np.int64), "shingles": s.view(np.int64)} | {f"s{q}": m[q] for q in range(4)})
    links = minhash._compare_blocks(pd.DataFrame(rows))
    find = lambda p, i: i if p[i] == i else find(p, p[i])
    mine, want = list(range(40)), list(range(40))
    for a, b in links.itertuples(index=False):
        mine[find(mine, a)] = find(mine, b)
    for a in range(40):
        for b in range(a):
            x, y = set(rows[a]["shingles"]), set(rows[b]["shingles"])
            if 100 * len(x & y) >= 75 * len(x | y):
                want[find(want, a)] = find(want, b)
    assert all((find(mine, a) == find(mine, b)) == (find(want, a) == find(want, b)) for a in range(40) for b in range(40))


@pytest.mark.parametrize("kind", ["substitute", "insert", "delete", "mixed"])
def test_decontamination_recall(spark, kind):
    """Passages with n // 5 word edits, whole through and by the buckets alone."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    items, r = decontaminate.Items(bench.item_id.tolist(), bench.text.tolist()), np.random.default_rng(3)
    clean = [t for t in docs(spark).toPandas().text if t and not any(b in t for b in bench.text)][:100]
    texts, truth = [], []
    for q in range(300):
        t, i = clean[q % len(clean)], q % len(bench)
        w = bench.text[i].split()
        for e in range(len(w) // 5):
            at, how = int(r.integers(len(w))), kind if kind != "mixed" else ("substitute", "insert", "delete")[int(r.integers(3))]
            w[at : at + (how != "insert")] = [] if how == "delete" else [f"edit{q}x{e}"]
        x = t.split()
        at = int(r.integers(len(x) + 1))
        texts.append(" ".join([*x[:at], *w, *x[at:]]))
        truth.append((q, i))
    found = {(int(a), int(b)) for a, b in items.matches(*decontaminate.number_words(items, pa.array(texts, pa.large_string())))[:, :2]}
    assert len(found & set(truth)) >= 0.95 * len(truth) and not found - set(truth)
    assert len(items.matches(*decontaminate.number_words(items, pa.array(clean, pa.large_string())))) == 0


def test_buckets_select():
    """Windows that begin where the edited passage does: most meet their item; unrelated windows of frequent words mostly don't."""
    r, n = np.random.default_rng(5), 40
    words = lambda: " ".join(f"w{x}" for x in r.zipf(1.5, n) % 500)
    texts = [words() for _ in range(60)]
    items = decontaminate.Items(list(range(60)), texts)
    met, wrong = 0, 0
    for i, own in enumerate(items.words):
        w = own.copy()
        w[r.choice(n, n // 5, replace=False)] = 0
        found = items.candidates(w[None])[:, 1].tolist()
        met += i in found
        wrong += len(set(found) - {i})
    assert met >= 57 and wrong / (60 * 59) < 0.5


def test_long_items_need_no_padding():
    r = np.random.default_rng(6)
    long, short = " ".join(f"v{x}" for x in r.integers(0, 10**6, 3000)), "one two three four five six"
    items = decontaminate.Items([1, 2, None], [long, short, "seven eight"])
    got = items.matches(*decontaminate.number_words(items, pa.array([f"x {long} y {short}", short, None, "seven eight"], pa.large_string())))
    assert [(a, items.ids[b], d) for a, b, _, d in got.tolist()] == [(0, 1, 0), (0, 2, 0), (1, 2, 0), (3, None, 0)]


def test_edit_distances_equal_brute_force():
    r = np.random.default_rng(4)
    items, regions, n = r.integers(1, 5, (30, 8)), r.integers(0, 5, (30, 14)), r.integers(1, 9, 30)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (x != y)))
            row = new
        return min(row)

    assert decontaminate.edit_distances(items, n, regions).tolist() == [slow(a[:k].tolist(), b.tolist()) for a, k, b in zip(items, n, regions, strict=True)]


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f")], "item_id long, text string")
    got = sorted({(r.doc_id, r.item_id) for r in decontaminate.find_leaks(odd(spark), bench).collect()}, key=str)
    assert got == sorted({(5, 3), (6, 3), (None, 3)}, key=str)
    assert decontaminate.find_leaks(odd(spark), bench.limit(0)).count() == 0
    assert {r.doc_id for r in decontaminate.clean(odd(spark), bench).collect()} == {1, 2, 3, 4, 7, 8, None}


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "u", None), (2, None, big), (3, "u\r\nX: y", big), (4, "u", "small"), (5, "u", "small"), (6, "u", "x" * 999), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 100)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, h in rows:
        full = (h or "").encode()
        assert got[i].payload_digest == hashlib.sha1(full).hexdigest() and got[i].payload_bytes == len(full)
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 3) if i == 2 else ("response", None))
        assert bytes(got[i].payload) == (b"" if i == 2 else full)
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_monolithic_gzip_becomes_members():
    import gzip

    records = [warc.record_bytes(i, "u", "response", bytes(range(256)) * (i * 37), 0, "d", None) for i in range(1, 60)]
    for whole in (gzip.compress(b"".join(records)), b"".join(gzip.compress(x) for x in records)):
        members, index = warc.normalise(whole)
        assert [zlib.decompress(members[a : a + n], 31) for a, n, _ in index] == records
    with pytest.raises(ValueError, match="inside"):
        warc.normalise(gzip.compress(records[0][:-5]))


def _auc(p, y):
    order = np.argsort(np.argsort(p, kind="stable"))
    return (order[y == 1].mean() - (y.sum() - 1) / 2) / max(1, (y == 0).sum())


def test_classifiers_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    quality = quality_model.query(spark, sf).toPandas().merge(labels, on="doc_id")
    held = quality[quality.held_out]
    assert _auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97 and (held.predicted == held.quality).mean() > 0.93
    toxic = toxicity.query(spark, sf).toPandas().merge(labels, on="doc_id")
    held = toxic[toxic.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9 and held[held.toxic == 0].predicted.mean() < 0.02
    assert quality.score.between(0, 1).all() and toxic.score.between(0, 1).all()


def test_classifiers_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for module, name in ((quality_model, "quality"), (toxicity, "toxic")):
        model = module.fit(odd(spark), labels, name)
        rows = module.score(odd(spark), model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert module.score(odd(spark).limit(0), module.fit(odd(spark).limit(0), labels.limit(0), name)).count() == 0


def test_grammar_scores_clauses():
    g = toxicity.Grammar()
    score = lambda t: g.features(pa.array([t], pa.large_string()))[0, -1]
    assert score("you are an idiot.") > 10 * score("the movie was about a clown.") > 0
    assert score("you are an idiot.") > score("he said you are an idiot.") > score("he said you are not an idiot.")
    assert score("an idiot, you.") == score("you idiot.") > score("you saw in the street below our house an idiot.")
    assert score("I will kill you.") > 10 * score("kill the lights in the hall before you go.") > 0
    assert score("a calm sentence.") == score("") == 0
    assert (g.probability(g.features(pa.array(["idiot", "kill", "x"], pa.large_string()))) < 0.1).all()


def test_machine_equals_its_parts():
    """The composed machine says, symbol by symbol, what the five transducers say apart."""
    parts = [f() for f in (toxicity.insults, toxicity.threats, toxicity.targets, toxicity.negations, toxicity.reports)]
    g, r = toxicity.Grammar(), np.random.default_rng(0)
    for _ in range(500):
        symbols, want = r.choice(6, int(r.integers(1, 30)), p=[0.4, 0.15, 0.1, 0.15, 0.1, 0.1]).tolist(), collections.Counter()
        for t in parts:
            q = 0
            for s in symbols:
                q, label = t.get((q, s), (q, None))
                want[label] += label is not None
        assert g.path(symbols).tolist() == [want[i] for i in range(len(toxicity.LABELS))]


def test_gaps_equal_brute_force():
    """An insult is aimed if a target stands at most GAP words before it or, nothing aimed in between, after it."""
    g, r = toxicity.Grammar(), np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(2, 14))
        a, b = r.choice(n, 2, replace=False).tolist()
        symbols = [toxicity.OTHER] * n
        symbols[a], symbols[b] = toxicity.INSULT, toxicity.TARGET
        assert g.path(symbols)[toxicity.AIMED] == (abs(a - b) <= toxicity.GAP)


def test_stems_stand_for_words():
    g = toxicity.Grammar({"bomen*": 30.0, "fool": 30.0})
    symbols = g.symbols_of(pa.array(["bomenteca,", "bomen", "bome", "fool!", "fools", "you"], pa.large_string())).tolist()
    assert symbols == [toxicity.INSULT, toxicity.INSULT, toxicity.OTHER, toxicity.INSULT, toxicity.OTHER, toxicity.TARGET]


def test_words_and_stems_are_learned(spark):
    rows = [(f"calm words here {i} achtung{i} mostly" + (f" bomente{i} you" if i % 4 == 0 else " bright"), int(i % 4 == 0)) for i in range(80)]
    found = toxicity.learn_insults(spark.createDataFrame(rows, "text string, label int"))
    assert {"bome*", "bomen*", "bomente*"} <= set(found) and not any(w.startswith("acht") or w in ("bright", "mostly", "calm") for w in found)
    assert toxicity.learn_insults(spark.createDataFrame(rows, "text string, label int").where("label = 0")) == {}


def test_weights_are_learned():
    x, y = np.zeros((200, 6)), np.arange(200) % 2
    x[:, toxicity.BARE] = y * np.log(2)
    w = toxicity.fit_weights(x, y.astype(float))
    assert w[toxicity.BARE] > 3 > toxicity.PRIOR[toxicity.BARE] and w[toxicity.AIMED] == toxicity.PRIOR[toxicity.AIMED]
    assert toxicity.fit_weights(x, np.zeros(200)).tolist() == [*toxicity.PRIOR, toxicity.PRIOR_BIAS]


def test_language_model(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).select("doc_id", "text").collect()] + [(90_001, None), (90_002, "")]
    got = {r.doc_id: r for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in rows}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 10 == 0}
    c = collections.Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ws), sum(c[w] > 0 for w in ws), n, i in held)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert language_model.score(empty).count() == 0
    assert language_model.score(odd(spark)).count() == len(ODD)


def test_language_model_sums_to_one_and_beats_the_unigram(spark):
    """Over known words, assumed unseen ones and the end, in contexts with and without embeddings; and on held-out units."""
    training = docs(spark).select("text")
    m = language_model.fit(training, language_model.count_words(training))
    units, scorer = m["units"], language_model.Scorer(m["units"], m["p"])
    counts = {r.word: (r.c, r.tail) for r in language_model.count_words(training).collect()}
    for before, far in ((units.start, units.start), (0, 1), (units.end - 1, 3)):
        p = 10 ** scorer.log10(np.full(units.n, before), np.full(units.n, far), np.arange(units.n))
        total, tails = p[: len(units.words)].sum() + p[units.end], p[len(units.words) : units.end]
        inside = np.zeros(units.tails)
        for w, (c, t) in counts.items():
            if units.of(pa.array([w], pa.large_string()))[0] >= len(units.words):
                inside[t % units.tails] += c - language_model.DISCOUNT
        unseen = (language_model.DISCOUNT * m["kinds"] + language_model.ADD) / (language_model.UNSEEN * m["kinds"] + 1)
        inside += unseen * (language_model.UNSEEN * m["kinds"] + 1)
        assert math.isclose(total + (tails * inside / (m["mass"] + language_model.ADD)).sum(), 1, rel_tol=1e-5)
    texts = pa.array([r.text for r in docs(spark).collect()], pa.large_string())
    before, far, token, _ = language_model.transitions(units, *arrow_words.split_words(texts))
    plain = language_model.Scorer(units, language_model.initial(units))
    assert scorer.log10(before, far, token).mean() > plain.log10(before, far, token).mean() + 0.02


def test_language_model_units_grow_and_ties(spark):
    counts = spark.createDataFrame([(w, 1, 5) for w in "fedcba"] + [("x", 2, 1)], "word string, tail int, c long")
    assert [r.word for r in language_model.most_frequent(counts, 3).collect()] == ["a", "b", "c"]
    assert language_model.most_frequent(counts, 6).count() == 6 and language_model.most_frequent(counts.limit(0), 6).count() == 0
    one, two = (language_model.fit(spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),)], "text string"), language_model.count_words(spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),)], "text string")))["units"].n for n in (300, 3000))
    assert two > 2 * one


def test_nce_learns_a_pattern():
    """Alternating words: what follows what becomes far likelier than its share."""
    units = language_model.Units(list("abcd"), np.array([500.0] * 4), np.zeros(16), 1)
    t, cycle = language_model.Trainer(units, 0), np.arange(4097) % 4
    for _ in range(60):
        t.step(cycle[1:-1], cycle[:-2], cycle[2:])
    p = 10 ** language_model.Scorer(units, t.p).log10(np.array([0, 0]), np.array([3, 3]), np.array([1, 2]))
    assert p[0] > 0.7 > 0.1 > p[1]


def test_pipeline(spark):
    import corpus_pipeline as p

    rows = p.run(spark, SF).collect()
    table = docs(spark)
    for name, stage in p.STAGES[:-1]:
        before, table = table, p.materialize(stage(spark, table, SF))
        assert table.columns == before.columns, name
    tokenizer, at = Tokenizer.from_file(token_ids.tokenizer_file()), 0
    want = []
    for r in table.orderBy("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert sorted(map(tuple, rows)) == sorted(want)


def test_special_tokens_as_the_library_encodes_them():
    path = token_ids.tokenizer_file()
    texts = ["x <|endoftext|> a", "<|endoftext|>", "a<|endoftext|>b. <|endoftext|>, c", "plain words", "  <|endoftext|>\n<|endoftext|> x"]
    plain, e = Tokenizer.from_file(path), token_ids.PieceEncoder(path)
    ids, _ = e.encode(texts)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in [*w, token_ids.END_ID]]


CLASH = [*quality_rules.MEASURES, "failures", "size", "source_size", "target", "reps", "_row", "_key", "_bucket", "_s", "_doc", "_gone", "_text", "_at", "_w", "_l", "_h", "text_key", "n_shingles", "component_id", "kept", "node", "set_a", "word", "start", "part", "held_out", "score", "label", "item_id", "page_id", "url", "html"]
LONG = " ".join(f"word{i % 977} tale{i % 1013}" for i in range(1_000_000))


def clashing(spark):
    """Odd rows, ordinary documents and a text of 20 MB, with a column of every name that the operators use."""
    ordinary = [(100 + r.doc_id, r.text) for r in docs(spark).select("doc_id", "text").limit(60).collect()]
    rows = odd(spark, [*ODD, *ordinary, (9_000, LONG), (9_001, LONG)])
    return rows.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own {c}").alias(c) for c in CLASH])


@pytest.mark.parametrize("i", range(4))
def test_stages_pass_clashing_columns(spark, i):
    import corpus_pipeline as p

    table = clashing(spark).cache()
    name, stage = p.STAGES[i]
    out = stage(spark, table, SF)
    assert out.columns == table.columns, name
    got = out.collect()
    assert got and all(r[c] == f"own {c}" for r in got for c in CLASH)
    assert stage(spark, table.limit(0), SF).count() == 0
    before = collections.Counter((r.doc_id, r.text) for r in table.collect())
    after = collections.Counter((r.doc_id, r.text) for r in got)
    assert set(after) <= set(before)
    if name == "near_dedup":
        assert 9_001 not in {d for d, _ in after} and 9_000 in {d for d, _ in after} and after[None, "a b c d e f g"] == 1


def test_last_stage_on_clashing_columns(spark):
    import corpus_pipeline as p

    table = clashing(spark)
    got = p.write_token_ids(spark, table, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == table.count()
    assert p.write_token_ids(spark, table.limit(0), SF).count() == 0


def test_operators_on_clashing_columns(spark):
    table = clashing(spark).withColumn("text", F.substring("text", 1, 200_000))
    n, labels = table.count(), spark.createDataFrame([(100 + i, i % 2, i % 2, "x") for i in range(1, 40)], "doc_id long, quality int, toxic int, text string")
    ledger = quality_rules.ledger(table)
    assert ledger.count() == n and {r.source_size for r in ledger.collect()} == {"own source_size"}
    mixed = mixing.mix(table)
    assert mixed.count() == n and {r._key for r in mixed.collect()} == {"own _key"} and dict(mixed.dtypes)["size"] == "bigint"
    assert minhash.judge(table).count() == n and language_model.score(table).count() == n
    for module, name in ((quality_model, "quality"), (toxicity, "toxic")):
        assert module.score(table, module.fit(table, labels, name)).count() == n
    leaks = decontaminate.find_leaks(table, docs(spark).limit(3).select(F.col("doc_id").alias("item_id"), "text", F.lit(1).alias("doc_id")))
    assert leaks.columns == ["doc_id", "item_id", "at_word", "n_words", "distance"]
    pages = spark.createDataFrame([(1, "u", "x" * 2000, 5, "k"), (2, "v", "x" * 2000, 6, None), (None, None, None, None, None)], "page_id long, url string, html string, digest long, kind string")
    assert sorted((str(r.page_id), r.record_type) for r in warc.round_trip(pages).collect()) == [("1", "revisit"), ("2", "response"), ("None", "response")]


def test_taken_words_equal_brute_force(spark):
    """Within a source, in the order of the seeded hash, documents fill the fraction of its target; whole rounds are whole."""
    rows = mixing.mix(docs(spark)).select("doc_id", "source", "size", "source_size", "target", "reps", F.conv(F.substring(F.md5(F.concat(F.lit(f"{mixing.SEED}\u001f"), F.col("doc_id").cast("string"), F.lit("\u001f"), F.coalesce("text", F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long").alias("key")).collect()
    for source in {r.source for r in rows}:
        own = sorted((r for r in rows if r.source == source), key=lambda r: (r.key, r.doc_id))
        whole = int(own[0].target // own[0].source_size)
        left, run = own[0].target - whole * own[0].source_size, 0
        for r in own:
            run += r["size"]
            taken = left > 0 and run - r["size"] / 2 <= left
            assert r["size"] * r.reps == r["size"] * min(2, whole + taken), (source, r.doc_id)
