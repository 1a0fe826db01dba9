"""Queries over documents read whole texts: small tables against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from lodestream.operators import dedup
from lodestream.plans import queries as q

TOKEN, RUN = r"[a-z0-9]+|[一-鿿]", r"[a-z0-9]+|[一-鿿]+"
HEADER = "All rights reserved under the licence of this archive. " * 8


def _words(name, n):
    return " ".join(f"{name}{hashlib.md5(f'{name}{i}'.encode()).hexdigest()[:6]}" for i in range(n))


#: One header over unrelated bodies; one body under different openings; an exact copy; no text.
TEXTS = {1: HEADER + _words("a", 300), 2: HEADER + _words("b", 300), 3: "First seen on Monday. " * 2 + _words("c", 900), 4: "Copied by others later. " * 2 + _words("c", 900), 5: HEADER + _words("a", 300), 6: "", 7: None, 8: HEADER + "中文字 " + _words("d", 40)}


def _documents(spark, folder, texts):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def _simhash(features):
    votes = [0] * 64
    for f in features:
        h = int(hashlib.sha1(f.encode()).hexdigest()[:16], 16)
        votes = [v + (1 if h >> i & 1 else -1) for i, v in enumerate(votes)]
    return sum(1 << i for i, v in enumerate(votes) if v > 0)


def _display(text):
    runs = re.findall(RUN, text.lower())
    cjk = lambda r: r > "一"
    out = [f for r in runs for f in (([r[i : i + 2] for i in range(max(1, len(r) - 1))]) if cjk(r) else [r])]
    return out + [f"{a} {b}" for a, b in zip(runs, runs[1:], strict=False) if not cjk(a) and not cjk(b)]


def test_fingerprints_and_groups_of_whole_texts(spark, tmp_path):
    d = _documents(spark, tmp_path, TEXTS)
    stored = {k: _simhash(re.findall(TOKEN, (t or "").lower())) for k, t in TEXTS.items()}
    display = {k: _simhash(_display(t or "")) for k, t in TEXTS.items()}
    assert {r.doc_id: r.simhash % (1 << 64) for r in q.simhash_stored(spark, d).where("doc_id > 0").collect()} == stored  # the query's own Chinese rows apart
    assert {r.doc_id: r.simhash % (1 << 64) for r in q.simhash_display(spark, d).where("doc_id > 0").collect()} == display
    near = {(a, b) for a, b in combinations(stored, 2) if (stored[a] ^ stored[b]).bit_count() <= 4}
    assert near == {(1, 5), (3, 4), (6, 7)}
    assert {(r.a, r.b) for r in q.near_pairs(spark, d).collect()} == near
    assert {r.doc_id: (r.component, r.kept) for r in q.near_components(spark, d).collect()} == {1: (1, True), 2: (2, True), 3: (3, True), 4: (3, False), 5: (1, False), 6: (6, True), 7: (6, False), 8: (8, True)}


def test_cascade_judges_documents_without_vectors(spark, tmp_path):
    """Odd ids are items, even ones history; 8, 9 and 11 have vectors."""
    copy = _words("e", 200)
    d = _documents(spark, tmp_path, {1: copy, 2: copy, 3: "First opening. " + _words("f", 900), 4: "Another opening. " + _words("f", 900), 5: _words("g", 50), 8: _words("h", 50), 9: _words("i", 50), 11: copy})
    spark.createDataFrame([(8, [1.0, 0.0]), (9, [1.0, 0.1]), (11, [0.0, 1.0])], "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    got = {r.key: (r.verdict, r.via, r.cluster_id, r.cos) for r in q.cascade(spark, d).collect()}
    assert got == {
        1: ("suppressed", "dup_exact", 2, None), 3: ("suppressed", "dup_near", 4, None), 5: ("fresh", "no_vector", None, None), 9: ("gray", "judge_na", 8, 0.995),
        11: ("suppressed", "dup_exact", 2, None),
    }


def test_rare_tokens_of_whole_texts(spark, tmp_path):
    """Rarity and pairs are those of whole texts: a late token links, and one that is frequent late is not rare."""
    texts = {k: f"word{k} " * 40 + "late " * (k % 2) + "common" for k in range(1, 13)}
    texts |= {1: "common " + texts[1], 2: "common " + texts[2], 3: texts[3] + " rare1", 4: texts[4] + " rare1", 13: None}
    d = _documents(spark, tmp_path, texts)
    found = {k: set(re.findall("[a-z0-9]+", t or "")) for k, t in texts.items()}
    count = {t: sum(t in x for x in found.values()) for t in set().union(*found.values())}
    rare = {t for t, n in count.items() if 2 <= n <= min(8, max(3, len(texts) // 3))}
    want = {(a, b, len(found[a] & found[b] & rare)) for a, b in combinations(found, 2) if found[a] & found[b] & rare}
    assert want == {(3, 4, 1)}
    assert {tuple(r) for r in q.rare_token_pairs(spark, d).collect()} == want


def test_spoken_form_of_whole_texts(spark, tmp_path):
    d = _documents(spark, tmp_path, {1: "plain words " * 20 + "GPT-4 and  8-bit"})
    assert q.text_forms(spark, d).where("doc_id = 1").first().spoken == "plain words " * 20 + "GPT 4 and 8 bit"


def test_groups_of_near_fingerprints_in_few_links(spark):
    """400 fingerprints within four bits of each other make 79,800 pairs, but few links; chains and copies hold."""
    rng = random.Random(5)
    dense = [0x0123456789ABCDEF ^ 1 << i ^ 1 << j for i, j in list(combinations(range(60), 2))[:400]]
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ sum(1 << i for i in rng.sample(range(64), 4)))
    prints = dense + chain + chain[:5] + [rng.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]
    rng.shuffle(prints)
    least = list(range(len(prints)))
    near = [(a, b) for a, b in combinations(least, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    moved = True
    while moved:
        moved = False
        for a, b in near:
            m = min(least[a], least[b])
            moved, least[a], least[b] = moved or least[a] != least[b], m, m
    df = spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in enumerate(prints)] + [(999, None)], "k long, fp long")
    for together in (None, 1, 3):
        assert {r.k: r.component for r in dedup.hamming_components(df, "k", "fp", 4, together).collect()} == dict(enumerate(least))
    rows = np.array([list(range(400)), dense, [7] * 400])
    cut = [pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, at : at + 90]], names=["rep", "fp", "band"]) for at in range(0, 400, 90)]
    assert sum(b.num_rows for b in dedup._bucket_links(iter(cut), 4)) == 399
