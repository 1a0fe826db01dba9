"""Benchmark decontamination: CGK random walks, bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items are sequences of words (A-Z lower-cased, punctuation at word edges left out). An item of n words has
leaked into a text that holds a passage within k = n // 5 word edits of it.

1. Windows of n words of a text, for every length n of an item. Of k + 1 pieces of an item, k edits leave one whole, so
   windows that hold no piece of any item of their length where that item would have it can't match: they are passed
   over. This filter loses nothing; it says that a window is worth embedding, not which item it may be.
2. The Cormode-Ganesh-Kuszmaul walk copies the window's current word to the output and steps ahead by a random bit of
   word and time: few edits become few differences of position. Each of REPEATS walks samples DRAWS of the first
   STRETCH n positions, where walks still read words; a walk's sample is a bucket. A window and an item of its length
   that meet in a bucket are a candidate pair, whatever piece led to the window; nothing else makes candidates. Samples
   of a walk that has left the window, or read a word that no item has, are no bucket. At k edits the share of passages
   that meet their item is over nine in ten for each kind of edit; the tests measure it.
3. Sellers' alignment of the item against the window with k words more on either side gives the exact edit distance.

Items are broadcast in blocks of at most BLOCK_WORDS words (or one longer item); a larger benchmark takes several
passes over the texts. Items and windows are worked on by length, without padding. Only matches leave the tasks: no
shuffle of texts, pairs or windows.

Defined cases: null and empty texts or items match nothing; a null item_id stays null; repeated rows give repeated
matches; an empty table gives none; very long texts are searched whole; of equally near places of an item the first
counts; ``clean`` judges the rows of one doc_id together, and extra columns pass through it whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_words import hash_words, mix, pieces, split_words
from .common import read, without_ids, words

EDIT_SHARE, REPEATS, DRAWS, STRETCH, SEED = 5, 64, 3, 1.6, 7
#: Words of items that are broadcast at once, and words of windows that are embedded or aligned at once.
BLOCK_WORDS, WINDOW_WORDS = 2_000_000, 1 << 15
PUNCTUATION = ".,;:!?\"'()[]"
MATCH = "doc_id long, item_id long, at_word long, n_words int, distance int"


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, and the bounds of each text's words; words of punctuation alone stay."""
    distinct, index, bounds = _distinct(texts)
    return hash_words(distinct)[index] if len(index) else np.zeros(0, np.uint64), bounds


def _distinct(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    distinct, index, bounds = split_words(texts)
    bare = pc.utf8_trim(distinct, PUNCTUATION)
    return pc.if_else(pc.equal(pc.binary_length(bare), 0), distinct, bare), index, bounds


class Items:
    """Benchmark items as sequences of numbered words, their pieces, and the buckets of their embeddings."""

    def __init__(self, ids: list[int | None], texts: list[str | None]) -> None:
        flat, bounds = symbols(pa.array(texts, pa.large_string()))
        self.vocabulary, numbers = np.unique(flat, return_inverse=True)
        rows = [(i, numbers[a:b].astype(np.int32) + 1) for i, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True) if b > a]
        self.ids, self.words = [i for i, _ in rows], [w for _, w in rows]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.k = self.n // EDIT_SHARE
        found = defaultdict(set)
        for n, w in zip(self.n.tolist(), self.words, strict=True):
            parts = n // EDIT_SHARE + 1
            size = n // parts
            for p in range(parts):
                found[size].add((_sequence(w[p * size : (p + 1) * size]), n, p * size))
        #: by piece size: sorted hashes, and the lengths of the items and the places in them that the pieces have
        self.pieces = {size: tuple(np.array(x, t) for x, t in zip(zip(*sorted(f), strict=True), (np.uint64, np.int64, np.int64), strict=True)) for size, f in found.items()}
        self.draw = np.random.default_rng(SEED).random((REPEATS, DRAWS))
        buckets, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n in np.unique(self.n).tolist():
            own = np.flatnonzero(self.n == n)
            for at in range(0, len(own), max(1, WINDOW_WORDS // n)):
                part = own[at : at + max(1, WINDOW_WORDS // n)]
                item, key = self.embed(np.stack([self.words[i] for i in part]))
                buckets.append(key)
                owners.append(part[item])
        self.buckets, self.owners = np.concatenate(buckets), np.concatenate(owners)
        order = np.argsort(self.buckets, kind="stable")
        self.buckets, self.owners = self.buckets[order], self.owners[order]

    def embed(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, bucket) of windows of one length, rows of numbered words; 0 is a word of no item, -1 none at all."""
        count, n = windows.shape
        rows = np.arange(count)[:, None]
        padded = np.concatenate([windows, np.full((count, 1), -1, windows.dtype)], 1)
        wanted = (self.draw * (STRETCH * n)).astype(np.int64)
        at, walks = np.zeros((count, REPEATS), np.int64), np.arange(REPEATS, dtype=np.uint64)
        key, whole = np.broadcast_to(mix(walks + np.uint64(n * REPEATS)), (count, REPEATS)).copy(), np.ones((count, REPEATS), bool)
        for j in range(int(wanted.max()) + 1):
            symbol = padded[rows, np.minimum(at, n)]
            for walk, draw in zip(*np.nonzero(wanted == j), strict=True):
                read = symbol[:, walk]
                key[:, walk] += mix(read.astype(np.uint64) * np.uint64(DRAWS) + np.uint64(draw + 1))
                whole[:, walk] &= read > 0
            step = mix(walks * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)) | np.uint64(1)
            at += (((symbol + 2).astype(np.uint64) * step) >> np.uint64(63)).astype(np.int64)
        window, walk = np.nonzero(whole)
        return window, mix(key[window, walk])

    def candidates(self, windows: np.ndarray) -> np.ndarray:
        """Distinct (window, item) that share a bucket, of windows of one length."""
        window, key = self.embed(windows)
        low, high = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
        count = high - low
        item = self.owners[np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)]
        return np.unique(np.stack([np.repeat(window, count), item], 1), axis=0)

    def windows(self, number: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(length, text, start) of the windows that hold a piece in its place; start is a place in number."""
        found = []
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for size, (keys, lengths, places) in self.pieces.items():
            if len(number) < size:
                continue
            known = number > 0
            whole = known[: len(number) - size + 1].copy()
            for i in range(1, size):
                whole &= known[i : len(number) - size + 1 + i]
            whole &= text[: len(number) - size + 1] == text[size - 1 :]
            at = np.flatnonzero(whole)
            total = np.zeros(len(at), np.uint64)
            for i in range(size):
                total = total * _FACTOR + number[at + i].astype(np.uint64)
            key = mix(total)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            hit = np.flatnonzero(high > low)
            count = (high - low)[hit]
            piece = np.arange(count.sum()) + np.repeat(low[hit] - (np.cumsum(count) - count), count)
            at = np.repeat(at[hit], count)
            found.append(np.stack([lengths[piece], text[at], at - places[piece]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def matches(self, number: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(text, item, first word, distance) of the best place of each item in each text."""
        number, out = number.astype(np.int32), [np.zeros((0, 4), np.int64)]
        windows = self.windows(number, bounds)
        for n in np.unique(windows[:, 0]).tolist():
            own, k, most = windows[windows[:, 0] == n, 1:], n // EDIT_SHARE, max(1, WINDOW_WORDS // n)
            for i in range(0, len(own), most):
                text, start = own[i : i + most].T
                window, item = self.candidates(_take(number, start, n, bounds[text], bounds[text + 1])).T
                for c in range(0, len(item), most):
                    w, it = window[c : c + most], item[c : c + most]
                    # the passage may reach k words past the ends of its window, but not past the text's
                    wide = _take(number, start[w] - k, n + 2 * k, bounds[text[w]], bounds[text[w] + 1])
                    distance = edit_distances(np.stack([self.words[x] for x in it]), np.full(len(it), n), wide)
                    out.append(np.stack([text[w], it, np.maximum(start[w] - bounds[text[w]], 0), distance], 1)[distance <= k])
        rows = np.concatenate(out)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 3], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        return rows[first]


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _sequence(w: np.ndarray) -> int:
    total = np.zeros(1, np.uint64)
    for x in w:
        total = total * _FACTOR + np.uint64(x)
    return int(mix(total)[0])


def _take(number: np.ndarray, start: np.ndarray, n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows of n words from start on; -1 where a row leaves its text."""
    at = start[:, None] + np.arange(n)
    inside = (at >= low[:, None]) & (at < high[:, None])
    return np.where(inside, number[np.clip(at, 0, max(0, len(number) - 1))], -1)


def edit_distances(items: np.ndarray, n: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """The least edit distance of each item (its first n words) to any passage of its region, for many at once."""
    steps = np.arange(regions.shape[1] + 1)
    row = np.zeros((len(items), regions.shape[1] + 1), np.int64)
    best = np.zeros(len(items), np.int64)
    for i in range(int(n.max(initial=0))):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (regions != items[:, i : i + 1]))
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        best = np.where(n == i + 1, row.min(1), best)
    return best


_ITEMS: dict[bytes, Items] = {}


def _items(packed: bytes) -> Items:
    """The items of a broadcast block; one block is kept in a worker."""
    if packed not in _ITEMS:
        import pickle

        _ITEMS.clear()
        _ITEMS[packed] = Items(*pickle.loads(packed))
    return _ITEMS[packed]


def number_words(items: Items, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The items' number of every word of texts, 0 for words that no item has, and each text's bounds."""
    distinct, index, bounds = _distinct(texts)
    return (look_up(items.vocabulary, hash_words(distinct))[index] if len(index) else np.zeros(0, np.int64)), bounds


def look_up(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """1 + the place of each key in sorted_keys, 0 where it isn't there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at + 1, 0)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, at_word, n_words, distance: every item of benchmark (item_id, text) in every text of docs
    (doc_id, text) that holds it, at its best place."""
    import pickle

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.size(words(F.col("text")))), F.lit(0))).first()[0]
    blocks, out = max(1, -(-total // BLOCK_WORDS)), None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # a block of the query set
        packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(([r[0] for r in rows], [r[1] for r in rows])))

        def search(batches: Iterator[pa.RecordBatch], packed=packed) -> Iterator[pa.RecordBatch]:
            items = _items(packed.value)
            for batch in pieces(batches):
                yield _leaks(items, batch)

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, MATCH)
        out = found if out is None else out.union(found)
    return out


def _leaks(items: Items, batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = items.matches(*number_words(items, batch.column(1))) if items.ids else np.zeros((0, 4), np.int64)
    ids = pa.array(items.ids, pa.int64())
    columns = [batch.column(0).take(pa.array(rows[:, 0])), ids.take(pa.array(rows[:, 1])), pa.array(rows[:, 2]), pa.array(items.n[rows[:, 1]].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "at_word", "n_words", "distance"])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no item has leaked, with all their columns. A null doc_id can't be told apart and stays."""
    return without_ids(docs, find_leaks(docs, benchmark).select("doc_id").distinct())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
