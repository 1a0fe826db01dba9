"""Token ids of documents in binary files, packed with Simple-8b.

Documents are dealt to tasks by ranges of doc_id, and of the texts' hashes where ids are equal, and sorted there; each
task encodes whole texts with a tokenizers file and writes shards of whole documents. A 64-bit word holds a selector in its top four bits and as many ids as
the selector's width admits; ids of over 60 bits follow an escape word as raw words. Ids are packed in blocks of 256
that start on a word of their own; the block offsets in a shard's head let a reader decode any block, all at once.

A shard: ``S8B1``, u32 block size, u64 documents, ids, words; i64 doc_id and u8 is-not-null for each document, u64
ids for each document, u64 word offset for each block and the end, then the words; all little-endian.

Encoding: byte-level BPE never merges across a space between two visible characters, nor between a letter and closing
punctuation, so texts are cut there and the tokenizer sees each distinct piece once while it stays in a bounded memo
of the worker; the ids are those of the whole text.

Memory of a worker: BATCH_BYTES of text at a time, a memo of MEMO_PIECES pieces and MEMO_IDS ids, a shard of SHARD_IDS
ids or one larger document.

Defined cases: null and empty texts have the end id alone; a null doc_id sorts first; documents of one doc_id stand in
the order of their texts' hashes; repeated rows are documents of their own; an empty table writes nothing and gives no
rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow_words import pieces as slices
from .common import materialize, read, shared_dir
from .files import read_file, write_file

BLOCK = 256
#: Ids per word and bits per id by selector (fixed values of the format); selector 0 announces a raw word.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SHARD_IDS, MEMO_PIECES, MEMO_IDS, BATCH_BYTES, END_ID = 2_000_000, 2_000_000, 8_000_000, 4 << 20, 0
_PAD, _MAGIC, _HEAD = 120, b"S8B1", struct.Struct("<4sIQQQ")
_CLASS_OF_BITS = np.array([next((s for s in range(1, 16) if WIDTHS[s] >= b), 16) for b in range(65)], np.uint8)
_CLASS_OF_SMALL = _CLASS_OF_BITS[np.array([v.bit_length() for v in range(1 << 16)])]


def _classes(ids: np.ndarray) -> np.ndarray:
    """The narrowest selector that holds each id; 16 for those that need an escape."""
    if not len(ids) or ids.max() < 1 << 16:
        return _CLASS_OF_SMALL[ids.astype(np.intp)]
    return (np.searchsorted(np.left_shift(np.uint64(1), WIDTHS[1:].astype(np.uint64)), ids, side="right") + 1).astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids (unsigned 64-bit) -> words and the word offset of each block, with the end."""
    n_blocks = -(-len(ids) // BLOCK)
    words, offsets = [], [np.zeros(1, np.uint64)]
    done = 0
    for at in range(0, n_blocks, 512):
        w, per_block = _pack_blocks(ids[at * BLOCK : (at + 512) * BLOCK])
        words.append(w)
        offsets.append(np.cumsum(per_block).astype(np.uint64) + np.uint64(done))
        done += len(w)
    return (np.concatenate(words) if words else np.zeros(0, np.uint64)), np.concatenate(offsets)


def _pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = -(-len(ids) // BLOCK)
    value = np.zeros((n, BLOCK + _PAD), np.uint64)
    wide = np.zeros((n, BLOCK + _PAD), np.uint8)
    lens = np.full(n, BLOCK)
    lens[-1] = len(ids) - (n - 1) * BLOCK
    full = np.zeros(n * BLOCK, np.uint64)
    full[: len(ids)] = ids
    value[:, :BLOCK] = full.reshape(n, BLOCK)
    classes = np.zeros(n * BLOCK, np.uint8)
    classes[: len(ids)] = _classes(ids)
    wide[:, :BLOCK] = classes.reshape(n, BLOCK)
    reach = {1: wide}  # the widest class among the next k ids
    choice = np.where(wide > 15, 0, 15).astype(np.uint8)
    for s in range(14, 0, -1):  # from the fewest ids in a word to the most; what no k ids fit, more don't either
        fits = _reach(reach, int(COUNTS[s])) <= s
        if not fits[:, :BLOCK].any():
            break
        choice = np.where(fits, np.uint8(s), choice)
    pos, live = np.zeros(n, np.intp), np.arange(n)
    blocks, places, selectors = [], [], []
    flat_choice, stride = choice.ravel(), BLOCK + _PAD
    while len(live):
        s = flat_choice[live * stride + pos[live]]
        blocks.append(live)
        places.append(pos[live])
        selectors.append(s)
        pos[live] += COUNTS[s]
        live = live[pos[live] < lens[live]]
    block = np.concatenate(blocks)
    order = np.argsort(block, kind="stable")
    block, s = block[order], np.concatenate(selectors)[order]
    start = block * stride + np.concatenate(places)[order]
    size = 1 + (s == 0)
    out_at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    flat = value.ravel()
    out[out_at] = s.astype(np.uint64) << np.uint64(60)
    for k in np.unique(s):
        rows = np.flatnonzero(s == k)
        if k == 0:
            out[out_at[rows] + 1] = flat[start[rows]]
        elif k > 1:
            word = np.zeros(len(rows), np.uint64)
            for i in range(int(COUNTS[k])):
                word |= flat[np.minimum(start[rows] + i, len(flat) - 1)] << np.uint64(i * WIDTHS[k])
            out[out_at[rows]] |= word
    return out, np.bincount(block, weights=size, minlength=n).astype(np.int64)


def _reach(known: dict[int, np.ndarray], k: int) -> np.ndarray:
    """The widest class among k ids from each on, from those of fewer ids."""
    out, covered = None, 0
    while covered < k:
        part = max(x for x in known if x <= k - covered)
        ahead = _ahead(known[part], covered) if covered else known[part]
        out = ahead if out is None else np.maximum(out, ahead)
        covered += part
    known[k] = out
    return out


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[:, :-by] = x[:, by:]
    return out


def unpack(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks; offsets: the word offset of each block and the end, n_ids: ids in all of them."""
    n = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64)
    s = (words >> np.uint64(60)).astype(np.intp)
    count = COUNTS[s].copy()
    block = np.repeat(np.arange(n), np.diff(offsets.astype(np.int64)))
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(s == 0):
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    count[raw] = 0
    ends = np.cumsum(count)
    first = offsets[:-1].astype(np.int64)
    place = ends - count - (ends[first] - count[first])[block]
    out = np.zeros(n * (BLOCK + _PAD), np.uint64)
    start = block * (BLOCK + _PAD) + place
    for k in np.unique(s[~raw]):
        rows = np.flatnonzero((s == k) & ~raw)
        if k == 0:
            out[start[rows]] = words[rows + 1]
        elif k > 1:
            mask = np.uint64((1 << int(WIDTHS[k])) - 1)
            for i in range(int(COUNTS[k])):
                out[start[rows] + i] = (words[rows] >> np.uint64(i * WIDTHS[k])) & mask
    return out.reshape(n, -1)[:, :BLOCK].ravel()[:n_ids]


def shard_bytes(doc_ids: list[int | None], n_tokens: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = pack(ids.astype(np.uint64))
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    head = _HEAD.pack(_MAGIC, BLOCK, len(doc_ids), len(ids), len(words))
    return b"".join([head, keys.tobytes(), valid.tobytes(), n_tokens.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_shard(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids per document and all ids of a shard."""
    magic, block, docs, n_ids, n_words = _HEAD.unpack_from(data)
    if magic != _MAGIC or block != BLOCK:
        raise ValueError("not a shard of this format")
    at, parts = _HEAD.size, []
    for kind, n in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", -(-n_ids // block) + 1), ("<u8", n_words)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    keys, valid, n_tokens, offsets, words = parts
    return [int(k) if v else None for k, v in zip(keys, valid, strict=True)], n_tokens.astype(np.int64), unpack(words, offsets, n_ids)


_Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _table() -> _Table:
    return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)


def _merged(one: _Table, two: _Table) -> _Table:
    both = [np.concatenate(x) for x in zip(one, two, strict=True)]
    order = np.argsort(both[0], kind="stable")
    return tuple(x[order] for x in both)


class PieceEncoder:
    """Whole texts to ids through a tokenizers file of byte-level BPE, with a bounded memo of pieces.

    Texts are cut at single spaces. Arrow finds the distinct pieces of a batch; the memo holds their ids by a 128-bit
    fingerprint in two sorted tables, of which the small one takes the new pieces and now and then goes into the large.
    A piece with white space at an edge must not be cut off, so texts that have one are encoded as they stand, as is the
    first piece of every text, which follows no space.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.large, self.small = _table(), _table()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 1
        self.flat[0] = END_ID

    def _append(self, ids: np.ndarray) -> int:
        at = self.used
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct pieces begin, and how many there are; -1: not to be cut off."""
        key, check = (hash_array(found, hash_key=k, categorize=False) for k in ("lodestream-key-1", "lodestream-key-2"))
        starts, lens, known = np.zeros(len(key), np.int64), np.zeros(len(key), np.int32), np.zeros(len(key), bool)
        for keys, checks, at_starts, at_lens in (self.large, self.small):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                here = (keys[at] == key) & (checks[at] == check)
                starts[here], lens[here] = at_starts[at[here]], at_lens[at[here]]
                known |= here
        new = np.flatnonzero(~known)
        if len(new):
            starts[new], lens[new] = self._encode(found[new].tolist())
            self.small = _merged(self.small, (key[new], check[new], starts[new], lens[new]))
            if 8 * len(self.small[0]) > len(self.large[0]):
                self.large, self.small = _merged(self.large, self.small), _table()
        return starts, lens

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes pieces that each follow a space, many to a text, and cuts the ids by their bytes."""
        bases = [p.rstrip(".,!?") for p in pieces]
        # closing punctuation after a letter is a token run of its own
        bases = [b if b != p and b[-1:].isalpha() else p for b, p in zip(bases, pieces, strict=True)]
        dirty = np.fromiter((p.strip() != p or not p for p in pieces), bool, len(pieces))
        at: dict[str, int] = {}
        base = np.fromiter((at.setdefault("x" if d else b, len(at)) for b, d in zip(bases, dirty, strict=True)), np.int64, len(pieces))
        ends_at: dict[str, int] = {"": 0}
        tail = np.fromiter((ends_at.setdefault(p[len(b) :], len(ends_at)) for p, b in zip(pieces, bases, strict=True)), np.int64, len(pieces))
        names = list(at)
        texts = [" " + " ".join(names[i : i + 64]) for i in range(0, len(names), 64)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        raw = np.frombuffer("".join(texts).encode("utf-8"), np.uint8)
        want = np.append(np.flatnonzero(raw == 32)[1:], len(raw))
        have = np.cumsum(self.token_bytes[ids])
        cut = np.searchsorted(have, want)
        if cut[-1] != len(ids) - 1 or (have[cut] != want).any():
            raise AssertionError("the tokenizer merged across a space")
        tails = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(list(ends_at), add_special_tokens=False)]
        offsets = np.concatenate([[0], cut + 1, len(ids) + np.cumsum([len(x) for x in tails])]).astype(np.int64)
        sizes, both, n = np.diff(offsets), np.concatenate([ids, *tails]), len(names)
        lens = np.stack([sizes[base], sizes[n + tail]], 1)
        lens[dirty] = 0
        begin = self._append(both[_ragged(np.stack([offsets[base], offsets[n + tail]], 1).ravel(), lens.ravel())])
        each = lens.sum(1)
        return begin + np.cumsum(each) - each, np.where(dirty, -1, each).astype(np.int32)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by END_ID, and how many each text has."""
        if len(self.large[0]) + len(self.small[0]) > MEMO_PIECES or self.used > MEMO_IDS:
            self.forget()
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        n = len(column)
        split = pc.split_pattern(pc.fill_null(column, ""), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        pieces, piece = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        starts, lens = self._look_up(pieces)
        counts = np.diff(bounds)
        begin, size = starts[piece], lens[piece].astype(np.int64)
        heads = pieces[piece[bounds[:-1]]]
        inner = size.copy()
        inner[bounds[:-1]] = 0
        alone = np.flatnonzero(np.minimum.reduceat(inner, bounds[:-1]) < 0) if n else []
        whole = heads.copy()
        whole[np.fromiter((h != "" and h[-1].isspace() for h in heads), bool, n) & (counts > 1)] = None
        for i in {*alone, *np.flatnonzero(whole == None)}:  # noqa: E711
            whole[i] = column[int(i)].as_py()
            size[bounds[i] : bounds[i + 1]] = 0
        got = [e.ids for e in self.tokenizer.encode_batch_fast(whole.tolist(), add_special_tokens=False)]
        first = np.fromiter(map(len, got), np.int64, n)
        # these ids are not kept: they stand behind the memo's for this batch alone
        kept = self.used
        at = self._append(np.fromiter((x for ids in got for x in ids), np.int32))
        begin[bounds[:-1]], size[bounds[:-1]] = at + np.cumsum(first) - first, first
        place = np.arange(len(piece)) + np.repeat(np.arange(n), counts)
        all_begin, all_size = np.zeros(len(piece) + n, np.int64), np.ones(len(piece) + n, np.int64)  # END_ID is at 0
        all_begin[place], all_size[place] = begin, size
        ids = self.flat[_ragged(all_begin, all_size)]
        self.used = kept
        return ids, np.add.reduceat(all_size, bounds[:-1] + np.arange(n)) if n else np.zeros(0, np.int64)


def _ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1 ... of runs one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a file; a task has one core, so the library gets no threads of its own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


_MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def write_ids(docs: DataFrame, base: str, tokenizer_path: str) -> DataFrame:
    """Writes the ids of docs (doc_id, text) under the folder base, in ascending doc_id order, and returns the written
    shards with the number of ids before each: part, seq, path, n_docs, n_ids, start."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encoder = TaskContext.get(), _encoder(tokenizer_path)
        doc_ids, counts, ids, held, rows = [], [], [], 0, []

        def flush() -> None:
            nonlocal doc_ids, counts, ids, held
            if doc_ids:
                path = f"{base}/{task.partitionId():06d}-{len(rows):06d}.s8b"
                n_tokens, flat = np.concatenate(counts), np.concatenate(ids)
                write_file(path, shard_bytes(doc_ids, n_tokens, flat), str(task.taskAttemptId()))
                rows.append((task.partitionId(), len(rows), path, len(doc_ids), len(flat)))
            doc_ids, counts, ids, held = [], [], [], 0

        for part in slices(batches, rows=2_000, most=BATCH_BYTES):
            got, n = encoder.encode(part.column(1))
            doc_ids += part.column(0).to_pylist()
            counts.append(n)
            ids.append(got)
            held += len(got)
            if held >= SHARD_IDS:
                flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], names=["part", "seq", "path", "n_docs", "n_ids"])

    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("key")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = materialize(ordered.select("doc_id", "text").mapInArrow(write, _MANIFEST))
    # the ids before a shard: those of the tasks before its own (one row a task), and of that task's shards before it
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", earlier(Window.orderBy("part")).alias("before"))
    return shards.join(parts, "part").withColumn("start", (F.col("before") + earlier(Window.partitionBy("part").orderBy("seq"))).cast("long")).drop("before")


def read_ids(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, n_tokens, ids = read_shard(read_file(path))
                flat, ends = ids.astype("<u4"), np.cumsum(n_tokens)
                crcs = [zlib.crc32(flat[e - n : e]) for e, n in zip(ends.tolist(), n_tokens.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + ends - n_tokens, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = materialize(shards)
    return listed.select("path", "start").repartition(max(1, min(10_000, listed.count()))).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode_and_read(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes docs to the shared folder and returns what the files hold of each document."""
    spark = docs.sparkSession
    return read_ids(write_ids(docs, shared_dir(spark), tokenizer_path or tokenizer_file()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(read(spark, sf_dir, "documents").select("doc_id", "text"))
