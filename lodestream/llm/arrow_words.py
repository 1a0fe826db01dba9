"""Words of whole Arrow batches as numpy arrays: no Python object per word."""

from __future__ import annotations

import ctypes
import glob
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.arange(256, dtype=np.uint8)
_GAP[9:14] = 32
_KEY = "lodestream-words"
#: A worker takes up so much text at a time: what it makes of a batch is a small multiple of this.
PIECE_ROWS, PIECE_BYTES, RELEASE = 1_000, 2 << 20, 4
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit depends on all (murmur3's finaliser)."""
    x = (x ^ (x >> _MIX[2])) * _MIX[0]
    x = (x ^ (x >> _MIX[2])) * _MIX[1]
    return x ^ (x >> _MIX[2])


def one_thread() -> None:
    """Matrix products on the core that a task has: with threads of its own, numpy's library burns many times the CPU time
    that small products take. Does nothing where that library is another one."""
    for path in glob.glob(os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def release() -> None:
    """Gives back to the system what pieces have used: allocators keep it otherwise, and a worker lives for many tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: int = 1, rows: int = PIECE_ROWS, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows and bytes of the column numbered text; a larger row stands alone."""
    done = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
            to = min(at + rows, max(at + 1, fit))
            yield batch.slice(at, to - at)
            at, done = to, done + 1
            if done % RELEASE == 0:
                release()


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in text order, and for each text the bounds of its words.

    Words are runs other than space and U+0009 to U+000D; lower: A-Z are lower-cased. Nulls count as empty.
    """
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets, data = column.buffers()[1:]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    flat = (_LOWER[_GAP] if lower else _GAP)[raw]
    clean = pa.LargeStringArray.from_buffers(len(column), offsets, pa.py_buffer(flat), offset=column.offset)
    split = pc.split_pattern(clean, " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    index = coded.indices.to_numpy()
    real = np.not_equal(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False), 0)[index]
    ends = np.concatenate([[0], np.cumsum(real)])
    return coded.dictionary, index[real], ends[bounds - bounds[0]]


def hash_words(words: pa.Array) -> np.ndarray:
    return hash_array(words.to_numpy(zero_copy_only=False), hash_key=_KEY, categorize=False) if len(words) else np.zeros(0, np.uint64)


def window_hashes(word: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, from their hashes; windows across the end of a text are the caller's to drop."""
    if len(word) < n:
        return np.zeros(0, np.uint64)
    total = word[: len(word) - n + 1].copy()
    factor = np.uint64(0x9E3779B97F4A7C15)
    for i in range(1, n):
        total = total * factor + word[i : len(word) - n + 1 + i]
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes: of size words, or of all words where there are fewer."""
    words, index, bounds = split_words(texts)
    word = hash_words(words)[index] if len(words) else np.zeros(0, np.uint64)
    windows = window_hashes(word, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            out.append(window_hashes(word[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
