"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network with a temperature.

Random indexing: every word has a sparse ternary index vector, drawn by hash; a vector is the sum of the index vectors
of its neighbours over all documents, two words to either side. A word has two such vectors: that of its own slot, one
of WORDS by hash, and that of its shape (itself if it is short, else case, length and last two characters), one of
SHAPES, which serves words too rare for a good vector of their own. The tables are fixed in size, summed in the tasks,
then by Spark. A document's vector is the mean of its words' vectors, once over all words and once over its distinct
ones; four numbers on length and repetition stand beside them. The README has the accuracy without those four.

The network (one hidden layer, numpy, Adam) learns from a bounded sample of labelled rows outside the held-out fold;
a fifth of them is kept aside to fit the temperature by which its logits are divided.

Defined cases: null and empty texts pool to zeros and are scored like any other; texts are read whole; without labels
every score is 0.5, with those of one class all are alike; repeated rows each get their score; of a doc_id labelled
twice the larger label counts; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_words import one_thread, pieces, split_words
from .common import read
from .labelled import SAMPLE_ROWS, held_out, labelled_sample

WORDS, SHAPES, DIMS, NONZERO, REACH, HIDDEN, STEPS, SEED = 1 << 14, 1 << 13, 48, 4, 2, 32, 4_000, 5
THRESHOLD, ASIDE, RATE, DECAY = 0.7, 4, 0.003, 1e-3
FEATURES = 4 * DIMS + ASIDE


def _slots(keys: pa.Array, seed: str, slots: int) -> np.ndarray:
    if not len(keys):
        return np.zeros(0, np.int64)
    coded = keys.dictionary_encode()
    return (hash_array(coded.dictionary.to_numpy(zero_copy_only=False), hash_key=seed, categorize=False) % np.uint64(slots)).astype(np.int64)[coded.indices.to_numpy()]


def slots(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct word its own slot, and that of its shape, which stands behind the WORDS of the first kind."""
    n = pc.utf8_length(words)
    case = pc.if_else(pc.utf8_is_lower(words), "l", pc.if_else(pc.utf8_is_upper(words), "u", pc.if_else(pc.utf8_is_title(words), "t", "m")))
    case, size = case.cast(pa.large_string()), pc.min_element_wise(n, pa.scalar(12, n.type)).cast(pa.large_string())
    shape = pc.binary_join_element_wise(case, size, pc.utf8_slice_codeunits(words, -2, None), pa.scalar("\t", pa.large_string()))
    return _slots(words, "lodestream-words", WORDS), WORDS + _slots(pc.if_else(pc.less_equal(n, 4), words, shape), "lodestream-forms", SHAPES)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For every word slot the places and signs of its index vector's non-zero numbers."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (WORDS, NONZERO)), rng.choice([-1.0, 1.0], (WORDS, NONZERO))


def neighbour_sums(texts: pa.Array) -> np.ndarray:
    """(WORDS + SHAPES) x DIMS: the sums of the index vectors of each slot's neighbours in these texts."""
    distinct, index, bounds = split_words(texts, lower=False)
    word, shape = (x[index] for x in slots(distinct)) if len(index) else (np.zeros(0, np.int64),) * 2
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places, signs = index_vectors()
    total = np.zeros((WORDS + SHAPES) * DIMS)
    for d in range(1, REACH + 1):
        same = np.flatnonzero(text[d:] == text[:-d])
        for mine, other in ((same, same + d), (same + d, same)):
            both, near = np.concatenate([word[mine], shape[mine]]) * DIMS, word[other]
            for i in range(NONZERO):
                total += np.bincount(both + np.tile(places[near, i], 2), weights=np.tile(signs[near, i], 2), minlength=len(total))
    return total.reshape(-1, DIMS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The random-indexing vectors of all slots over all texts of docs, scaled to length 1; fixed in size."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WORDS + SHAPES, DIMS))
        for batch in pieces(batches, text=0):
            total += neighbour_sums(batch.column(0))
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, i].astype(np.float32)) for i in range(DIMS))], names=["slot", *names])

    names = [f"d{i}" for i in range(DIMS)]
    sums = docs.select("text").mapInArrow(gather, "slot long, " + ", ".join(f"{n} float" for n in names)).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])
    vectors = np.zeros((WORDS + SHAPES, DIMS))
    for row in sums.toLocalIterator():
        vectors[row[0]] = row[1:]
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row of FEATURES numbers for each text; the last ASIDE are not of the vectors."""
    distinct, index, bounds = split_words(texts, lower=False)
    out = np.zeros((len(bounds) - 1, FEATURES), np.float32)
    word, shape = slots(distinct)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            types, counts = np.unique(index[a:b], return_counts=True)
            for k, slot in enumerate((word[types], shape[types])):
                used, where = np.unique(slot, return_inverse=True)
                v = vectors[used]
                both = np.stack([np.bincount(where, weights=counts) / (b - a), np.bincount(where) / len(types)])
                out[i, 2 * k * DIMS : 2 * (k + 1) * DIMS] = (both @ v).ravel()
            out[i, -ASIDE:] = np.log1p(b - a), len(types) / (b - a), counts.max() / (b - a), len(types) / (b - a) ** 0.8
    return out


def train(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The network's weights, the scaling of its inputs and its temperature."""
    mean, scale = (x.mean(0), np.maximum(x.std(0), 1e-3)) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    rng = np.random.default_rng(SEED)
    p = {"w1": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "b1": np.zeros(HIDDEN), "w2": np.zeros(HIDDEN), "b2": np.zeros(1)}
    model = p | {"mean": mean, "scale": scale, "t": np.ones(1)}
    if len(x) < 10 or y.min() == y.max():
        if len(y):
            model["b2"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return model
    z, aside = (x - mean) / scale, np.arange(len(x)) % 5 == 4
    p["w2"] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    a, b = z[~aside], y[~aside]
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step = 0
    for _ in range(int(np.clip(STEPS * 256 / len(a), 20, 200))):
        order = rng.permutation(len(a))
        for i in range(0, len(a), 256):
            u, t = a[order[i : i + 256]], b[order[i : i + 256]]
            h = np.tanh(u @ p["w1"] + p["b1"])
            e = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - t) / len(t)
            back = e[:, None] * p["w2"] * (1 - h * h)
            grads = {"w1": u.T @ back + DECAY * p["w1"], "b1": back.sum(0), "w2": h.T @ e + DECAY * p["w2"], "b2": e.sum(keepdims=True)}
            step += 1
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model |= p
    logit, t = logits(model, x[aside]), y[aside]
    grid = np.geomspace(0.25, 8, 61)
    model["t"] = np.array([min(grid, key=lambda s: np.logaddexp(0, np.where(t == 1, -logit, logit) / s).mean())])
    return model


def logits(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    h = np.tanh((x - model["mean"]) / model["scale"] @ model["w1"] + model["b1"])
    return h @ model["w2"] + model["b2"]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Word vectors over all of docs, and the network fitted to the sample. Only pooled vectors reach the driver."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for batch in pieces(batches):
            x = pool(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(map(bytes, x)), pa.binary())], names=["doc_id", "label", "x"])

    found = labelled_sample(docs, labels, label, rows).select("doc_id", "text", "label").mapInArrow(pooled, "doc_id long, label int, x binary")
    sample = sorted((r[0], r[1], bytes(r[2])) for r in found.collect())
    x = np.array([np.frombuffer(r[2], np.float32) for r in sample], np.float64).reshape(len(sample), FEATURES)
    return vectors, train(x, np.array([r[1] for r in sample], np.float64))


def score(docs: DataFrame, model: tuple[np.ndarray, dict[str, np.ndarray]], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every text of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        vectors, network = pickle.loads(shared.value)
        for batch in pieces(batches):
            p = 1 / (1 + np.exp(-np.clip(logits(network, pool(batch.column(1), vectors)) / network["t"], -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, fit(docs, read(spark, sf_dir, "labels").select("doc_id", "quality")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
