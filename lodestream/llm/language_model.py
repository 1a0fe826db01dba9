"""Language-model scoring: a log-bilinear model with a two-level softmax, trained by noise-contrastive estimation in numpy.

Units: the EMBED * sqrt(types) most frequent words, tails (a hash class of the last two characters, one for every eight of
those words) for all others, and the end of a text; their number grows with the corpus. Units stand in groups by
frequency, about the square root of their number, the frequent ones in small groups. The log-bilinear context is
h = r(word before) C1 + r(word before that) C2; P(unit) = softmax of h . q(group) + b(group) over the groups, times the
softmax of h . q(unit) + b(unit) over the group's units, both normalised in full by batched matrix products. Biases are
the logs of the unigram shares, so without embeddings the model is the unigram. In a tail, a known word has its
discounted share of the tail's counts; what the discount frees is shared by the words that training never saw, of which
UNSEEN for each known one are assumed. The probabilities of a context thus sum to one over the known words, those
assumed unseen ones and the end.

Training reads all texts of the training folds. Word counts are summed by Spark. Then every task runs NCE over its own
tokens from common initial embeddings: for a minibatch, NOISE groups drawn from the groups' shares, and for each token
NOISE_WORDS words drawn from its group's (a table of NOISE_TABLE draws of each); Adagrad by row. The tasks' embeddings are averaged by Spark, each row weighted by
the updates that it had, so every text takes part and nothing but embeddings reaches the driver.

Scoring: the most frequent words, with their counts, are broadcast (KNOWN of them, or all units' words); a text's other
words leave the tasks as (row, word, times) and meet the counts in a join. Words and counts are exact, none is left out.

Defined cases: null and empty texts are an end alone, after a start; texts are read whole; with no training text all words
are unseen and all units equally likely; equal counts at the edge of the units are all left out or, where nothing is
more frequent, taken by word; repeated rows each get their score; an empty table gives none; extra columns are not read;
a null doc_id counts as the empty text in the fold.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow_words import one_thread, pieces, split_words
from .common import crc_fold, materialize, read

EMBED, WORDS_A_TAIL, LEAST_TAILS, KNOWN = 8, 8, 16, 1 << 17
DIMS, NOISE, NOISE_WORDS, NOISE_TABLE, MINIBATCH, RATE, SEED = 16, 16, 2, 4096, 8192, 0.1, 3
FOLDS, HELD_OUT, ADD, DISCOUNT, UNSEEN, SCORED = 10, 0, 0.1, 0.6, 4, 1 << 12


def tail_hashes(words: pa.Array) -> np.ndarray:
    """31 bits of the last two characters of each word; modulo the number of tails they are its tail."""
    if not len(words):
        return np.zeros(0, np.int64)
    coded = pc.utf8_slice_codeunits(words, -2, None).dictionary_encode()
    keys = hash_array(coded.dictionary.to_numpy(zero_copy_only=False), hash_key="lodestream-tails", categorize=False)
    return (keys & np.uint64(0x7FFFFFFF)).astype(np.int64)[coded.indices.to_numpy()]


def count_words(texts: DataFrame) -> DataFrame:
    """word, tail hash, count of the texts' words (a column text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=0):
            distinct, index, _ = split_words(batch.column(0))
            n = np.bincount(index, minlength=len(distinct))
            words = distinct.take(pa.array(np.flatnonzero(n)))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(tail_hashes(words).astype(np.int32)), pa.array(n[n > 0])], names=["word", "tail", "c"])

    return texts.select("text").mapInArrow(count, "word string, tail int, c long").groupBy("word").agg(F.min("tail").alias("tail"), F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, all of a count or none, at most ``most``; of the highest count alone, where more
    than that have it, the first by word. The window is over the distinct counts, of which there are few."""
    ahead = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = counts.groupBy("c").agg(F.count("*").alias("n")).withColumn("n", F.sum("n").over(ahead))
    top, cut = levels.agg(F.max("c"), F.min(F.when(F.col("n") <= most, F.col("c")))).first()
    if cut is None and top is not None:
        return counts.where(F.col("c") == top).orderBy("word").limit(most)
    return counts.where(F.col("c") >= cut) if cut is not None else counts.limit(0)


class Units:
    """Words with embeddings of their own, tails and the end; groups of them by frequency."""

    def __init__(self, words: list[str], counts: np.ndarray, tail_counts: np.ndarray, ends: int) -> None:
        self.words, self.tails = words, len(tail_counts)
        self.end = len(words) + self.tails
        self.start = self.n = self.end + 1  # the start is a context, not an outcome
        c = np.concatenate([counts, tail_counts, [ends]]) + ADD
        order = np.argsort(-c, kind="stable")
        self.rank = np.empty(self.n, np.int64)
        self.rank[order] = np.arange(self.n)
        self.sums = np.concatenate([[0.0], np.cumsum(c[order])])  # by rank
        # about the square root of their number of groups, of equal sums of roots: frequent words stand in small ones
        roots = np.cumsum(np.sqrt(c[order]))
        of_rank = np.floor((roots - np.sqrt(c[order])) / roots[-1] * (math.isqrt(self.n - 1) + 1))
        self.order, self.edges = order, np.concatenate([[0], np.flatnonzero(of_rank[1:] != of_rank[:-1]) + 1, [self.n]])
        self.group = (np.searchsorted(self.edges, self.rank, "right") - 1).astype(np.int64)
        mass = np.diff(self.sums[self.edges])
        self.share = mass / mass.sum()
        self.within = c / mass[self.group]

    @property
    def groups(self) -> int:
        return len(self.edges) - 1

    def of(self, distinct: pa.Array) -> np.ndarray:
        place = pc.fill_null(pc.index_in(distinct, value_set=pa.array(self.words, pa.large_string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(place >= 0, place, len(self.words) + tail_hashes(distinct) % self.tails)


def transitions(units: Units, distinct: pa.Array, index: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The word before each token, that before it, and the token, an end each included, as units; and each text's bounds in them."""
    n = len(bounds) - 1
    own = units.of(distinct)[index] if len(index) else np.zeros(0, np.int64)
    token = np.full(len(own) + n, units.end, np.int64)
    token[np.arange(len(own)) + np.repeat(np.arange(n), np.diff(bounds))] = own
    edges = bounds + np.arange(n + 1)
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[edges[:-1]] = units.start
    far = np.empty_like(before)
    far[1:] = before[:-1]
    far[edges[:-1]] = units.start
    return before, far, token, edges


Parameters = dict[str, np.ndarray]


def initial(units: Units) -> Parameters:
    rng = np.random.default_rng(SEED)
    normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return {"r": normal(units.n + 1, DIMS), "q": np.zeros((units.n, DIMS), np.float32), "g": np.zeros((units.groups, DIMS), np.float32), "c1": np.eye(DIMS, dtype=np.float32), "c2": 0.5 * np.eye(DIMS, dtype=np.float32)}


class Trainer:
    """Noise-contrastive estimation of the parameters over minibatches, with the number of updates of each row."""

    def __init__(self, units: Units, seed: int) -> None:
        self.units, self.p, self.rng = units, initial(units), np.random.default_rng([SEED, seed])
        self.squares = {k: np.full(len(w), 1e-8, np.float32) for k, w in self.p.items()}
        self.updates = {k: np.zeros(len(w), np.int64) for k, w in self.p.items()}
        self.log_noise = (np.log(NOISE * units.share).astype(np.float32), np.log(NOISE_WORDS * units.within).astype(np.float32))
        # each group's noise, drawn once: minibatches pick from it
        at = self.units.sums[self.units.edges[:-1], None] + self.rng.random((units.groups, NOISE_TABLE)) * np.diff(self.units.sums[self.units.edges])[:, None]
        rank = np.clip(np.searchsorted(units.sums, at, "right") - 1, units.edges[:-1, None], units.edges[1:, None] - 1)
        self.noise = units.order[rank].astype(np.int32)
        self.bias = (np.log(units.share).astype(np.float32), np.log(units.within).astype(np.float32))

    def _add(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        """An Adagrad step of rows, which may repeat, up their summed gradients."""
        order = np.argsort(rows)
        ranked = rows[order]
        first = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1])
        used, count = ranked[first], np.diff(np.append(first, len(rows)))
        total = np.add.reduceat(gradient[order], first, axis=0)
        self.squares[name][used] += np.einsum("ij,ij->i", total, total)
        self.p[name][used] += RATE * total / np.sqrt(self.squares[name][used])[:, None]
        self.updates[name][used] += count

    def step(self, before: np.ndarray, far: np.ndarray, token: np.ndarray) -> None:
        p, units = self.p, self.units
        one, two, own = p["r"][before], p["r"][far], units.group[token]
        h = one @ p["c1"] + two @ p["c2"]
        # groups: the token's own against NOISE that the minibatch shares
        drawn = self.rng.choice(units.groups, NOISE, p=units.share)
        error = -_sigmoid(h @ p["g"][drawn].T + (self.bias[0] - self.log_noise[0])[drawn])
        right = 1 - _sigmoid(np.einsum("ij,ij->i", h, p["g"][own]) + (self.bias[0] - self.log_noise[0])[own])
        back = error @ p["g"][drawn] + right[:, None] * p["g"][own]
        of_groups = np.concatenate([error.T @ h, right[:, None] * h])
        # words: the token against NOISE_WORDS of its group
        noise = self.noise[own[:, None], self.rng.integers(0, NOISE_TABLE, (len(token), NOISE_WORDS), dtype=np.int32)]
        rows = np.concatenate([token[:, None], noise], 1)
        q = p["q"][rows]
        g = -_sigmoid(np.einsum("ij,ikj->ik", h, q) + (self.bias[1] - self.log_noise[1])[rows])
        g[:, 0] += 1
        back += np.einsum("ik,ikj->ij", g, q)
        of_words = (g[:, :, None] * h[:, None, :]).reshape(-1, DIMS)
        steps = {"c1": one.T @ back, "c2": two.T @ back}
        to_one, to_two = back @ p["c1"].T, back @ p["c2"].T
        self._add("g", np.concatenate([drawn, own]), of_groups)
        self._add("q", rows.ravel(), of_words)
        self._add("r", np.concatenate([before, far]), np.concatenate([to_one, to_two]))
        for name, gradient in steps.items():
            self._add(name, np.arange(DIMS), gradient)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: DataFrame, units: Units) -> Parameters:
    """The average of what each task's pass over its texts makes of the initial parameters."""
    packed = texts.sparkSession.sparkContext.broadcast(pickle.dumps(units))
    names = [f"d{i}" for i in range(DIMS)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        one_thread()
        units = pickle.loads(packed.value)
        trainer = Trainer(units, TaskContext.get().partitionId())
        for batch in pieces(batches, text=0):
            before, far, token, _ = transitions(units, *split_words(batch.column(0)))
            for at in range(0, len(token), MINIBATCH):
                trainer.step(before[at : at + MINIBATCH], far[at : at + MINIBATCH], token[at : at + MINIBATCH])
        for name, w in trainer.p.items():
            n = trainer.updates[name]
            used = np.flatnonzero(n)
            rows = w[used] * n[used, None]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(n[used]), *(pa.array(np.ascontiguousarray(rows[:, i]), pa.float32()) for i in range(DIMS))], names=["name", "row", "n", *names])

    sums = texts.select("text").mapInArrow(learn, "name string, row long, n long, " + ", ".join(f"{x} float" for x in names)).groupBy("name", "row")
    p = initial(units)
    for name, row, n, *total in sums.agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names]).toLocalIterator():
        p[name][row] = np.array(total) / n
    return p


class Scorer:
    """log10 P(unit | the two before), normalised."""

    def __init__(self, units: Units, p: Parameters) -> None:
        self.units, self.one, self.two = units, p["r"] @ p["c1"], p["r"] @ p["c2"]
        self.g, self.g_bias = p["g"], np.log(units.share).astype(np.float32)
        self.q, self.q_bias = p["q"][units.order], np.log(units.within[units.order]).astype(np.float32)  # by rank

    def log10(self, before: np.ndarray, far: np.ndarray, token: np.ndarray) -> np.ndarray:
        h, group, rank = self.one[before], self.units.group[token], self.units.rank[token]
        h += self.two[far]
        out = np.empty(len(token))
        for i in range(0, len(token), SCORED):
            part = slice(i, i + SCORED)
            out[part] = _log_softmax(h[part] @ self.g.T + self.g_bias, group[part])
        order = np.argsort(group)
        edges = np.searchsorted(group[order], np.arange(self.units.groups + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            a, b = self.units.edges[k], self.units.edges[k + 1]
            for i in range(edges[k], edges[k + 1], SCORED):
                rows = order[i : min(i + SCORED, edges[k + 1])]
                out[rows] += _log_softmax(h[rows] @ self.q[a:b].T + self.q_bias[a:b], rank[rows] - a)
        return out / math.log(10)


def _log_softmax(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log of the softmax of each row, at one column of it; scores are used up."""
    scores -= scores.max(1, keepdims=True)
    own = scores[np.arange(len(at)), at].astype(np.float64)
    return own - np.log(np.exp(scores, out=scores).sum(1, dtype=np.float32))


def fit(training: DataFrame, counts: DataFrame) -> dict:
    """What scoring needs: units, parameters, known words with counts, the tails' masses and kinds, N and V."""
    ends = training.count()
    n, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    embedded = math.ceil(EMBED * math.sqrt(types))
    known = sorted(most_frequent(counts, max(KNOWN, embedded)).collect(), key=lambda r: (-r.c, r.word))
    # all words of a count or none, as far as there is a choice
    least = known[embedded].c if len(known) > embedded else 0
    own = [r for r in known[:embedded] if r.c > least] or known[:embedded]
    tails = max(LEAST_TAILS, embedded // WORDS_A_TAIL)
    mass, kinds = np.zeros(tails), np.zeros(tails)
    for t, c, k in counts.groupBy(F.pmod("tail", F.lit(tails))).agg(F.sum("c"), F.count("*")).collect():  # a row a tail
        mass[t], kinds[t] = c, k
    for r in own:
        mass[r.tail % tails] -= r.c
        kinds[r.tail % tails] -= 1
    units = Units([r.word for r in own], np.array([r.c for r in own], np.float64), mass, ends)
    return {
        "units": units, "p": train(training, units), "words": [r.word for r in known], "c": np.array([r.c for r in known], np.float64), "mass": mass, "kinds": kinds, "ends": ends,
        "tokens": n + ends, "types": types + bool(ends),
    }


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    training = rows.where("not held_out").select("text")
    counts = materialize(count_words(training))
    model = fit(training, counts)
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    found = materialize(rows.mapInArrow(_scorer(packed), "row long, doc_id long, held_out boolean, word string, tail int, n long, known long, base double, score double"))
    own = found.where("word is null").select("row", "doc_id", "held_out", "n", "known", "base", "score")
    apart = found.where("word is not null").select("row", "word", "tail", F.col("n").alias("times"))
    tails = own.sparkSession.createDataFrame([(i, float(m), float(k)) for i, (m, k) in enumerate(zip(model["mass"], model["kinds"], strict=True))], "tail int, mass double, kinds double")
    joined = apart.join(counts.select("word", "c"), "word", "left").join(F.broadcast(tails), "tail")
    share = F.when(F.col("c").isNotNull(), F.col("c") - DISCOUNT).otherwise((DISCOUNT * F.col("kinds") + ADD) / (UNSEEN * F.col("kinds") + 1))
    share = F.log10(share) - F.log10(F.col("mass") + ADD)
    more = joined.groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more"), F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("more_base"), F.sum(F.col("times") * share).alias("more_score"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    all_log = F.lit(math.log10(model["tokens"] + ADD * (model["types"] + 1)))
    return own.join(more, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + zero("more")).alias("n_known"), F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") - F.col("n") * all_log).alias("base_score"), (F.col("score") + zero("more_score")).alias("score"),
    )


def _scorer(packed):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        one_thread()
        m = pickle.loads(packed.value)
        units, scorer = m["units"], Scorer(m["units"], m["p"])
        words, c = pa.array(m["words"], pa.large_string()), np.append(m["c"], 0.0)
        own_words, row = len(units.words), TaskContext.get().partitionId() << 40
        end = (np.log10(m["ends"] + ADD), 1) if m["ends"] else (np.log10(ADD), 0)
        for batch in pieces(batches, most=1 << 20):
            distinct, index, bounds = split_words(batch.column(1))
            n = batch.num_rows
            text = np.repeat(np.arange(n), np.diff(bounds))
            place = pc.fill_null(pc.index_in(distinct, value_set=words), len(words)).to_numpy(zero_copy_only=False)
            is_known, tail = place < len(words), tail_hashes(distinct) % units.tails
            base = np.where(is_known, np.log10(c[place] + ADD), 0.0)
            inner = np.where(is_known & (place >= own_words), np.log10(np.maximum(c[place] - DISCOUNT, 1e-9)) - np.log10(m["mass"][tail] + ADD), 0.0)
            before, far, token, edges = transitions(units, distinct, index, bounds)
            path = np.add.reduceat(scorer.log10(before, far, token), edges[:-1])
            per_text = lambda x: np.bincount(text, weights=x[index], minlength=n) if len(index) else np.zeros(n)  # noqa: E731, B023
            ids = row + np.arange(n)
            yield _rows([ids, batch.column(0), batch.column(2), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), np.diff(bounds) + 1, per_text(is_known.astype(float)).astype(np.int64) + end[1], per_text(base) + end[0], path + per_text(inner)])
            row += n
            apart = np.flatnonzero(~is_known[index]) if len(index) else np.zeros(0, np.int64)
            if len(apart):
                codes, times = np.unique(text[apart] * np.int64(len(distinct)) + index[apart], return_counts=True)
                t, w = codes // len(distinct), codes % len(distinct)
                k = len(codes)
                yield _rows([ids[t], pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), distinct.take(pa.array(w)).cast(pa.string()), pa.array(tail[w].astype(np.int32)), times, pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64())])

    return apply


def _rows(columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["row", "doc_id", "held_out", "word", "tail", "n", "known", "base", "score"]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"))
