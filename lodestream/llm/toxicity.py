"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols of a small alphabet: insult, threat, target, negation, reported speech, other. Five transducers
read a clause's symbols, other words included, each a table (state, symbol) -> (state, label or none): the insult and
the threat transducer label their words, the threat transducer a target that follows within GAP words; the target
transducer labels an insult with a target at most GAP words before or after it; the negation transducer labels
what stands within GAP words after a negation, the reported-speech transducer what follows a reporting verb in the
clause. ``compose`` makes their product, one deterministic machine whose states are tuples and whose arcs carry the
labels of all parts. Every label has a weight; a clause scores the sum of its path's weights, and a document is a
logistic of its labels' damped counts with the same weights.

The weights are fitted to the labelled sample outside the held-out fold, by a logistic regression that a ridge draws
to PRIOR: there a bare insult or threat weighs next to nothing, an aimed one much, and negation and report take away.
What a bare word weighs on a corpus is thus decided by that corpus's labels, never by the word list.

The lexicons of threats, targets, negations and reporting verbs are fixed word lists in four languages. Insults are a
seed list and all words and word stems (beginnings of STEMS characters) of the sample whose document count among toxic
rows exceeds chance by a likelihood ratio of at least LEAST_G2; the sample's bound is theirs.

Defined cases: null and empty texts have no clause and get the score of a text without matches; texts are read whole;
without labels of both classes the weights are PRIOR's; repeated rows each get
their score; an empty table gives none; extra columns are not read; equal likelihood ratios are all kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_words import pieces, split_words
from .common import ascii_lower, materialize, read, words
from .labelled import SAMPLE_ROWS, held_out, labelled_sample

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# The lexicons.
SEEDS = {
    INSULT: "idiot idiots moron morons imbecile scum trash loser losers stupid pathetic worthless disgusting clown vermin dumb "
    "dummkopf trottel abschaum arschloch idiotin imbécile abruti connard ordure crétin idiota imbécil basura escoria estúpido",
    THREAT: "kill hurt destroy murder beat shoot stab burn töten umbringen schlagen vernichten tuer frapper détruire brûler matar golpear destruir quemar",
    TARGET: "you your you're yours he she they them these those him her du dich dir ihr euch sie tu toi vous te ton ils elles tú usted ustedes ellos ellas",
    NEGATION: "not never no isn't aren't don't won't without nicht kein keine nie niemals pas jamais ne sans nunca jamás ni sin",
    REPORT: "said says quote quoted reported reports according alleged claimed called sagte sagt laut zitiert berichtet dit disait selon rapporte dijo dice según citó",
}
CLAUSE_END, EDGES = ".!?;:", ".,;:!?\"'()[]{}*#"
LEAST_G2, LEAST_ROWS, THRESHOLD, GAP = 25.0, 5, 0.3, 4
#: Lengths of stems, which are learned beside whole words and written with STEM behind them.
STEMS, STEM = (4, 5, 6, 7), "*"

#: Labels of arcs, their weights before any labelled row is seen, and how strongly the ridge holds each to that.
LABELS = ("insult", "threat", "aimed_insult", "aimed_threat", "negated", "reported")
PRIOR, PRIOR_BIAS, RIDGE = (0.1, 0.05, 3.0, 2.5, -1.5, -1.0), -2.5, 0.5
BARE, THREATENS, AIMED, AIMED_THREAT, NEGATED, REPORTED = range(len(LABELS))

Transducer = dict[tuple[int, int], tuple[int, int | None]]


def _fading(opener: int, first: int = 1) -> Transducer:
    """States first .. first + GAP - 1 after the symbol opener: each other word is a step, the last falls back to 0."""
    last = first + GAP - 1
    arcs: Transducer = {(q, OTHER): (q + 1 if q < last else 0, None) for q in range(first, last + 1)}
    return arcs | {(q, opener): (first, None) for q in (0, *range(first, last + 1))}


def insults() -> Transducer:
    return {(0, INSULT): (0, BARE)}


def threats() -> Transducer:
    """A threat, and a target at most GAP words after it."""
    open_states = range(1, GAP + 1)
    return _fading(THREAT) | {(q, THREAT): (1, THREATENS) for q in (0, *open_states)} | {(q, TARGET): (0, AIMED_THREAT) for q in open_states}


def targets() -> Transducer:
    """An insult at most GAP words after a target (states 1 to GAP), or before one (the states behind them)."""
    after, before = range(1, GAP + 1), range(GAP + 1, 2 * GAP + 1)
    arcs = _fading(TARGET) | {(q, OTHER): a for (q, symbol), a in _fading(INSULT, GAP + 1).items() if symbol == OTHER}
    arcs |= {(q, INSULT): (q, AIMED) for q in after}
    arcs |= {(0, INSULT): (GAP + 1, None)} | {(q, INSULT): (GAP + 1, None) for q in before}
    return arcs | {(q, TARGET): (1, AIMED) for q in before}


def negations() -> Transducer:
    return _fading(NEGATION) | {(q, s): (0, NEGATED) for q in range(1, GAP + 1) for s in (INSULT, THREAT)}


def reports() -> Transducer:
    """What is reported, for the rest of the clause."""
    return {(0, REPORT): (1, None), (1, INSULT): (1, REPORTED), (1, THREAT): (1, REPORTED)}


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[tuple[int, ...]]]]:
    """The product of transducers that read the same symbols: next state and labels by state and symbol; 0 is the start.

    A transducer without an arc for a symbol stays where it is and says nothing.
    """
    states, nexts, labels = {(0,) * len(parts): 0}, [], []
    todo = list(states)
    while len(nexts) < len(todo):
        state = todo[len(nexts)]
        moves = [[t.get((q, symbol), (q, None)) for t, q in zip(parts, state, strict=True)] for symbol in range(6)]
        for arc in moves:
            to = tuple(q for q, _ in arc)
            if to not in states:
                states[to] = len(states)
                todo.append(to)
        nexts.append([states[tuple(q for q, _ in arc)] for arc in moves])
        labels.append([tuple(x for _, x in arc if x is not None) for arc in moves])
    return nexts, labels


class Grammar:
    def __init__(self, learned: dict[str, float] | None = None, weights: np.ndarray | None = None) -> None:
        self.machine = compose(insults(), threats(), targets(), negations(), reports())
        self.weights = np.array([*PRIOR, PRIOR_BIAS]) if weights is None else weights
        self.symbol = {w: s for s, text in SEEDS.items() for w in text.split()}
        stems = [w.removesuffix(STEM) for w in learned or {} if w.endswith(STEM)]
        for w in learned or {}:
            if not w.endswith(STEM):
                self.symbol.setdefault(w, INSULT)
        self.words = pa.array(list(self.symbol), pa.large_string())
        self.symbols = np.array(list(self.symbol.values()))
        self.stems = {n: pa.array([w for w in stems if len(w) == n], pa.large_string()) for n in STEMS}

    def symbols_of(self, distinct: pa.Array) -> np.ndarray:
        """The symbol of each word: that of the word without its edges, else an insult where a learned stem begins it."""
        bare = pc.utf8_trim(distinct, EDGES)
        symbol = np.append(self.symbols, OTHER)[pc.fill_null(pc.index_in(bare, value_set=self.words), len(self.symbols)).to_numpy(zero_copy_only=False)]
        for n, stems in self.stems.items():
            if len(stems):
                begins = pc.is_in(pc.utf8_slice_codeunits(bare, 0, n), value_set=stems).to_numpy(zero_copy_only=False)
                symbol = np.where((symbol == OTHER) & begins, INSULT, symbol)
        return symbol

    def path(self, symbols: list[int]) -> np.ndarray:
        """How often each label stands on the path of a clause."""
        nexts, labels = self.machine
        state, counts = 0, np.zeros(len(LABELS), np.int64)
        for s in symbols:
            for x in labels[state][s]:
                counts[x] += 1
            state = nexts[state][s]
        return counts

    def features(self, texts: pa.Array) -> np.ndarray:
        """For each text the damped counts of the labels of all its clauses, and the highest score of a clause."""
        distinct, index, bounds = split_words(texts)
        n = len(bounds) - 1
        out = np.zeros((n, len(LABELS) + 1))
        if not len(index):
            return out
        symbol = self.symbols_of(distinct)
        closes = pc.is_in(pc.utf8_slice_codeunits(distinct, -1, None), value_set=pa.array(list(CLAUSE_END), pa.large_string())).to_numpy(zero_copy_only=False)
        at = np.flatnonzero((symbol == INSULT)[index] | (symbol == THREAT)[index])  # other clauses have no labels
        if not len(at):
            return out
        ends = np.union1d(np.flatnonzero(closes[index]) + 1, bounds)  # a clause ends with its closing word or its text
        clauses = np.unique(np.searchsorted(ends, at, "right"))
        text_of = np.searchsorted(bounds, ends[clauses - 1], "right") - 1
        for c, t in zip(clauses.tolist(), text_of.tolist(), strict=True):
            counts = self.path(symbol[index[ends[c - 1] : ends[c]]].tolist())
            out[t, :-1] += counts
            out[t, -1] = max(out[t, -1], counts @ self.weights[:-1])
        out[:, :-1] = np.log1p(out[:, :-1])
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features[:, : len(LABELS)] @ self.weights[:-1] + self.weights[-1], -50, 50)))


def learn_insults(sample: DataFrame) -> dict[str, float]:
    """Words and stems of the sample (text, label) that toxic rows hold more often than chance, with their likelihood ratios."""
    bare = F.array_distinct(F.transform(words(ascii_lower(F.col("text"))), lambda w: F.trim(w, F.lit(EDGES))))
    stems = [F.expr(f"transform(filter(bare, w -> length(w) > {n}), w -> concat(substring(w, 1, {n}), '{STEM}'))") for n in STEMS]
    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("tox")).first()
    n, tox = totals.n, totals.tox
    if not tox or tox == n:
        return {}
    terms = F.array_distinct(F.concat(F.filter("bare", lambda w: ~F.endswith(w, F.lit(STEM))), *stems))
    seen = sample.select("label", bare.alias("bare")).select("label", F.explode(terms).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("a"), F.sum("label").alias("b"))
    share = tox / n
    a, b = F.col("a"), F.col("b")
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    g2 = 2 * (part(b, a * share) + part(a - b, a * (1 - share)))
    # toxic in most of its rows, far beyond chance
    found = seen.where((b >= LEAST_ROWS) & (b > 0.75 * a) & (b > 2 * share * a)).select("word", g2.alias("g2")).where(F.col("g2") >= LEAST_G2)
    return {r.word: r.g2 for r in found.orderBy("word").collect()}  # words of at least LEAST_ROWS rows of the sample


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The labels' weights and the bias by Newton steps of a logistic regression with a ridge around PRIOR."""
    prior = np.array([*PRIOR, PRIOR_BIAS])
    if len(y) == 0 or y.min() == y.max():
        return prior
    a = np.concatenate([x, np.ones((len(x), 1))], 1)
    w, ridge = prior.copy(), np.diag([RIDGE] * len(LABELS) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-6)[:, None]) + ridge, a.T @ (p - y) + ridge @ (w - prior))
    return w


Model = tuple[dict[str, float], np.ndarray]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """The learned insults, and the weights of the labels with the bias."""
    sample = materialize(labelled_sample(docs, labels, label, rows).select("doc_id", "text", "label"))
    learned = learn_insults(sample)
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(learned))
    names = [f"x{i}" for i in range(len(LABELS))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(pickle.loads(packed.value))
        for batch in pieces(batches):
            x = grammar.features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(names)))], names=["doc_id", "label", *names])

    found = sample.mapInArrow(measure, "doc_id long, label int, " + ", ".join(f"{n} double" for n in names))
    kept = sorted(tuple(r) for r in found.collect())  # at most the sample's rows
    x = np.array([r[2:] for r in kept], np.float64).reshape(len(kept), len(names))
    return learned, fit_weights(x, np.array([r[1] for r in kept], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, top_clause for every text of docs (doc_id, text)."""
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(*pickle.loads(packed.value))
        for batch in pieces(batches):
            x = grammar.features(batch.column(1))
            p = grammar.probability(x)
            columns = [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(np.ascontiguousarray(x[:, -1]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", "top_clause"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, score double, predicted int, top_clause double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted", "top_clause")
