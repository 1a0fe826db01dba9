"""Near-duplicate detection with b-bit MinHash.

1. Each text becomes 128 minima over its five-word shingles. Band keys come from the full minima, four to a band; of
   the minima only the low two bits stay, packed into four longs.
2. Texts with the same shingle set form a class (128-bit fingerprint), a node from here on, whatever their ids.
3. In each bucket of a band, the node that meets most others over all its buckets is the hub: base texts of groups of
   near copies become hubs. Every node makes a candidate pair with the strongest hub of its buckets, so there are no
   more pairs than nodes. The bit signatures give a similarity estimate corrected for chance agreement (a quarter of
   lanes); pairs under LEAST_ESTIMATE, over four standard deviations below 0.75, are dropped. The rest are verified on
   full shingle sets.
4. Links join nodes to components. In buckets that still hold several components, HUB_ROUNDS hubs in turn meet all
   members of other components.
5. What is then left, members of different components that no hub has met, is compared by signature in blocks within
   the tasks, which only tell which members have a plausible partner; the full sets of those alone are fetched and
   compared, again in blocks. No link of a bucket is lost, no pairs become rows, and no set is copied for a member that
   the signatures rule out; the work that grows with the square of a bucket is on 32 bytes a member. A pair of
   similarity 0.75 shares no band with probability (1 - 0.75^4)^32 < 6e-6.

Defined cases: null texts and those without words have no shingles and link with nothing; fewer than five words are one
shingle; a null doc_id links with nothing and is kept; every row is judged by its own text, so one doc_id may come with
several texts; rows repeated whole are one document, which stays or goes in all its rows; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators.graph import components

from .arrow_words import mix, pieces, shingle_sets
from .common import BROADCAST_IDS, materialize, read, without_rows

HASHES, BANDS, SHINGLE, BITS, LANES_A_LONG = 128, 32, 5, 2, 32
PERCENT, LEAST_ESTIMATE, HUB_ROUNDS = 75, 0.55, 2
#: Members of a block of signatures; members, and shingles on average, of a block of full sets.
SIGNATURE_BLOCK, SET_BLOCK, SET_SHINGLES = 2048, 256, 1 << 19
_RNG = np.random.default_rng(20240229)
_A = (_RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_BAND_SEEDS = _RNG.integers(0, 1 << 63, (HASHES // BANDS, BANDS), dtype=np.uint64) | np.uint64(1)
_SIGNS = [f"s{i}" for i in range(HASHES // LANES_A_LONG)]
_SKETCH = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    parts = [((x[i : i + 2048] * _A) + _B).min(1) for i in range(0, len(x), 2048)]
    return np.minimum.reduce(parts)


def pack_low_bits(m: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, LANES_A_LONG to a long; m: one row a text."""
    lanes = (m & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(m), -1, LANES_A_LONG)
    return np.bitwise_or.reduce(lanes << (np.arange(LANES_A_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


def band_keys(m: np.ndarray) -> np.ndarray:
    rows = m.astype(np.uint64).reshape(len(m), BANDS, -1)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(rows.shape[2]):
        total = mix((total + rows[:, :, i]) * _BAND_SEEDS[i])
    return total.view(np.int64)


def _set_keys(shingles: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """A 128-bit fingerprint of a set."""
    one = np.bitwise_xor.reduce(mix(shingles + np.uint64(1)), initial=np.uint64(0)) ^ np.uint64(len(shingles))
    return one, mix(shingles ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)


def _signed(x: list[np.uint64]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, text_key) -> a row of _SKETCH each; texts without shingles have neither signature nor bands."""
    for batch in pieces(batches):
        sets = shingle_sets(batch.column(1), SHINGLE)
        full = np.array([len(s) > 0 for s in sets], bool)
        m = np.zeros((len(sets), HASHES), np.uint32)
        for i in np.flatnonzero(full):
            m[i] = minima(sets[i])
        low, keys = pack_low_bits(m), band_keys(m)[full]
        one, two = zip(*map(_set_keys, sets), strict=True)
        columns = [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), _signed(one), _signed(two)]
        columns += [pa.array(np.ascontiguousarray(low[:, i])) for i in range(low.shape[1])]
        ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(ends, keys.ravel()))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", *_SIGNS, "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        sets = shingle_sets(batch.column(1), SHINGLE)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        one, two = zip(*map(_set_keys, sets), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column(0), _signed(one), _signed(two), pa.ListArray.from_arrays(offsets, np.concatenate(sets).view(np.int64))], names=["doc_id", "set_a", "set_b", "shingles"])


def estimate(prefix_a: str, prefix_b: str) -> Column:
    """Similarity of two packed signatures by bit counts, corrected for lanes that agree by chance."""
    differ = None
    for i in range(HASHES // LANES_A_LONG):
        x = F.col(f"{prefix_a}s{i}").bitwiseXOR(F.col(f"{prefix_b}s{i}"))
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
        differ = n if differ is None else differ + n
    chance = 1 / (1 << BITS)
    return (1 - differ / F.lit(float(HASHES)) - chance) / (1 - chance)


def _plausible(a: str, b: str) -> Column:
    small, large = F.least(f"{a}n_shingles", f"{b}n_shingles"), F.greatest(f"{a}n_shingles", f"{b}n_shingles")
    return (100 * small >= PERCENT * large) & (estimate(a, b) >= LEAST_ESTIMATE)


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _sets_of(ids: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """id, shingles of these nodes, from a text of each class: rows of its first doc_id, and of those one of its set."""
    wanted = materialize(nodes.select(F.col("node").alias("id"), F.col("first").alias("doc_id"), "set_a", "set_b").join(ids, "id", "left_semi"))
    sized = F.broadcast if wanted.count() <= BROADCAST_IDS else lambda df: df
    texts = docs.select("doc_id", "text").join(sized(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    found = texts.mapInArrow(_sets, "doc_id long, set_a long, set_b long, shingles array<long>").join(sized(wanted), ["doc_id", "set_a", "set_b"])
    return materialize(found.select("id", "shingles").dropDuplicates(["id"]))


def _dealt(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows of buckets dealt to blocks, once for every pair of blocks (i, j) that a row's own block is one of."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def _block_links(left: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket of different labels. left: bucket, id, label.

    A task compares two blocks of a bucket; a pair that shares several buckets counts in that of its first band. First
    by signature, which leaves the members with a plausible partner; then those by full sets.
    """
    known = nodes.select(F.col("node").alias("id"), "n_shingles", *_SIGNS, "bands")
    rows = left.join(left.groupBy("bucket").agg(F.count("*").alias("size")), "bucket").join(known, "id")
    rows = _dealt(rows, F.ceil(F.col("size") / SIGNATURE_BLOCK)).drop("size")
    hopeful = materialize(rows.groupBy("bucket", "i", "j").applyInPandas(_plausible_members, "bucket long, id long").distinct())
    rows = left.join(hopeful, ["bucket", "id"]).join(known, "id")
    sizes = rows.groupBy("bucket").agg(F.greatest(F.count("*") / SET_BLOCK, F.sum("n_shingles") / SET_SHINGLES).alias("size"))
    rows = rows.join(sizes, "bucket").join(_sets_of(hopeful.select("id").distinct(), nodes, docs), "id")
    rows = _dealt(rows, F.ceil("size")).drop("size")
    return rows.groupBy("bucket", "i", "j").applyInPandas(_compare_blocks, "a long, b long").distinct()


class _Blocks:
    """The two blocks of a group, and for each member of the first its partners in the second."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        self.bucket, self.i, self.j = (int(pdf[c].iloc[0]) for c in ("bucket", "i", "j"))
        self.parts = pdf[pdf.block == self.i], pdf[pdf.block == self.j]
        column = lambda c: [np.array(p[c], np.int64) for p in self.parts]
        self.ids, self.labels, self.sizes = column("id"), column("label"), column("n_shingles")
        self.signs = [np.stack([p[s].to_numpy() for s in _SIGNS], 1).view(np.uint64) for p in self.parts]
        self.bands = [np.stack(list(p.bands)) if len(p) else np.zeros((0, BANDS), np.int64) for p in self.parts]

    def partners(self, r: int) -> np.ndarray:
        """Members of the second block that the r-th of the first may link with, by label, size, signature, first band."""
        mine = np.flatnonzero((self.labels[1] != self.labels[0][r]) & ((self.ids[1] < self.ids[0][r]) | (self.i != self.j)))
        low, high = np.minimum(self.sizes[1][mine], self.sizes[0][r]), np.maximum(self.sizes[1][mine], self.sizes[0][r])
        mine = mine[100 * low >= PERCENT * high]
        bits = self.signs[1][mine] ^ self.signs[0][r]
        differ = np.bitwise_count((bits | (bits >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(1, dtype=np.int64)
        chance = 1 / (1 << BITS)
        mine = mine[(1 - differ / HASHES - chance) / (1 - chance) >= LEAST_ESTIMATE]
        same = self.bands[1][mine] == self.bands[0][r]
        return mine[self.bands[0][r][same.argmax(1)] == self.bucket] if len(mine) else mine


def _plausible_members(pdf: pd.DataFrame) -> pd.DataFrame:
    b = _Blocks(pdf)
    one, two = np.zeros(len(b.ids[0]), bool), np.zeros(len(b.ids[1]), bool)
    for r in range(len(one)):
        mine = b.partners(r)
        one[r] = len(mine) > 0
        two[mine] = True
    found = np.unique(np.concatenate([b.ids[0][one], b.ids[1][two]]))
    return pd.DataFrame({"bucket": np.full(len(found), b.bucket), "id": found})


def _compare_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links that join components: members that a link has joined have one label from then on."""
    b = _Blocks(pdf)
    sets = [list(p.shingles) for p in b.parts]
    counts = np.array([len(s) for s in sets[1]], np.int64)
    links = []
    for r, own in enumerate(sets[0]):
        mine = b.partners(r)
        if not len(mine):
            continue
        inside = np.isin(np.concatenate([sets[1][m] for m in mine]), own).astype(np.int64)
        common = np.add.reduceat(inside, np.cumsum(counts[mine]) - counts[mine])
        for m in mine[100 * common >= PERCENT * (counts[mine] + len(own) - common)]:
            x, y = b.labels[0][r], b.labels[1][m]
            if x != y:
                for labels in b.labels:
                    labels[labels == y] = x
                links.append((int(max(b.ids[0][r], b.ids[1][m])), int(min(b.ids[0][r], b.ids[1][m]))))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are at least PERCENT similar."""
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), nodes, docs)
    both = pairs.join(_renamed(sets, "a_"), F.col("a") == F.col("a_id")).join(_renamed(sets, "b_"), F.col("b") == F.col("b_id"))
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    union = F.size("a_shingles") + F.size("b_shingles") - common
    return both.where(100 * common >= PERCENT * union).select("a", "b")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs a > b of the columns id and hub."""
    return met.where("id <> hub").select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()


def _labelled(places: DataFrame, labels: DataFrame) -> DataFrame:
    return places.join(labels.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", "degree", F.coalesce("component", "id").alias("label"))


def _open(named: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components."""
    several = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("bucket")
    return named.join(several, "bucket")


def _check(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) those that the signatures leave plausible and the full sets confirm."""
    signed = nodes.select(F.col("node").alias("id"), "n_shingles", *_SIGNS)
    both = pairs.join(_renamed(signed, "a_"), F.col("a") == F.col("a_id")).join(_renamed(signed, "b_"), F.col("b") == F.col("b_id"))
    return materialize(_verified(materialize(both.where(_plausible("a_", "b_")).select("a", "b")), nodes, docs))


def link_classes(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, component of the nodes that have links."""
    places = nodes.select(F.col("node").alias("id"), F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    places = places.join(shared, "bucket")
    degree = places.groupBy("id").agg(F.sum("size").alias("degree"))
    places = materialize(places.join(degree, "id").select("bucket", "id", "degree"))

    # every node with the strongest hub of all its buckets: one pair a node
    rank = F.struct("degree", (-F.col("id")).alias("low"))
    hubs = places.groupBy("bucket").agg(F.max(rank).alias("top"))
    best = places.select("bucket", "id").join(hubs, "bucket").groupBy("id").agg(F.max("top").alias("top")).select("id", (-F.col("top.low")).alias("hub"))
    links = _check(_pairs(best), nodes, docs)
    labels = materialize(components(links))
    # then, in buckets that still hold several components, a hub at a time with the members of other components; the
    # second hub is one that the first has not reached
    past = None
    for turn in range(HUB_ROUNDS):
        left = _open(_labelled(places, labels))
        rank = F.struct("degree", (-F.col("id")).alias("low"), "label")
        if past is not None:
            left = left.join(past.select("bucket", F.col("hub").alias("id")), ["bucket", "id"], "left_anti")
            first = past.where("round = 0").join(labels.withColumnRenamed("node", "hub"), "hub", "left").select("bucket", F.coalesce("component", "hub").alias("of"))
            left = left.join(first, "bucket")
            rank = F.struct((F.col("label") != F.col("of")).alias("apart"), "degree", (-F.col("id")).alias("low"), "label")
        left = materialize(left)
        top = left.groupBy("bucket").agg(F.max(rank).alias("top"))
        hubs = materialize(top.select("bucket", (-F.col("top.low")).alias("hub"), F.col("top.label").alias("hub_label"), F.lit(turn).alias("round")))
        more = _check(_pairs(left.join(hubs, "bucket").where("label <> hub_label")), nodes, docs)
        hubs = hubs.select("bucket", "hub", "round")
        past = hubs if past is None else past.union(hubs)
        if not more.isEmpty():
            links = links.union(more)
            labels = materialize(components(links))
    # members of different components that have met no hub in common: every pair that is left, block by block
    named = _labelled(places, labels).join(past.select("bucket", F.col("hub").alias("id")), ["bucket", "id"], "left_anti")
    left = materialize(_open(named).select("bucket", "id", "label"))
    if not left.isEmpty():
        more = materialize(_block_links(left, nodes, docs))
        if not more.isEmpty():
            labels = materialize(components(links.union(more)))
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row of docs (doc_id, text); text_key is a hash of the text."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    sketches = materialize(keyed.mapInArrow(_sketch, _SKETCH))
    alike = sketches.where("doc_id is not null and n_shingles > 0").groupBy("set_a", "set_b")
    classes = alike.agg(F.min("doc_id").alias("first"), *[F.any_value(c).alias(c) for c in ("n_shingles", *_SIGNS, "bands")])
    nodes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))  # written, so numbered once
    labels = link_classes(nodes, keyed.select("doc_id", "text").where("doc_id is not null"))
    named = nodes.select("node", "first", "set_a", "set_b").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "component").select(F.col("set_a").alias("a"), F.col("set_b").alias("b"), "component_id")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    found = sketches.select("doc_id", "text_key", "n_shingles", "set_a", "set_b").join(of_class, linked & (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")), "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs (doc_id, text)."""
    return near_duplicates(docs).drop("text_key")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """docs without the documents that a nearer-to-first one stands for; all columns stay."""
    return without_rows(docs, near_duplicates(docs).where("not kept").select("doc_id", "text_key").distinct())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents").select("doc_id", "text"))


#: Every pair of documents with a shingle in common, for tables of some thousand documents.
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
g AS (SELECT doc_id, array_to_string(ws[i : i + {SHINGLE - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 2}, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
s AS (SELECT DISTINCT doc_id, hash(g) AS h FROM g), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT doc_id AS v, doc_id AS m FROM w UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.v), f AS (SELECT v, min(m) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept FROM w JOIN f ON f.v = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""
