"""Duplicates of items: exact, near by simhash, semantic by vectors, and their clusters over time.

The daily cascade comes in two modes. ``cascade`` judges every item of a batch against the history as it stood at the
start, in joins; ``cascade_in_order`` lets each item see those before it, which is sequential by definition and runs
in one task per episode over what the joins leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.hashing import hamming
from lodestream.functions.vectors import cosine, mean_unit
from lodestream.operators.graph import components
from lodestream.plans.storage import materialize, read_blocks, shared_dir

# The cascade's thresholds and the cluster's life in days.
T_AUTO, T_GRAY, NEAR, NEAR_AUTO, TTL_DAYS = 0.85, 0.58, 4, 8, 21
KNN_K, COS_TOKEN, COS_KNN, COS_ANY, LEAST_CONFIDENCE, MOST_JUDGED = 5, 0.55, 0.62, 0.80, 0.6, 60
EMPTY_SHA1 = "da39a3ee5e6b4b0d3255bfef95601890afd80709"
#: Rows of a kNN query block, and of the base that a task compares with the blocks at a time.
KNN_BLOCK, KNN_CHUNK = 4096, 16_384


def first_of_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each group of equal keys, the first in order."""
    top = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(top)).where("_n = 1").drop("_n")


def bands_together(n: int, m: int, most: int) -> int:
    """How many bands should agree for n rows to meet m: fewer keys a row against fewer rows a key, by what both cost.

    With t of most + t bands, a row has C(most + t, t) keys of 64 t / (most + t) bits.
    """
    cost = lambda t: comb(most + t, t) * (n + m + n * m / 2.0 ** (64 * t / (most + t)))
    return min(range(1, 7), key=cost)


def band_keys(fingerprint: Column, most: int, together: int) -> Column:
    """Keys of which two fingerprints at most so many bits apart share one: of most + together bands, ``together`` agree."""
    n = most + together
    edges = [round(64 * i / n) for i in range(n + 1)]
    band = lambda i: F.shiftrightunsigned(fingerprint, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
    return F.array(*[F.xxhash64(F.lit(j), *[band(i) for i in chosen]) for j, chosen in enumerate(combinations(range(n), together))])


def hamming_pairs(df: DataFrame, key: str, fingerprint: str, most: int, together: int | None = None) -> DataFrame:
    """a < b of key with fingerprints at most so many bits apart, and their distance; exact by the pigeonhole principle.

    Rows that share a band key meet in an equi-join; without ``together`` the count of the fingerprints sets how long
    the keys are. Equal fingerprints are one row there, so a value that a third of all rows has
    meets nobody twice; its rows are linked to the least of them, and other links are those of that least row.
    """
    rows = df.where(F.col(fingerprint).isNotNull()).select(F.col(key).alias("k"), F.col(fingerprint).alias("fp"))
    groups = materialize(rows.groupBy("fp").agg(F.min("k").alias("rep")))
    if together is None:
        n = groups.count()
        together = bands_together(n, n, most)
    banded = groups.withColumn("band", F.explode(band_keys(F.col("fp"), most, together)))
    a, b = banded.select("band", F.col("rep").alias("a"), F.col("fp").alias("fa")), banded.select("band", F.col("rep").alias("b"), F.col("fp").alias("fb"))
    near = a.join(b, "band").where((F.col("fa") < F.col("fb")) & (hamming(F.col("fa"), F.col("fb")) <= most))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), hamming(F.col("fa"), F.col("fb")).alias("distance")).distinct()
    same = rows.join(groups, "fp").where("k <> rep").select(F.col("rep").alias("a"), F.col("k").alias("b"), F.lit(0).alias("distance")).distinct()
    return near.union(same)


def hamming_components(df: DataFrame, key: str, fingerprint: str, most: int, together: int | None = None) -> DataFrame:
    """key, component: each row with the least key that it reaches over fingerprints at most so many bits apart; rows
    without a fingerprint are left out. The groups are those of all of ``hamming_pairs``, which may grow with the square
    of a group: here each bucket of a band key gives no more links than connect its rows, and copies none.
    """
    rows = df.where(F.col(fingerprint).isNotNull()).select(F.col(key).alias("k"), F.col(fingerprint).alias("fp"))
    groups = materialize(rows.groupBy("fp").agg(F.min("k").cast("long").alias("rep")))
    if together is None:
        n = groups.count()
        together = bands_together(n, n, most)
    banded = groups.select("rep", "fp", F.explode(band_keys(F.col("fp"), most, together)).alias("band"))
    links = banded.repartition("band").sortWithinPartitions("band").mapInArrow(lambda batches: _bucket_links(batches, most), "a long, b long")
    found = components(links)
    named = groups.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return rows.join(named, "fp").select(F.col("k").alias(key), "component")


def _bucket_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """In a task: links of the buckets in batches of rep, fp, band, whose rows follow each other by band."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        last = np.searchsorted(rows[2], rows[2, -1])  # the last bucket may go on in the next batch
        if last or held and held[-1][2, -1] != rows[2, -1]:
            yield _links(np.concatenate([*held, rows[:, :last]], axis=1), most)
            held = []
        held.append(rows[:, last:])
    if held:
        yield _links(np.concatenate(held, axis=1), most)


def _links(rows: np.ndarray, most: int) -> pa.RecordBatch:
    """Of whole buckets: all links of those of up to eight rows, and of larger ones the tree by which a search from each
    row not yet reached finds the others. A search meets a row with those alone that nothing has reached yet."""
    rep, fp, band = rows[0], rows[1].view(np.uint64), rows[2]
    starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
    sizes = np.diff(np.r_[starts, len(band)])
    left = np.repeat(np.where(sizes <= 8, sizes, 0), sizes) - (np.arange(len(band)) - np.repeat(starts, sizes))
    a, b = [], []
    for d in range(1, 8):
        i = np.flatnonzero(left > d)
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= most]
        a.append(i), b.append(i + d)
    for start, size in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
        ids, prints, queue = np.arange(start, start + size), fp[start : start + size], []
        while len(ids):
            if not queue:
                queue, ids, prints = [ids[-1]], ids[:-1], prints[:-1]
            one = queue.pop()
            near = np.bitwise_count(prints ^ fp[one]) <= most
            if near.any():
                new = ids[near]
                a.append(np.full(len(new), one)), b.append(new)
                queue.extend(new)
                ids, prints = ids[~near], prints[~near]
    return pa.RecordBatch.from_arrays([pa.array(rep[np.concatenate(a)]), pa.array(rep[np.concatenate(b)])], names=["a", "b"])


def rare_token_pairs(df: DataFrame, key: str, tokens: str, n: int) -> DataFrame:
    """a < b of key that share a token of 2 to min(8, max(3, n // 3)) rows; n: the rows of the batch.

    A token has at most eight rows, so a row makes at most seven pairs for each.
    """
    bound = min(8, max(3, n // 3))
    seen = df.select(F.col(key).alias("k"), F.explode(F.array_distinct(tokens)).alias("token"))
    rare = seen.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n").between(2, bound))
    kept = seen.join(rare, "token")
    pairs = kept.select("token", F.col("k").alias("a")).join(kept.select("token", F.col("k").alias("b")), "token").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared"))


def knn(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int = KNN_K) -> DataFrame:
    """q, key, cos, rank: the k rows of base nearest to each row of queries by cosine, itself left out; ties by key.

    The query set is written to the shared folder in blocks; tasks over base read the blocks one after the other and
    keep, for every KNN_CHUNK rows of theirs, the k best of each query, of which the few that are left are ranked.
    Exact, in one pass over base; nothing is collected, and a task holds a chunk and a block.
    """
    spark = queries.sparkSession
    path = shared_dir(spark)
    split = queries.select(F.col(key).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    split.repartition(max(1, -(-queries.count() // KNN_BLOCK))).write.parquet(path)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, KNN_CHUNK):
            keys, vectors = chunk.column(0).to_numpy(), _units(_matrix(chunk.column(1)))
            for block in read_blocks(path):
                ids = block.column(0).to_numpy()
                if not len(ids):
                    continue
                cos = np.round(_units(_matrix(block.column(1))) @ vectors.T, 12)
                cos[ids[:, None] == keys[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(keys, cos.shape), -cos), axis=1)[:, :k] if cos.shape[1] <= 64 else _first(cos, keys, k)
                c = np.take_along_axis(cos, order, 1).ravel()
                real = np.isfinite(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, order.shape[1])[real]), pa.array(keys[order.ravel()][real]), pa.array(c[real])], names=["q", key, "cos"])

    found = base.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias("v")).where("v is not null").mapInArrow(best, f"q long, {key} long, cos double")
    order = Window.partitionBy("q").orderBy(F.desc("cos"), key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            if sum(b.num_rows for b in held) >= rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column, all of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _first(cos: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k highest, ties by key: only those at least as high as the k-th are ordered."""
    if cos.shape[1] <= k:
        return np.lexsort((np.broadcast_to(keys, cos.shape), -cos), axis=1)
    least = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k]
    out = np.empty((len(cos), k), np.int64)
    for i, low in enumerate(least):
        some = np.flatnonzero(cos[i] >= low)
        out[i] = some[np.lexsort((keys[some], -cos[i, some]))[:k]]
    return out


def _units(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def worth_judging(cos: Column, token: Column, neighbour: Column) -> Column:
    """Whether a recalled pair goes to the judge."""
    return (cos >= COS_ANY) | (token & (cos >= COS_TOKEN)) | (neighbour & (cos >= COS_KNN))


def candidate_pairs(items: DataFrame, key: str, tokens: str, vector: str) -> DataFrame:
    """a < b, cos, tok, knn: pairs recalled by a rare token or as each other's near neighbours."""
    n = items.count()
    tok = rare_token_pairs(items, key, tokens, n).select("a", "b", F.lit(True).alias("tok"))
    near = knn(items, items, key, vector).select(F.least("q", key).alias("a"), F.greatest("q", key).alias("b"), F.lit(True).alias("knn")).distinct()
    both = tok.join(near, ["a", "b"], "full_outer")
    vectors = items.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    joined = both.join(vectors.toDF("a", "va"), "a").join(vectors.toDF("b", "vb"), "b")
    return joined.select("a", "b", F.greatest(F.lit(0.0), cosine(F.col("va"), F.col("vb"))).alias("cos"), F.coalesce("tok", F.lit(False)).alias("tok"), F.coalesce("knn", F.lit(False)).alias("knn"))


def same_day_clusters(items: DataFrame, pairs: DataFrame, key: str, fingerprint: str, judge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """key, component of one day's items: recalled pairs within NEAR bits, and those that the judge calls A or B.

    judge gets the at most MOST_JUDGED best pairs (a, b, cos), by cos and then key, and returns a, b, verdict.
    """
    fps = items.select(F.col(key).alias("k"), F.col(fingerprint).alias("fp"))
    known = pairs.join(fps.toDF("a", "fa"), "a").join(fps.toDF("b", "fb"), "b").withColumn("near", hamming(F.col("fa"), F.col("fb")) <= NEAR)
    links = known.where("near").select("a", "b")
    if judge:
        asked = known.where(~F.col("near") & worth_judging(F.col("cos"), F.col("tok"), F.col("knn"))).orderBy(F.desc("cos"), "a", "b").limit(MOST_JUDGED)
        links = links.union(judge(asked.select("a", "b", "cos")).where(F.col("verdict").isin("A", "B")).select("a", "b"))
    found = components(links).withColumnRenamed("node", key)
    return items.select(key).join(found, key, "left").withColumn("component", F.coalesce("component", F.col(key)))


def representatives(items: DataFrame, key: str, component: str, value: str) -> DataFrame:
    """Each component's row of the highest value, nulls as 0, then of the least key."""
    return first_of_group(items, [component], [F.coalesce(F.col(value), F.lit(0.0)).desc(), F.col(key)])


def judged(out_verdict: Column, confidence: Column) -> Column:
    """A judge's answer as A, B, C, LOWCONF or PARSE."""
    v = F.upper(F.trim(out_verdict))
    return F.when(~F.coalesce(v.isin("A", "B", "C"), F.lit(False)), "PARSE").when(F.coalesce(confidence, F.lit(0.0)) < LEAST_CONFIDENCE, "LOWCONF").otherwise(v)


def cascade(items: DataFrame, members: DataFrame, clusters: DataFrame, day: Column, judge: Column | None = None) -> DataFrame:
    """The decision of every item against the history as it stands.

    items: key, url_hash, simhash, vector or null. members: item_id, cluster_id, url_hash, simhash. clusters: cluster_id,
    state, expires_at, centroid or null. judge: an expression over key, cluster_id, cos giving A, B, C or null; without
    it gray stays gray.
    Adds verdict, via, cluster_id, cos. Order of decisions: exact hash in any cluster, first open cluster within NEAR
    bits, no open cluster, cosine over T_AUTO within NEAR_AUTO bits, judge over T_GRAY, else fresh. Exact and near need
    no vectors; an item without one that they leave is fresh by no_vector, and a cluster without one is never the nearest.
    """
    live = clusters.where((F.col("state") == "open") & (F.col("expires_at") >= day))
    exact = members.where((F.col("url_hash") != "") & (F.col("url_hash") != EMPTY_SHA1)).groupBy("url_hash").agg(F.min_by("cluster_id", "item_id").alias("exact_id"))
    rows = items.join(exact, "url_hash", "left")
    live_members = members.select("item_id", "cluster_id", F.col("simhash").alias("m")).join(live.select("cluster_id"), "cluster_id", "left_semi")
    # within NEAR bits, by band keys; one fingerprint of a cluster is enough, and its least cluster
    fps = materialize(live_members.groupBy("m").agg(F.min("cluster_id").alias("near_id")))
    wanted = materialize(rows.where(F.col("exact_id").isNull()).select("simhash").distinct())
    together = bands_together(wanted.count(), fps.count(), NEAR)
    keys = lambda df, c: df.withColumn("band", F.explode(band_keys(F.col(c), NEAR, together)))
    met = keys(wanted, "simhash").join(keys(fps, "m"), "band").where(hamming(F.col("simhash"), F.col("m")) <= NEAR)
    near = met.groupBy("simhash").agg(F.min("near_id").alias("near_id"))
    rows = rows.join(near, "simhash", "left")
    # the query set, items that nothing cheaper decides, against all open centroids in blocks
    open_vectors = live.where("centroid is not null").select(F.col("cluster_id").alias("id"), F.col("centroid").alias("v"))
    left = rows.where("exact_id is null and near_id is null and vector is not null").select(F.col("key").alias("id"), F.col("vector").alias("v"))
    apart = left.select((-F.col("id") - 1).alias("id"), "v")  # item ids apart from cluster ids
    best = knn(apart, open_vectors, "id", "v", 1).select((-F.col("q") - 1).alias("key"), F.col("id").alias("best_id"), "cos")
    rows = rows.join(best, "key", "left")
    per_cluster = rows.where("best_id is not null").select("key", "simhash", F.col("best_id").alias("cluster_id")).join(live_members, "cluster_id")
    bits = per_cluster.groupBy("key").agg(F.min(hamming(F.col("simhash"), F.col("m"))).alias("bits"))
    rows = rows.join(bits, "key", "left")
    answer = judge if judge is not None else F.lit(None).cast("string")
    c, auto = F.col("cos"), (F.col("cos") >= T_AUTO) & (F.coalesce("bits", F.lit(64)) <= NEAR_AUTO)
    decided = rows.withColumn("cluster_id", F.coalesce("exact_id", "near_id", F.when(c >= T_GRAY, F.col("best_id")))).withColumn("_j", answer)
    via = (
        F.when(F.col("exact_id").isNotNull(), "dup_exact").when(F.col("near_id").isNotNull(), "dup_near").when(F.col("vector").isNull(), "no_vector").when(F.col("best_id").isNull(), "no_history")
        .when(auto, "dup_same").when((c >= T_GRAY) & (F.col("_j") == "A"), "judge_a").when((c >= T_GRAY) & (F.col("_j") == "B"), "judge_b")
        .when((c >= T_GRAY) & (F.col("_j") == "C"), "judge_c").when(c >= T_GRAY, "judge_na").otherwise("embed_lo")
    )
    out = decided.withColumn("via", via)
    fresh = F.col("via").isin("no_history", "no_vector", "judge_c", "embed_lo")
    verdict = F.when(F.col("via").isin("dup_exact", "dup_near", "dup_same", "judge_a"), "suppressed").when(F.col("via") == "judge_b", "reissue").when(F.col("via") == "judge_na", "gray").otherwise("fresh")
    shown = F.when(F.col("via").isin("dup_exact", "dup_near", "no_history", "no_vector"), None).otherwise(F.round("cos", 4))
    return out.select(*items.columns, verdict.alias("verdict"), "via", F.when(~fresh, F.col("cluster_id")).alias("cluster_id"), shown.alias("cos"))


def cascade_in_order(items: DataFrame, members: DataFrame, clusters: DataFrame, judge: Callable[[int, int, float], str | None] | None = None) -> DataFrame:
    """The cascade in the order of ``ord``: every item is compared with the history and the items before it.

    items: episode, ord, key, url_hash, simhash, vector; members and clusters as in ``cascade``, with open clusters
    only. One task per episode, as each decision changes what the next one meets; an item meets the history in array
    operations. Returns episode, key, verdict, via, cluster_id, cos.
    """
    names = ["episode", "kind", "ord", "key", "url_hash", "simhash", "vector", "cluster_id"]
    past = members.join(clusters.select("cluster_id", "centroid"), "cluster_id").select(F.lit(0).alias("kind"), F.col("item_id").cast("long").alias("ord"), F.col("item_id").cast("long").alias("key"), "url_hash", "simhash", F.col("centroid").cast("array<double>").alias("vector"), F.col("cluster_id").cast("long").alias("cluster_id"))
    new = items.select("episode", F.lit(1).alias("kind"), F.col("ord").cast("long").alias("ord"), F.col("key").cast("long").alias("key"), "url_hash", "simhash", F.col("vector").cast("array<double>").alias("vector"), F.lit(None).cast("long").alias("cluster_id"))
    rows = new
    for (episode,) in items.select("episode").distinct().collect():  # days
        rows = rows.unionByName(past.withColumn("episode", F.lit(episode)).select(*names))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["kind", "ord"])
        old, fresh = pdf[pdf.kind == 0], pdf[pdf.kind == 1]
        store = _Store(old, len(fresh))
        out = []
        for r in fresh.itertuples():
            v, h = np.asarray(r.vector, float), r.url_hash or ""
            found = store.compare(v, int(r.simhash))
            cos, via, cid, verdict = None, "no_history", None, "fresh"
            if h and h != EMPTY_SHA1 and h in store.exact:
                via, cid, verdict = "dup_exact", store.exact[h], "suppressed"
            elif found["near"] is not None:
                via, cid, verdict = "dup_near", found["near"], "suppressed"
            elif found["top"] is not None:
                top, cos = found["top"], round(found["cos"], 4)
                if found["cos"] >= T_AUTO and found["bits"] <= NEAR_AUTO:
                    via, cid, verdict = "dup_same", top, "suppressed"
                elif found["cos"] >= T_GRAY:
                    answer = judge(int(r.key), top, found["cos"]) if judge else None
                    via, cid, verdict = {"A": ("judge_a", top, "suppressed"), "B": ("judge_b", top, "reissue"), "C": ("judge_c", None, "fresh")}.get(answer, ("judge_na", top, "gray"))
                else:
                    via = "embed_lo"
            cid = store.add(cid, v, int(r.simhash), h)
            out.append((r.episode, int(r.key), verdict, via, cid, cos))
        return pd.DataFrame(out, columns=["episode", "key", "verdict", "via", "cluster_id", "cos"]).astype({"cos": float})

    return rows.groupBy("episode").applyInPandas(run, "episode string, key long, verdict string, via string, cluster_id long, cos double")


class _Store:
    """The open clusters and their members' fingerprints as arrays with room for an episode's own."""

    def __init__(self, old: pd.DataFrame, room: int) -> None:
        self.exact: dict[str, int] = {}
        for h, c in zip(old.url_hash, old.cluster_id, strict=True):
            self.exact.setdefault(h or "", int(c))
        first = old.drop_duplicates("cluster_id").sort_values("cluster_id")
        self.ids = np.concatenate([first.cluster_id.to_numpy(np.int64), np.zeros(room, np.int64)])
        self.clusters, self.place = len(first), {int(c): i for i, c in enumerate(first.cluster_id)}
        self.counts = np.zeros(len(self.ids), np.int64)
        for c, n in old.cluster_id.value_counts().items():
            self.counts[self.place[int(c)]] = n
        self.centres: np.ndarray | None = None
        if self.clusters:
            self.centres = np.zeros((len(self.ids), len(first.vector.iloc[0])))
            self.centres[: self.clusters] = np.stack([np.asarray(x, float) for x in first.vector])
        self.fps = np.concatenate([old.simhash.to_numpy(np.int64).view(np.uint64), np.zeros(room, np.uint64)])
        self.owner = np.concatenate([old.cluster_id.to_numpy(np.int64), np.zeros(room, np.int64)])
        self.members = len(old)

    def compare(self, v: np.ndarray, simhash: int) -> dict:
        """near: the least cluster with a member within NEAR bits; top, cos, bits: the nearest by cosine, the least of equal
        ones, and its nearest member."""
        bits = np.bitwise_count(self.fps[: self.members] ^ np.int64(simhash).view(np.uint64))
        owner = self.owner[: self.members]
        near = owner[bits <= NEAR]
        found = {"near": int(near.min()) if len(near) else None, "top": None}
        if self.clusters:
            centres = self.centres[: self.clusters]
            norms = np.linalg.norm(centres, axis=1) * np.linalg.norm(v)
            cos = np.where(norms > 0, centres @ v / np.where(norms > 0, norms, 1), 0.0)
            ids = self.ids[: self.clusters]
            top = int(ids[cos == cos.max()].min())
            found |= {"top": top, "cos": float(cos.max()), "bits": int(bits[owner == top].min(initial=64))}
        return found

    def add(self, cid: int | None, v: np.ndarray, simhash: int, h: str) -> int:
        """Stores an item in its cluster, or in a new one behind the last."""
        if cid is None:
            cid = int(self.ids[: self.clusters].max(initial=0)) + 1
            if self.centres is None:
                self.centres = np.zeros((len(self.ids), len(v)))
            self.place[cid] = self.clusters
            self.ids[self.clusters], self.centres[self.clusters], self.counts[self.clusters] = cid, v, 1
            self.clusters += 1
        elif cid in self.place:
            i = self.place[cid]
            total = self.centres[i] * self.counts[i] + v
            self.centres[i], self.counts[i] = total / max(np.linalg.norm(total), 1e-300), self.counts[i] + 1
        self.fps[self.members], self.owner[self.members] = np.int64(simhash).view(np.uint64), cid
        self.members += 1
        self.exact.setdefault(h, cid)
        return cid


def recompute_clusters(members: DataFrame, ttl_days: int = TTL_DAYS) -> DataFrame:
    """cluster_id, centroid, item_count, n_reissues, published, first_seen, last_seen, expires_at from the members
    (cluster_id, vector, verdict, day)."""
    sums = members.groupBy("cluster_id").agg(
        F.count("*").alias("item_count"), F.count_if(F.col("verdict") == "reissue").alias("n_reissues"), F.bool_or(F.col("verdict") == "reported").alias("published"),
        F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.date_add(F.max("day"), ttl_days).alias("expires_at"),
    )
    return sums.join(mean_unit(members, "cluster_id", "vector"), "cluster_id")


def expire(clusters: DataFrame, today: Column, ttl_days: int = TTL_DAYS) -> DataFrame:
    """Open clusters live ttl_days past last_seen; those whose time has passed are expired."""
    until = F.when(F.col("state") == "open", F.date_add("last_seen", ttl_days)).otherwise(F.col("expires_at"))
    return clusters.withColumn("expires_at", until).withColumn("state", F.when((F.col("state") == "open") & (F.col("expires_at") < today), "expired").otherwise(F.col("state")))


def unexpire(clusters: DataFrame, today: Column) -> DataFrame:
    return clusters.withColumn("state", F.when((F.col("state") == "expired") & (F.col("expires_at") >= today), "open").otherwise(F.col("state")))


def merge_clusters(members: DataFrame, kept: int, gone: int) -> DataFrame:
    return members.withColumn("cluster_id", F.when(F.col("cluster_id") == gone, kept).otherwise(F.col("cluster_id")))


def split_cluster(members: DataFrame, cluster: int, new: int) -> DataFrame:
    """Members of the cluster's last day move to a new one, unless they are one or all of a cluster that can't be split."""
    own = F.col("cluster_id") == cluster
    w = Window.partitionBy("cluster_id")
    marked = members.withColumn("_last", F.max("day").over(w)).withColumn("_all", F.count("*").over(w)).withColumn("_moved", F.count_if(F.col("day") == F.col("_last")).over(w))
    moves = own & (F.col("day") == F.col("_last")) & (F.col("_all") > 1) & (F.col("_moved") < F.col("_all"))
    return marked.withColumn("cluster_id", F.when(moves, new).otherwise(F.col("cluster_id"))).drop("_last", "_all", "_moved")


def purge_day(members: DataFrame, day: Column) -> DataFrame:
    return members.where(F.col("day") != day)


def one_per_url_and_day(members: DataFrame) -> DataFrame:
    """The least item_id of each url_hash and day; empty hashes are exempt."""
    named = F.coalesce(F.col("url_hash"), F.lit("")).isin("", EMPTY_SHA1)
    return first_of_group(members.where(~named), ["url_hash", "day"], [F.col("item_id")]).unionByName(members.where(named))


def replay(items: DataFrame, members: DataFrame) -> DataFrame:
    """Items with the stored verdict of the same url_hash and day, where there is one: the earliest."""
    stored = members.groupBy("url_hash", "day").agg(F.min_by(F.struct("verdict", "cluster_id"), "item_id").alias("r"))
    shown = F.when(F.col("r.verdict").isin("candidate", "reported"), "fresh").when(F.col("r.verdict") == "gray_pending", "gray").otherwise(F.col("r.verdict"))
    return items.join(stored, ["url_hash", "day"], "left").withColumn("replayed", shown).withColumn("cluster_id", F.col("r.cluster_id")).drop("r")


def history_text(members: DataFrame, most: int = 6, each: int = 160, cap: int = 400) -> DataFrame:
    """cluster_id -> the distinct summaries of its first members by day and item_id, joined and cut."""
    first = Window.partitionBy("cluster_id").orderBy("day", "item_id")
    rows = members.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most)
    texts = F.array_sort(F.collect_list(F.struct("_n", F.substring(F.coalesce("summary", F.lit("")), 1, each).alias("s"))))
    named = F.array_distinct(F.filter(F.transform(texts, lambda x: x["s"]), lambda s: s != ""))
    return rows.groupBy("cluster_id").agg(F.substring(F.array_join(named, " / "), 1, cap).alias("history"))


def gray_pairs(decided: DataFrame) -> DataFrame:
    """Of a cascade's decisions without a judge, those that a judge should be asked about, the surest first."""
    return decided.where(F.col("via") == "judge_na").select("key", "cluster_id", "cos").orderBy(F.desc("cos"), "key")
