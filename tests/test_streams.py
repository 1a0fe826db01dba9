import datetime as dt

from pyspark.sql import functions as F

from lodestream.operators import dedup, pool
from lodestream.plans import storage
from lodestream.streaming import pool_stream


def test_pool_versions_and_replay(spark, tmp_path):
    """Three micro-batches leave two versions, and the last equals the upserts one after the other."""
    schema = "item_key string, title string, content_sha string, ord int"
    parts = [[("a", "t", "1", 1), ("b", "t", "1", 2)], [("a", "u", "2", 3)], [("c", "v", "1", 4), ("a", "w", "2", 5)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/p={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/p=*"))
    for _ in range(2):  # a second run finds nothing new
        pool_stream.keep_pool(spark, stream, str(tmp_path / "pool"), str(tmp_path / "ck"), "ord").awaitTermination(120)
    assert sorted(p.name for p in (tmp_path / "pool").iterdir()) == ["v=1", "v=2"]
    got = {r.item_key: r.title for r in spark.read.parquet(str(tmp_path / "pool/v=2")).collect()}
    want = spark.createDataFrame([], "item_key string, title string, content_sha string")
    for rows in parts:
        want = pool.upsert(want, spark.createDataFrame(rows, schema), F.col("ord"))
    assert got == {r.item_key: r.title for r in want.collect()} == {"a": "w", "b": "t", "c": "v"}


def test_clusters_expire_by_timer(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    parts = [[("x", day(0)), ("y", day(0))], [("y", day(10)), ("x", day(1))], [("z", day(25))], [("z", day(26))], [("z", day(50))], [("z", day(51))]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/p={i}"))
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/p=*")).withWatermark("ts", "1 day")
    pool_stream.final(pool_stream.expired_clusters(stream, "k", "ts", 21), str(tmp_path / "run"), "append").awaitTermination(180)
    got = {r.k: r.last_seen for r in spark.read.parquet(str(tmp_path / "run/out/*")).collect()}
    assert got["x"] == day(1) and got["y"] == day(10)


def test_scratch_folders_go(spark):
    with storage.scratch(spark):
        df = storage.materialize(spark.range(10))
        path = df.inputFiles()[0].rpartition("/")[0]
        assert df.count() == 10
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def test_in_order_equals_one_by_one(spark):
    """The arrays of the sequential cascade against a plain loop over dicts."""
    import numpy as np

    r = np.random.default_rng(0)
    base = r.integers(-(2**62), 2**62, 12)
    vec = lambda: (r.normal(size=6) + 2 * np.eye(6)[int(r.integers(3))]).tolist()
    near = lambda: int(base[int(r.integers(12))]) ^ int(sum(1 << int(b) for b in set(r.integers(0, 62, int(r.integers(0, 9))).tolist())))
    members = [(i, i // 2, f"h{i}", int(base[i % 12])) for i in range(8)]
    centres = [(c, vec()) for c in range(4)]
    items = [("e", i, 100 + i, f"h{int(r.integers(40))}", near(), vec()) for i in range(40)]
    exact, fps, centre, count, want = {}, [], dict(centres), {}, {}
    for _, c, h, s in members:
        exact.setdefault(h, c)
        fps.append((s, c))
        count[c] = count.get(c, 0) + 1
    centre = {c: np.array(v) for c, v in centre.items()}
    for _, _, key, h, s, v in items:
        v = np.array(v)
        bits = [((f ^ s) & (2**64 - 1)).bit_count() for f, _ in fps]
        close = [c for (_, c), b in zip(fps, bits, strict=True) if b <= dedup.NEAR]
        score = {c: v @ u / np.linalg.norm(v) / np.linalg.norm(u) for c, u in sorted(centre.items())}
        top = max(score, key=score.get)
        nearest = min((b for (_, c), b in zip(fps, bits, strict=True) if c == top), default=64)
        if h in exact:
            via, cid = "dup_exact", exact[h]
        elif close:
            via, cid = "dup_near", min(close)
        elif score[top] >= dedup.T_AUTO and nearest <= dedup.NEAR_AUTO:
            via, cid = "dup_same", top
        elif score[top] >= dedup.T_GRAY:
            via, cid = ("judge_a", top) if key % 2 else ("judge_c", None)
        else:
            via, cid = "embed_lo", None
        if cid is None:
            cid = max(centre) + 1
            centre[cid], count[cid] = v, 1
        else:
            total = centre[cid] * count[cid] + v
            centre[cid], count[cid] = total / np.linalg.norm(total), count[cid] + 1
        fps.append((s, cid))
        exact.setdefault(h, cid)
        want[key] = (via, cid)
    m = spark.createDataFrame(members, "item_id long, cluster_id long, url_hash string, simhash long")
    c = spark.createDataFrame(centres, "cluster_id long, centroid array<double>")
    rows = spark.createDataFrame(items, "episode string, ord long, key long, url_hash string, simhash long, vector array<double>")
    got = {x.key: (x.via, x.cluster_id) for x in dedup.cascade_in_order(rows, m, c, lambda key, cluster, cos: "A" if key % 2 else "C").collect()}
    assert got == want and len({v for v, _ in want.values()}) >= 4


def test_bands_grow_with_rows():
    small, large = dedup.bands_together(1000, 1000, 4), dedup.bands_together(10**9, 10**9, 4)
    assert small < large


def test_hamming_pairs_for_every_number_of_bands(spark):
    import numpy as np

    r = np.random.default_rng(1)
    base = r.integers(-(2**62), 2**62, 20)
    fps = [int(b) ^ sum(1 << int(x) for x in set(r.integers(0, 62, k).tolist())) for b in base for k in range(7)]
    df = spark.createDataFrame(list(enumerate(fps)), "k long, fp long")
    want = {(i, j) for i, x in enumerate(fps) for j, y in enumerate(fps) if i < j and ((x ^ y) & (2**64 - 1)).bit_count() <= 4}
    for t in (1, 2, 4):
        assert {(x.a, x.b) for x in dedup.hamming_pairs(df, "k", "fp", 4, t).collect()} == want
