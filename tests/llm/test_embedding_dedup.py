import numpy as np
from pyspark.sql import functions as F

from lendscope.llm import embedding_dedup as ed, hnsw
from lendscope.llm.words import mix
from test_near_dedup import union


def vectors(seed=1):
    rnd = np.random.default_rng(seed)
    x = rnd.standard_normal((300, 24))
    tight = x[0] + 0.25 * rnd.standard_normal((120, 24)) * np.abs(x[0]).mean()
    pairs = x[10:60] + 0.2 * rnd.standard_normal((50, 24))
    copies = np.repeat(x[5:6], 90, 0)
    return np.concatenate([x, tight, pairs, copies, 3 * x[100:110]])


def test_links_match_brute_force(spark):
    x = vectors()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in ed.embedding_components(df, min_shards=3).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.argwhere(near)
    assert sum(r.n_links for r in got.values()) >= 0.99 * near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in got)
    want = union(range(len(x)), links.tolist())
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [1e200, 1e-200]), (11, [1.0, 0.0, 0.0]),
            (12, [-1.0, 0.0]), (None, [1.0, 0.0]), (13, [1e-300, 0.0])]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<double>")
          .withColumn("n_links", F.lit("clash")).withColumn("rep", F.lit(0)).withColumn("dim", F.lit("d")))
    got = ed.embedding_components(df).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert all(by_id[i] == (0, i) for i in (1, 2, 3, 4, 5, 6, 11, 12))
    assert all(by_id[i] == (4, 7) for i in (7, 8, 9, 10, 13))
    assert ed.embedding_components(df.limit(0)).count() == 0


def test_graph_recall_by_audit():
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, order = hnsw.build(x, mix(np.arange(3000, dtype=np.uint64)))
    assert sorted(order.tolist()) == list(range(3000)) and len(graph.layers) > 1
    ef, recall = ed._audit(graph, 0.9)
    assert recall >= ed.AUDIT_RECALL and ef < 3000


def test_an_id_with_two_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.99, 0.05, 0.0]), (3, [0.05, 0.99, 0.0]), (4, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.embedding_components(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_a_shard_whose_audit_fails_is_scanned(spark, monkeypatch):
    monkeypatch.setattr(ed, "_audit", lambda graph, threshold: (len(graph.x), 0.5))
    x = vectors(3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in ed.embedding_components(df, min_shards=3, shard_bytes=20_000).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert all(got[i].n_links == near[i].sum() for i in got)  # exact, so nothing is missed
    assert {i: r.component_id for i, r in got.items()} == union(range(len(x)), np.argwhere(near).tolist())
