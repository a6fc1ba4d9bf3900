import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendscope.llm import embedding_whitening as ew
from lendscope.llm.secular import Spectrum, secular_roots, update

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, dim, components=8):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and
            all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(np.array([v for _, v in kept], float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    dev = [int(sum(int(c) ** 2 for c in row)) for row in (n * x - sums)]
    return [i for i, _ in kept], n, dev, centred @ axes / np.sqrt(values), values, (centred ** 2).sum() / n


def check(rows, got, dim, components=8):
    ids, n, dev, white, values, trace = brute(rows, dim, components)
    assert len(got) == len(ids) * components and {r.n for r in got} == {n}
    by = {(r.vec_id, r.component): r for r in got}
    assert sorted(r.component for r in got) == sorted(list(range(1, components + 1)) * len(ids))
    for k in range(components):
        mine = np.array([by[i, k + 1].whitened for i in ids])
        at = np.abs(white[:, k]).argmax()
        assert np.abs(mine * np.sign(mine[at] * white[at, k]) - white[:, k]).max() < 1e-8
        assert {by[i, k + 1].explained for i in ids} == {by[ids[0], k + 1].explained}
        assert by[ids[0], k + 1].explained == pytest.approx(values[k] / trace, rel=1e-10)
    assert [by[i, 1].deviation for i in ids] == dev
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_given_table_matches_eigh(spark, sf_small):
    v = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in v.collect()], ew.whiten(v).collect(), 64)


def test_partitions_are_merged(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(120, 10)) * np.arange(1, 11)
    rows = [(i, data[i].astype(np.float32).tolist(), 0) for i in range(120)]
    df = spark.createDataFrame(rows, VECTORS).repartition(20)  # more than FAN * FAN parts need three rounds
    check([r[:2] for r in rows], ew.whiten(df).collect(), 10)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i, (rng.normal(size=9) * np.arange(1, 10)).astype(np.float32).tolist()) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [nan] * 9), (103, [None] + [1.0] * 8), (104, [inf] * 9), (105, [1.0] * 3),
           (106, [1e20] * 9)]
    df = (spark.createDataFrame([(*r, 0) for r in good + bad], VECTORS).withColumn("x", F.lit("clash"))
          .withColumn("n", F.lit("y")).withColumn("part", F.lit(1)))
    check(good, ew.whiten(df).collect(), 9)
    twice = df.unionByName(df.where("vec_id = 3"))
    got = [r for r in ew.whiten(twice).collect() if r.vec_id == 3]
    assert len(got) == 16 and len({(r.component, r.whitened) for r in got}) == 8 and got[0].n == 41
    none = df.withColumn("vec_id", F.when(F.col("vec_id") > 2, F.col("vec_id")))
    assert sum(r.vec_id is None for r in ew.whiten(none).collect()) == 24


def test_missing_variance(spark):
    def rows(vectors):
        return ew.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS)).collect()
    assert rows([]) == [] and rows([[1.0, 2.0]]) == [] and rows([[1.0, 2.0]] * 5) == [] and rows([None]) == []
    line = rows([[float(i), 2.0 * i, 0.0] for i in range(10)])  # rank one
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1) and len(line) == 10


def test_deviation_beyond_a_long():
    x = np.array([[1 << 39, 0], [0, 5]])
    assert ew._deviations(x, 2, [1 << 39, 5]) == [None, None]
    x = np.array([[100_500, 99_000], [99_500, 101_000]])
    assert ew._deviations(x, 2, [200_000, 200_000]) == [1000 ** 2 + 2000 ** 2] * 2


@given(st.integers(1, 9), st.integers(0, 10 ** 6), st.sampled_from(["plain", "equal", "tiny", "graded"]))
@settings(max_examples=150, deadline=None)
def test_updates_match_eigh(k, seed, kind):
    rng = np.random.default_rng(seed)
    d = np.sort(rng.exponential(size=k))
    v = rng.normal(size=k)
    if kind == "equal":
        d = np.sort(np.repeat(d[: k // 2 + 1], 2)[:k])
    elif kind == "tiny":
        v *= 10.0 ** -rng.integers(0, 25, size=k)
        d[: k // 2] = d[0] * (1 + 1e-15 * np.arange(k // 2))
    elif kind == "graded":
        d = np.sort(10.0 ** rng.uniform(-18, 3, size=k))
    u = np.linalg.qr(rng.normal(size=(k, k)))[0]
    dense = (u * d) @ u.T + 1.7 * np.outer(v, v)
    new, vectors = update(d, u, v, 1.7)
    scale = max(np.abs(dense).max(), 1e-300)
    assert np.all(np.diff(new) >= 0) and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs((vectors * new) @ vectors.T - dense).max() < 1e-13 * scale * k
    assert np.abs(np.linalg.eigvalsh(dense) - new).max() < 1e-13 * scale * k


def test_roots_interlace():
    d = np.array([0.0, 1e-12, 1.0, 1.0 + 1e-9, 50.0])
    roots, delta = secular_roots(d, np.array([1.0, 1e-5, 2.0, 1e-7, 0.5]), 1.0)
    assert np.all(roots >= d) and np.all(roots[:-1] <= d[1:]) and np.all(np.isfinite(delta)) and np.all(delta != 0)


def test_merge_equals_one_pass():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 6)) * 50 + 100_000
    parts = [Spectrum(6) for _ in range(3)]
    for i, row in enumerate(x):
        parts[min(i // 20, 2)].add(row)
    whole = Spectrum(6)
    for p in [Spectrum(6), *parts, Spectrum(6)]:
        whole.merge(p)
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    assert whole.n == 90 and np.allclose(whole.mean, x.mean(0), rtol=1e-14)
    assert np.abs((whole.u * whole.d) @ whole.u.T - want).max() < 1e-11 * np.abs(want).max()
