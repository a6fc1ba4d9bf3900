import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendscope.llm import lm_score as lm

LOW = {65 + i: 97 + i for i in range(26)}


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [("end",)]


def grams(t, order):
    seq = [("start",)] * (order - 1) + tokens(t)
    return [tuple(seq[i:i + order]) for i in range(len(seq) - order + 1)]


def brute(train, order=2):
    """Interpolated modified Kneser-Ney n-grams, plainly: counts of words, and the
    probability of a word after the order - 1 words before it."""
    count = Counter(w for t in train for w in tokens(t))
    of = {order: Counter(g for t in train for g in grams(t, order))}
    for k in range(order - 1, 0, -1):
        of[k] = Counter(g[1:] for g in of[k + 1])
    d = {k: [0, *lm._discounts(*(Counter(c.values())[n] for n in (1, 2, 3, 4)))] for k, c in of.items()}
    total, taken = Counter(), Counter()
    for k, c in of.items():
        for g, n in c.items():
            total[k, g[:-1]] += n
            taken[k, g[:-1]] += d[k][min(n, 3)]

    def prob(*g):
        k = len(g)
        if k == 0:
            return 1 / (len(count) + 1)
        if not total[k, g[:-1]]:
            return prob(*g[1:])
        n = of[k][g]
        return (max(n - d[k][min(n, 3)], 0) + taken[k, g[:-1]] * prob(*g[1:])) / total[k, g[:-1]]
    return count, prob


def test_scores_match_brute_force(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    train = [t for i, t in rows.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count, prob = brute(train)
    n, v = sum(count.values()), len(count)
    got = lm.lm_scores(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        seq = tokens(rows[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(seq), sum(w in count for w in seq), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in seq))
        assert r.score == pytest.approx(sum(math.log10(prob(*g)) for g in grams(rows[r.doc_id], 2)))


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    count, prob = brute(["a b a b c", "b c d", "a a a b", "e"], order)
    for v in [("start",), *count, "unseen"]:
        for context in [(v,)] if order == 2 else [(("start",), v), ("a", v), ("b", v), (v, "a")]:
            total = sum(prob(*context, w) for w in count) + prob(*context, "unseen word")
            assert total == pytest.approx(1.0)


@pytest.mark.parametrize("order", [3, 4])
def test_higher_orders_match_brute_force(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    _, prob = brute([t for i, t in rows.items() if zlib.crc32(str(i).encode()) % 7 != 2], order)
    got = lm.lm_scores(docs, order).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(sum(math.log10(prob(*g)) for g in grams(rows[r.doc_id], order)))


def test_shards_follow_the_size_of_the_texts(docs_of, monkeypatch):
    rows = [(i, f"word{i} and word{i * 7 % 50} stand here") for i in range(200)]
    docs = docs_of(rows)
    few = lm.train(docs, order=3)
    monkeypatch.setattr(lm, "SHARD_BYTES", 100)
    many = lm.train(docs, order=3)
    assert many.shards == -(-sum(len(t) for _, t in rows) // 100) > few.shards
    both = [{r.doc_id: r.score for r in lm.score_texts(docs, m, F.lit(False)).collect()} for m in (few, many)]
    assert both[0] == pytest.approx(both[1])
    with pytest.raises(ValueError, match="order"):
        lm.train(docs, order=1)


def test_awkward_rows_and_no_training(awkward):
    got = lm.lm_scores(awkward).collect()
    assert len(got) == awkward.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    empty = lm.train(awkward.limit(0))
    none = lm.score_texts(awkward, empty, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)
    assert lm.lm_scores(awkward.limit(0)).count() == 0
    got = lm.lm_scores(awkward, 3).collect()
    assert len(got) == awkward.count() and all(math.isfinite(r.score) for r in got)


def test_large_counts_are_kept_whole(docs_of):
    rows = [(i, "so very often " * 40) for i in range(30)] + [(99, "so rare")]
    docs = docs_of(rows)
    count, prob = brute([t for _, t in rows])
    model = lm.train(docs)
    got = {r.doc_id: r for r in lm.score_texts(docs, model, F.lit(False)).collect()}
    for i, t in rows:
        assert got[i].score == pytest.approx(sum(math.log10(prob(*g)) for g in grams(t, 2)))
