import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from lendscope.llm import minhash_dedup as md
from lendscope.llm.components import components

LOW = {65 + i: 97 + i for i in range(26)}


def multiset(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least) if a and b else 0.0


def union(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute(rows):
    sets = {i: multiset(t) for i, t in rows}
    return union(sets, [(a, b) for a, b in combinations(sorted(sets), 2) if similarity(sets[a], sets[b]) >= 0.8])


def corpus(seed=3):
    """Families of near copies, chains that drift away, shared passages, unrelated texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows, passage = [], [word() for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(20, 300))]
        for _ in range(rnd.randint(1, 7)):
            t = list(base)
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = word()
            rows.append(" ".join(t))
    drift = [word() for _ in range(200)]
    for _ in range(12):
        drift[rnd.randrange(len(drift))] = word()
        drift[rnd.randrange(len(drift))] = word()
        rows.append(" ".join(drift))
    for _ in range(15):
        rows.append(" ".join(passage + [word() for _ in range(rnd.randint(5, 90))]))
    rows += ["one two three", "One, two THREE!", "one two", "solo", "the same line again " * 40,
             "the same line again " * 43, "the same line again " * 90]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_classes_match_brute_force(docs_of):
    rows = corpus()
    got = {r.doc_id: r for r in md.near_duplicate_classes(docs_of(rows)).collect()}
    want = brute(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_collisions_estimate_weighted_jaccard():
    rnd = np.random.default_rng(5)
    elems = np.sort(rnd.integers(1, 1 << 62, 300).astype(np.uint64))
    a = (elems[:220], rnd.integers(1, 6, 220))
    b = (elems[60:], np.concatenate([a[1][60:], rnd.integers(1, 6, 80)]))
    b[1][:40] += 2
    true = md.weighted_jaccard(md.packed(*a), md.packed(*b))
    sig = md.signatures([a, b, (elems[:3], np.array([1, 1, 2]))], 2000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(true, abs=0.04)
    assert len(np.unique(sig[2])) > 2 and (sig != 0).all()


def test_components_of_paths_stars_and_cycles(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(200, 201), (201, 202), (202, 200)]
    links += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(70)] + [(5, 5)]
    links = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in links]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == union({x for p in real for x in p}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(awkward):
    got = md.near_duplicate_classes(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].kept for i in (1, 2, 3, 4, 9)) and by_id[6].class_id == 5 and not by_id[6].kept
    kept = md.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, None, 8, 9, 10}
    assert md.near_duplicate_classes(awkward.limit(0)).count() == 0


def family(seed, n, edits, length=120):
    """Copies of one text with edits at random places, and texts that share a passage."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    base, passage, rows = [word() for _ in range(length)], [word() for _ in range(90)], []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randint(0, edits)):
            t[rnd.randrange(len(t))] = word()
        rows.append(" ".join(t))
    rows += [" ".join(passage + [word() for _ in range(rnd.randint(8, 40))]) for _ in range(n // 2)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small,block", [(16, 1024), (2, 7), (10_000, 1024)])
def test_large_buckets_lose_no_link(docs_of, monkeypatch, small, block):
    """Hundreds of members of a bucket lie between 0.6 and 1: block by block, in many blocks, or as pairs."""
    monkeypatch.setattr(md, "SMALL", small)
    monkeypatch.setattr(md, "BLOCK", block)
    rows = family(1, 160, 6)
    got = {r.doc_id: r.class_id for r in md.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_rows_that_leave_a_large_bucket_grow_in_proportion(docs_of, monkeypatch):
    """Twice the family: about twice the pairs that are verified, not four times (a
    smaller one doesn't fill the ``NEAREST`` pairs of its strays yet)."""
    seen = []
    whole = md.verified
    monkeypatch.setattr(md, "verified", lambda pairs, *a: (seen.append(pairs.count()), whole(pairs, *a))[1])
    counts = []
    for n in (600, 1200):
        seen.clear()
        md.near_duplicate_classes(docs_of(family(2, n, 6))).count()
        counts.append(sum(seen))
    assert counts[1] < 3 * counts[0]


def test_no_pair_is_verified_twice(docs_of, monkeypatch):
    """The second pass takes the strays that had more pairs than the first gave, and
    only pairs that were not verified yet; where no stray had more, there is none."""
    seen, passes = [], []
    whole, pairs_of = md.verified, md._stray_pairs
    monkeypatch.setattr(md, "verified", lambda pairs, *a: (seen.extend((r.a, r.b) for r in pairs.collect()), whole(pairs, *a))[1])
    monkeypatch.setattr(md, "_stray_pairs", lambda *a: (passes.append(1), pairs_of(*a))[1])
    for nearest, least, most in ((2, 2, 2), (10_000, 1, 1)):
        monkeypatch.setattr(md, "NEAREST", nearest)
        seen.clear()
        passes.clear()
        rows = family(1, 160, 6)
        got = {r.doc_id: r.class_id for r in md.near_duplicate_classes(docs_of(rows)).collect()}
        assert got == brute(rows)
        assert len(seen) == len(set(seen)) > 0 and all(a < b for a, b in seen)
        assert least <= len(passes) <= most


def test_few_and_many_links_give_the_same_components(spark, docs_of, monkeypatch):
    from lendscope.llm import components as cp
    rnd = random.Random(4)
    links = [(rnd.randrange(500), rnd.randrange(500)) for _ in range(400)]
    df = spark.createDataFrame(links, "a long, b long")
    few = sorted(components(df).collect())
    monkeypatch.setattr(cp, "LOOKUP_ROWS", 0)
    monkeypatch.setattr(md, "LOOKUP_ROWS", 0)
    assert sorted(components(df).collect()) == few
    rows = family(3, 60, 6)
    assert {r.doc_id: r.class_id for r in md.near_duplicate_classes(docs_of(rows)).collect()} == brute(rows)


def test_histograms_bound_the_overlap():
    rnd = np.random.default_rng(8)
    pool = rnd.integers(1, 1 << 63, 9000).astype(np.uint64)
    for n, m, most in ((20, 30, 2), (900, 700, 3), (5000, 4100, 2), (40, 40, 400), (60, 60, 90_000)):
        a = np.unique(rnd.choice(pool[:n * 2], n), return_counts=True)
        b = np.unique(rnd.choice(pool[:n * 2], m), return_counts=True)
        a, b = ((e, c * rnd.integers(1, most, len(c))) for e, c in (a, b))
        true = md.weighted_jaccard(md.packed(*a), md.packed(*b))
        node = lambda s, i: md.Members(np.array([i]), np.array([s[1].sum()]), np.array([i]), [md.histogram(*s)])
        for threshold in (true, true - 0.01):
            reach = node(b, 1).within_reach(0, int(a[1].sum()), 0, np.frombuffer(md.histogram(*a), "<u2"), threshold, None)
            assert reach.tolist() == [1]
        assert np.array_equal(md.unpacked(md.packed(*a))[1], a[1])
    a, b = (rnd.integers(1, 1 << 63, 600).astype(np.uint64) for _ in "ab")
    one = np.ones(600, int)
    far = md.Members(np.array([1]), np.array([600]), np.array([1]), [md.histogram(b, one)])
    assert len(far.within_reach(0, 600, 0, np.frombuffer(md.histogram(a, one), "<u2"), 0.8, None)) == 0


def test_an_id_with_several_texts(docs_of):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long), (5, long + " more"), (5, "an unrelated text of its own"), (7, "quite another text with seven words")]
    got = sorted((r.doc_id, r.class_id, r.kept) for r in md.near_duplicate_classes(docs_of(rows)).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True), (7, 7, True)]
    assert sorted((r.doc_id, r.text) for r in md.drop_near_duplicates(docs_of(rows)).collect()) == sorted(
        [rows[0], rows[2], rows[3]])
    same = [(3, long), (3, long + " more")]  # both texts of one id in one class: one stays
    assert sum(r.kept for r in md.near_duplicate_classes(docs_of(same)).collect()) == 1
