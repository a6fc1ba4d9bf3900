import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lendscope.llm import decontaminate as dc

LOW = {65 + i: 97 + i for i in range(26)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, gram=dc.GRAM):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(gram, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in known:
                    hit |= set(range(i, i + n))
                    found |= known[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def report(docs, bench, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in dc.contamination(docs, bench, **kw).collect()),
                  key=str)


SMALL = [(1, "alpha beta gamma"), (2, "One two three four five six seven eight nine ten eleven twelve"), (3, None),
         (4, ""), (5, "!!"), (None, "no id item words"), (2, "a repeated id"), (6, "é 漢字 x"),
         (7, "two three four five six seven eight nine ten eleven"), (10, "alpha  BETA-gamma")]
TEXTS = [(1, "say alpha, beta... GAMMA! alpha beta"), (2, "two three four five six seven eight nine ten eleven"),
         (3, "one two three four five six seven eight nine TEN"), (4, "no id item words"), (5, "É 漢字 x é 漢字 x"),
         (6, None), (7, "one two three"), (8, "alpha beta gammas"), (9, "a repeated id a repeated id"),
         (10, "alpha beta gamma " * 40_000), (10, "alpha beta gamma"), (None, "alpha beta gamma")]


@pytest.mark.parametrize("bounds", [{}, {"broadcast_windows": 0, "file_bytes": 60}, {"broadcast_bytes": 1}])
def test_report_matches_brute_force(spark, docs_of, bounds):
    bench = spark.createDataFrame(SMALL, ITEMS)
    assert report(docs_of(TEXTS), bench, **bounds) == brute(TEXTS, SMALL)


def test_given_tables_match_brute_force(spark, sf_small):
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert report(docs, bench) == want and any(w[2] for w in want)
    digest = {r.doc_id: r for r in dc.contamination_digest(docs, bench).collect()}
    for doc, n, hit, items in want:
        r = digest[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_equal_hashes_are_told_apart_by_their_words():
    import pyarrow as pa
    from lendscope.llm.words import ALNUM, hash_words
    h = hash_words([b"same"], ALNUM)[0]
    h = next(acc for n, acc, ok in dc._rolling(h, h * 0 + 1, 1)).astype("int64")[0]
    rows = pa.table({"hash": [int(h)] * 2, "words": [b"other", b"third"], "item": ["1", "2"]}).cast(dc._SET)
    assert list(dc.scan([b"same"], dc.WindowSet([1], rows, []))) == [(1, [], set(), [])]
    rows = pa.table({"hash": [int(h)] * 2, "words": [b"other", b"same"], "item": ["1", "2"]}).cast(dc._SET)
    assert list(dc.scan([b"same"], dc.WindowSet([1], rows, []))) == [(1, [[0, 1]], {"2"}, [(0, 4)])]


def test_removal_of_spans_and_documents(spark, docs_of):
    bench = spark.createDataFrame(SMALL, ITEMS)
    docs = docs_of([t for t in TEXTS if t[0] != 10]).withColumn("hash", F.lit("clash")).withColumn("words", F.lit(1))
    cut = dc.decontaminate(docs, bench)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got[1] == "say ! alpha beta" and got[2] == "" and got[3] == "" and got[6] is None and got[5] == "É 漢字 x "
    assert got[7] == "one two three" and got[8] == "alpha beta gammas" and got[9] == "" and got[None] == ""
    assert all(n == 0 for _, _, n, _ in report(cut, bench))
    kept = dc.decontaminate(docs, bench, "documents")
    assert sorted(r.doc_id for r in kept.collect()) == [6, 7, 8] and kept.columns == docs.columns
    with pytest.raises(ValueError):
        dc.decontaminate(docs, bench, "words")


def test_awkward_rows(spark, awkward):
    bench = spark.createDataFrame([(1, "long " * 12), (2, "漢字"), (3, "12345")], ITEMS)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert report(awkward, bench) == brute(rows, [(1, "long " * 12), (2, "漢字"), (3, "12345")])
    assert report(awkward.limit(0), bench) == []
    assert all(n == 0 for _, _, n, _ in report(awkward, bench.limit(0)))
    assert dc.decontaminate(awkward, bench.limit(0)).exceptAll(awkward).count() == 0
    assert dc.decontaminate(awkward.limit(0), bench, "documents").count() == 0
