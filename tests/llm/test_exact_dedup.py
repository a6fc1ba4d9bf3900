import hashlib

from lendscope.llm import exact_dedup as ed

LOW = {65 + i: 97 + i for i in range(26)}


def brute(rows):
    norm = [(i, (t or "").translate(LOW)) for i, t, *_ in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_match_brute_force(docs_of, awkward, spark):
    rows = [(i, ["Same", "same", "SAME", "É", "é", None, ""][i % 7]) for i in range(40)]
    got = [tuple(r) for r in ed.exact_groups(docs_of(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)
    awk = [(r.doc_id, r.text) for r in awkward.collect()]
    got = [tuple(r) for r in ed.exact_groups(awkward).collect()]
    assert sorted(got, key=str) == brute(awk)
    assert ed.exact_groups(awkward.limit(0)).count() == 0


def test_drop_duplicates_keeps_columns(docs_of, awkward):
    kept = ed.drop_duplicates(awkward)
    assert kept.columns == awkward.columns
    # null, empty: 2; 5 and 6 are equal; a row without an id that is alone stays
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 6, 8, 9, 10]
    assert ed.drop_duplicates(awkward, broadcast_rows=0).exceptAll(kept).count() == 0
    rows = [(None, "Same"), (None, "own"), (3, "same"), (4, "x"), (4, "X"), (4, "x"), (5, "y")]
    got = sorted((r.doc_id or 0, r.text.lower()) for r in ed.drop_duplicates(docs_of(rows)).collect())
    assert got == [(0, "own"), (3, "same"), (4, "x"), (5, "y")]


def test_directory_doubles_and_chains(tmp_path):
    index = ed.ExtendibleIndex(str(tmp_path / "index"), page_bytes=400, buffer_bytes=900)
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    texts = [f"text number {i}".encode() for i in range(300)]
    for i, t in enumerate(texts):
        index.insert(ed._key(t), i, 1, pack(t))
        if i % 3 == 0:
            index.insert(ed._key(t), 1000 + i, 2, pack(t))
    for i in range(20):  # one key, different bytes: a chain that can't be split
        index.insert(7, i, 1, pack(b"collision %d" % i))
    assert index.depth > 2 and len(index.directory) == 1 << index.depth
    got = {t: (keep, n) for _, t, keep, n in index.groups()}
    want = {t: (1000 + i, 3) if i % 3 == 0 else (i, 1) for i, t in enumerate(texts)}
    want |= {b"collision %d" % i: (i, 1) for i in range(20)}
    assert got == want


def test_a_hot_text_costs_linear_time(tmp_path):
    """20,000 inserts of one large text, between others: as many buckets and files as without it."""
    import time
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    index = ed.ExtendibleIndex(str(tmp_path / "index"), page_bytes=100_000, buffer_bytes=400_000)
    rnd = __import__("random").Random(1)
    hot = pack(bytes(rnd.randrange(256) for _ in range(60_000)))
    took = []
    for half in range(2):
        t = time.perf_counter()
        for i in range(10_000):
            index.insert(12345, half * 10_000 + i, 1, hot)
            if i % 50 == 0:
                index.insert(ed._key(b"%d-%d" % (half, i)), i, 1, pack(bytes(rnd.randrange(256) for _ in range(2_000))))
        took.append(time.perf_counter() - t)
    assert took[1] < 3 * took[0] + 0.5 and sum(took) < 20
    groups = list(index.groups())
    assert len(groups) == 401 and max(g[3] for g in groups) == 20_000 and max(g[2] for g in groups) == 19_999
    assert len(list((tmp_path / "index").iterdir())) <= index.flushes + 1
