import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lendscope.llm import merkle_manifest as mm

LOW = {65 + i: 97 + i for i in range(26)}


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree(nodes, fan):
    """Root and for each node its siblings and place, level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for way, i in zip(ways, at):
            run = runs[i // fan]
            way.append((run[:i % fan], run[i % fan + 1:]))
        nodes, at = [H(*r) for r in runs], [i // fan for i in at]
    return nodes[0], ways


def brute(rows, fan=8):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = []
    for g in order:
        docs = sorted(((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r.text, r) for r in groups[g]),
                      key=lambda d: d[:3])
        done.append((docs, *tree([d[2] for d in docs], fan)))
    if not done:
        return []
    root, up = tree([d[1] for d in done], fan)
    out = []
    for (docs, subroot, ways), above in zip(done, up):
        for (_, _, leaf, _, r), way in zip(docs, ways):
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            now = leaf_of(r, r.text.translate(LOW)) if bad else leaf
            for left, right in way + above:
                now = H(*left, now, *right)
            proof = H(*(x for left, right in way + above for x in left + right))
            out.append((r.doc_id, leaf, subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=str)


def many(docs_of, n):
    return docs_of([(i * 7 % n, f"Text {i}" if i % 11 else None, [None, "en", "en", "en", "", "zz", "é"][i % 7],
                     f"src{i % 3}" if i % 5 else None) for i in range(n)])


@pytest.mark.parametrize("fan,levels,n", [(8, 4, 300), (8, 1, 300), (2, 1, 130), (3, 2, 200), (8, 1, 9), (8, 2, 1)])
def test_manifest_matches_brute_force(docs_of, fan, levels, n):
    docs = many(docs_of, n).repartition(5)
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    low = F.translate("text", mm._UPPER, mm._LOWER)
    claimed = [low if f == "text" else F.col(f) for f in mm.FIELDS]
    got = mm.manifest(docs, claimed=claimed, claims=hit, fan=fan, levels=levels)
    assert rows_of(got) == brute(docs.collect(), fan)


def test_a_group_of_many_superblocks(docs_of, spark):
    """A hot group is cut into superblocks; the runs above them are joined level by level."""
    docs = spark.range(1100).select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), F.col("id")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "de").otherwise("en").alias("lang"),
                                    F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars"))
    got = mm.manifest(docs, levels=1)
    want = brute(docs.collect())
    assert [r[:5] for r in rows_of(got)] == [r[:5] for r in want]
    assert all(r.verified and r.folded_root == r.root for r in got.collect())


def test_proofs_fold_to_the_root(docs_of):
    docs = many(docs_of, 100)
    for r in mm.manifest(docs, with_proofs=True, levels=1).collect():
        assert H(*r.proof) == r.proof_sha256
    flipped = mm.manifest(docs, claimed=[F.lit("x") if f == "text" else F.col(f) for f in mm.FIELDS],
                          claims=F.col("doc_id") == 5)
    assert [r.doc_id for r in flipped.where(~F.col("verified")).collect()] == [5]


def test_awkward_rows(awkward, docs_of):
    assert rows_of(mm.tamper_report(awkward)) == brute(awkward.collect())
    assert mm.tamper_report(awkward.limit(0)).collect() == []
    copies = docs_of([(1, "A", "en")] * 700 + [(2, "b", None)])  # equal rows are leaves of their own
    got = rows_of(mm.tamper_report(copies))
    assert got == brute(copies.collect()) and len(got) == 701
