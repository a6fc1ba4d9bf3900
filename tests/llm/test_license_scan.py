import re

from lendscope.llm import license_scan as ls

LOW = {65 + i: 97 + i for i in range(26)}


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in ls.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def same(rows, got):
    assert len(got) == len(rows)
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_base_places_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    same([(r.doc_id, r.text) for r in docs.collect()], ls.scan_licenses(docs).collect())


def test_edges_and_both_join_forms(docs_of):
    rows = [(1, "GNU General Public License"), (2, "x gnu general public licensee"), (3, "MIT--License MIT license"),
            (4, "cc by cc by cc by"), (5, "Apache\nLicense " * 200), (6, "cc  bý"), (7, None), (8, "mit"),
            (9, "word " * 50_000 + "apache license"), (10, "gnu general public gnu general public license")]
    for bound in (100, 0):
        same(rows, ls.scan_licenses(docs_of(rows), broadcast_rows=bound).collect())


def test_templates_tolerate_small_changes(docs_of):
    notice = ls.TEMPLATES[1][0].split()
    changed = " ".join([*notice[:8], "extra", *notice[8:]])
    dropped = " ".join([*notice[:8], *notice[9:]])
    far = " ".join(notice[:10])
    got = {r.doc_id: r for r in ls.scan_licenses(docs_of([(1, "so " + changed), (2, dropped), (3, far),
                                                          (4, " ".join(notice) + " z")])).collect()}
    assert got[1].labels == got[2].labels == got[4].labels == "apache-2.0" and got[3].labels == ""
    assert got[4].score == 1.0 and 0.9 <= got[2].score < 1.0 and got[1].n_base == 0


def test_awkward_rows(awkward):
    got = ls.scan_licenses(awkward).collect()
    assert len(got) == awkward.count() and all(r.n_base == 0 for r in got)
    assert ls.scan_licenses(awkward.limit(0)).count() == 0


def longest_common(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        old = best[:]
        for j, y in enumerate(b):
            best[j + 1] = old[j] + 1 if x == y else max(old[j + 1], best[j])
    return best[-1]


def test_added_words_at_every_place_against_brute_force(docs_of):
    rows, want = [], {}
    for t, (text, label) in enumerate(ls.TEMPLATES):
        w = text.split()
        spare = len(w) - ls.needed(len(w), ls.MIN_COVER)
        places = {1, 2, 3, len(w) // 2, len(w) - 2, len(w) - 1}
        cuts = [[(p, n)] for p in places for n in (1, 3, ls.PAD)]
        cuts += [[(1, 3), (len(w) // 2, 3), (len(w) - 1, 3)], [(len(w) // 3, 1), (len(w) // 2, 1), (len(w) - 2, 1)]]
        for cut in cuts:
            for gone in {0, spare, spare + 1}:  # dropped in the middle; one more than allowed is no longer found
                out = [*w]
                for p, n in sorted(cut, reverse=True):
                    out[p:p] = ["added"] * n
                for x in w[len(w) // 2:len(w) // 2 + gone]:
                    out.remove(x)
                i = t * 10_000 + len(rows)
                rows.append((i, "so it is " + " ".join(out) + " and so on"))
                want[i] = label, longest_common(w, rows[-1][1].split()) / len(w), out
    got = ls.scan_licenses(docs_of(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        label, cover, out = want[r.doc_id]
        mine = [s for s in r.spans if s.label == label and s.end - s.start <= len(out)]
        assert (label in r.labels.split(",")) == (cover >= ls.MIN_COVER), texts[r.doc_id]
        if cover >= ls.MIN_COVER:
            assert max(s.cover for s in mine) == cover, texts[r.doc_id]


def test_added_words_name_no_other_license(docs_of):
    cc = "licensed under the well known cc by {}4 0 "
    got = {r.doc_id: r for r in ls.scan_licenses(docs_of([
        (1, "licensed under the new apache license version 2 0"), (2, cc.format("")), (3, cc.format("nc ")),
        (4, cc.format("nd ")), (5, cc.format("nc ") + cc.format("")),
        (6, "licensed under cc by 4 0 licensed under cc by 4 0")])).collect()}
    templates = {i: {s.label for s in r.spans} - {"cc-by", "apache"} for i, r in got.items()}
    labels = {i: set(r.labels.split(",")) for i, r in got.items()}
    assert "apache-2.0" in labels[1] and templates[1] == {"apache-2.0"}
    assert labels[2] == {"cc-by", "cc-by-4.0"} and labels[3] == {"cc-by", "cc-by-nc-4.0"} and labels[4] == {"cc-by"}
    assert labels[5] == {"cc-by", "cc-by-nc-4.0", "cc-by-4.0"}
    assert [(s.start, s.end, s.cover) for s in got[6].spans if s.label == "cc-by-4.0"] == [(0, 6, 1.0), (6, 12, 1.0)]
