import corpus_pipeline
from pyspark.sql import functions as F

from lendscope.llm import exact_dedup, mixing, packing, toxicity
from test_near_dedup import brute as near_classes
from test_packing import check

SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").collect()
    pos, neg = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert auc > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.THRESHOLD) for r in got.collect())


def test_features_see_what_they_name():
    lex = {"lowei*": 2.0, "zzword": 1.5}
    plain = toxicity.features_of("Nothing to see here, move on.", lex)
    assert plain[1] == 0 and plain[5] == 0
    assert toxicity.features_of("you are an 1d!ot", lex)[10] == 1.0
    assert toxicity.features_of("loweitest word", lex)[4] > 0
    assert toxicity.features_of("you stupid", lex)[5] > toxicity.features_of("stupid " + "x " * 30 + "you", lex)[5]
    assert toxicity.features_of("ABC", lex)[6] == 1.0 and len(toxicity.features_of("", lex)) == toxicity.N_FEATURES


def test_scores_match_a_plain_recomputation(spark):
    """Features by hand, each tree walked in Python, isotonic steps interpolated."""
    import math
    import numpy as np
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    trees, weights = model.trees.trees, model.trees.treeWeights

    def walk(node, x):
        while node.subtreeDepth() > 0:
            split = node.split()
            node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
        return node.prediction()
    xs, ys = (np.array(v) for v in (model.calibration.boundaries, model.calibration.predictions))
    got = {r.doc_id: r.score for r in model.with_scores(docs).collect()}
    for r in docs.orderBy("doc_id").limit(40).collect():  # of a test, not of a query
        x = toxicity.features_of(r.text or "", model.lexicon)
        margin = sum(w * walk(t._call_java("rootNode"), x) for t, w in zip(trees, weights))
        p = 1 / (1 + math.exp(-2 * margin))
        # at a step the last digits of p decide: the score lies between both sides of it
        low, high = (min(1, max(0, (1 - toxicity.RAW_SHARE) * np.interp(q, xs, ys) + toxicity.RAW_SHARE * q))
                     for q in (p - 1e-12, p + 1e-12))
        assert low - 1e-9 <= got[r.doc_id] <= high + 1e-9


def test_the_sample_is_a_top_k_of_each_fold(spark):
    """No task sorts a whole fold: the plan takes ordered rows, and rows are those of the smallest id hashes."""
    import zlib
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = toxicity.labelled_sample(docs, labels, "doc_id", "text", 20)
    assert sample._jdf.queryExecution().toString().count("TakeOrderedAndProject") >= 3
    known = labels.where("toxic IS NOT NULL").join(docs, "doc_id").select("doc_id", "text", "toxic",
                                                                         F.xxhash64("doc_id").alias("h")).distinct().collect()
    for k in (0, 1, 3):
        mine = sorted((r for r in known if zlib.crc32(str(r.doc_id).encode()) % 4 == k), key=lambda r: (r.h, r.doc_id))[:20]
        assert sorted((r.text or "", r.toxic) for r in mine) == sorted(
            (r.text, r.toxic) for r in sample.where(F.col("fold") == k).collect())


def test_awkward_rows_and_labels(awkward, spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(train, labels)
    got = model.with_scores(awkward.drop("score"))
    assert got.count() == awkward.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert model.with_scores(awkward.drop("score").limit(0)).count() == 0
    none = toxicity.score_toxicity(awkward, labels.limit(0))
    assert {r.score for r in none.collect()} == {0.0}
    one_kind = toxicity.score_toxicity(train, labels.where("toxic = 0"))
    assert one_kind.select("score").distinct().count() == 1
    odd = labels.select("doc_id", F.lit(None).cast("int").alias("toxic")).unionByName(labels.select("doc_id", "toxic"))
    assert toxicity.score_toxicity(train.limit(50), odd).count() == 50


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    low = {65 + i: 97 + i for i in range(26)}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            out = spark.createDataFrame(out.collect(), docs.schema)
            ids = {r.doc_id for r in out.collect()}
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            clean = [i for i, t in labels.items() if not t]
            toxic = [i for i, t in labels.items() if t]
            assert sum(i in ids for i in clean) > 0.98 * len(clean)
            assert sum(i not in ids for i in toxic) > 0.6 * len(toxic)
        if name == "exact_dedup":
            keep = {}
            for i, t in rows:
                k = (t or "").translate(low)
                keep[k] = max(i, keep.get(k, i))
            assert ids == set(keep.values())
        if name == "near_dedup":
            assert ids == set(near_classes(rows).values())
        if name == "mixing":
            p = {r.doc_id: (r.mix_probability, r.mix_kept) for r in mixing.sample_to_targets(docs).collect()}
            assert ids == {i for i, (_, k) in p.items() if k}
        if name == "packing":
            check(out.collect(), dict(rows), packing.WINDOW)
        else:
            docs = out


def test_stages_take_awkward_rows(awkward, spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, awkward, SF)
        assert out.count() >= 6
        if name != "packing":
            assert out.columns == awkward.columns
        assert stage(spark, awkward.limit(0), SF).count() == 0
    assert exact_dedup.drop_duplicates(awkward).count() < awkward.count()
