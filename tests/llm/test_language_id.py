from pyspark.sql import functions as F

from lendscope.llm import language_id as li


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.held_out_language(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


def test_prediction_ignores_lang_source_and_id(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = li.predict_language(docs, docs).orderBy("doc_id").collect()
    moved = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    b = li.predict_language(moved, docs).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in a] == [(r.lang_pred, r.score) for r in b]


def test_awkward_rows_and_no_training(awkward, spark):
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = li.predict_language(awkward, train).collect()
    assert len(got) == awkward.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1
    assert {by_id[i].lang_pred for i in (1, 2, 3, 10)} == {li.UND}
    assert {r.lang_pred for r in li.predict_language(awkward, train.limit(0)).collect()} == {li.UND}
    assert li.predict_language(awkward.limit(0), train).count() == 0


def test_dictionaries_are_bounded(spark):
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    d = li.learn_dictionaries(train, sample_docs=30, dict_bytes=5000)
    assert set(d) == {"en", "fr", "de", "es"} and all(0 < len(x) <= 5000 for x in d.values())


def test_predictions_match_plain_compression(spark, docs_of):
    """Every document compressed plainly with each dictionary: smallest wins, ties by training rows."""
    import math
    import zstandard
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dictionaries = li.learn_dictionaries(train)
    rows = [(r.doc_id, r.text) for r in train.collect()] + [(9001, "ab"), (9002, "zzzz qqqq"), (9003, "zzzz qqqq")]
    got = {r.doc_id: r for r in li.predict_language(docs_of(rows), train).collect()}
    for doc, text in rows:
        kept = "".join(c if ord(c) > 31 else " " for c in text.lower())
        kept = "".join(c for c in kept if ord(c) > 127 or c == " " or c.isalpha()).encode()
        sizes = []
        for lang, raw in dictionaries.items():  # most training rows first
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=li.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
            sizes.append((len(c.compress(kept)), lang))
        least = min(s for s, _ in sizes)
        best = next(lang for s, lang in sizes if s == least)
        share = 1 / sum(math.exp(-min(700.0, (s - least) * li.SHARPNESS / max(1, len(kept)))) for s, _ in sizes)
        assert got[doc].lang_pred == best and abs(got[doc].score - share) < 1e-9


def test_a_text_without_a_letter_is_undetermined(spark, docs_of):
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(1, "½ ²"), (2, "① ⅷ 12 _"), (3, "٣٤ 。"), (4, "ª"), (5, "字"), (6, "12 é")]
    got = {r.doc_id: r.lang_pred for r in li.predict_language(docs_of(rows), train).collect()}
    assert {got[i] for i in (1, 2, 3)} == {li.UND} and li.UND not in {got[4], got[5], got[6]}


def test_every_sampled_text_is_in_the_dictionary(docs_of):
    """A very long text takes no more than its share."""
    rows = [(i, f"word{chr(97 + i)} " * 40, "en") for i in range(20)] + [(99, "giant " * 200_000, "en")]
    d = li.learn_dictionaries(docs_of(rows), sample_docs=50, dict_bytes=4200)["en"]
    assert len(d) <= 4200 and all(f"word{chr(97 + i)}".encode() in d for i in range(1, 20))
    assert d.count(b"giant") < 60
