import duckdb
import pytest
from pyspark.sql import functions as F

from lendscope.llm import mixing, url_filter
from lendscope.llm.queries import llm_oracle_sql, llm_queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(llm_oracle_sql()))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(llm_oracle_sql()[key])
    got = llm_queries()[key](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_as_of_join_against_a_plain_loop(spark):
    entries = [("a.com", 100, "block"), ("a.com", 200, "allow"), ("x.a.com", 150, "block"), ("a.com/p", 50, "allow"),
               ("b.com", 100, "allow"), ("b.com", 100, "block"), (None, 1, "block"), ("c.com", None, "block"),
               ("d.com", 0, None)]
    captures = [(i, u, t) for i, (u, t) in enumerate(
        (u, t) for u in ("http://a.com/p/q", "https://x.a.com", "http://user@X.A.com:80/p", "http://b.com?x", "nonsense",
                         None, "http://c.com/", "http://d.com/", "http://y.x.a.com/z#f")
        for t in (None, 0, 99, 100, 160, 199, 200, 10_000_000))] + [(0, "http://a.com/p/q", None)]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at long").withColumn("rule", F.lit("clash"))
    got = url_filter.evaluate(df, spark.createDataFrame(entries, "rule string, listed_at long, action string"), 60)
    rules_at = {}
    for rule, at, action in entries:
        if rule and at is not None and action:
            rules_at.setdefault(rule, {})[at] = max(action, rules_at.get(rule, {}).get(at, ""))
    hosts = {"http://a.com/p/q": ["a.com/p", "a.com"], "https://x.a.com": ["x.a.com", "a.com"],
             "http://user@X.A.com:80/p": ["x.a.com/p", "x.a.com", "a.com"], "http://b.com?x": ["b.com"],
             "http://y.x.a.com/z#f": ["y.x.a.com/z", "y.x.a.com", "x.a.com", "a.com"]}
    rows = got.collect()
    assert len(rows) == len(captures)
    for r in rows:
        want = (None, None, False)
        for rule in hosts.get(r.url, []):
            past = [t for t in rules_at.get(rule, {}) if r.fetched_at is not None and t <= r.fetched_at]
            if past:
                want = (rule, max(past), rules_at[rule][max(past)] == "block")
                break
        assert (r.rule, r.listed_at, r.blocked) == want, r
    assert url_filter.evaluate(df.limit(0), spark.createDataFrame(entries, "rule string, listed_at long, action string")
                               ).count() == 0
    none = url_filter.evaluate(df, spark.createDataFrame([], "rule string, listed_at long, action string")).collect()
    assert len(none) == len(captures) and not any(r.blocked for r in none)


def test_raking_meets_all_marginals(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cells = mixing.cell_probabilities(docs, sweeps=30).toPandas()
    for m in mixing.MARGINS:
        share = cells.groupby(m).tokens.sum() ** mixing.POWER[m]
        got = cells.groupby(m).mass.sum()
        assert abs(got / got.sum() - share / share.sum()).max() < 1e-6
    assert 0 < cells.probability.min() and cells.probability.max() == 1.0
    kept = mixing.sample_to_targets(docs).agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("e"), F.sum(
        F.when(F.col("mix_kept"), F.col("mix_tokens"))).alias("k")).first()
    assert abs(kept["k"] / kept["e"] - 1) < 0.1


def test_mixing_awkward_rows(awkward):
    got = mixing.sample_to_targets(awkward)
    assert got.count() == awkward.count() and got.columns[:len(awkward.columns)] == awkward.columns
    assert got.where("mix_probability is null or mix_probability > 1 or mix_kept is null").count() == 0
    assert mixing.sample_to_targets(awkward.limit(0)).count() == 0


def test_given_weights_are_met(spark, docs_of):
    many = (("hot", 1500), ("cold", 1500), (None, 600), ("gone", 100))
    rows = [(k * 10_000 + i, "four words in all", "de" if i % 3 else "en", source)
            for k, (source, n) in enumerate(many) for i in range(n)]
    docs = docs_of([*rows, (90_000, "", "en", "gone"), (90_001, None, "en", "hot")])
    source = spark.createDataFrame([("hot", 1.0), ("cold", 11.0), (None, 8.0), ("surplus", 7.0)],
                                   "value string, weight double")
    lang = spark.createDataFrame([("en", 3), ("de", 1)], "value string, weight int")
    cells = mixing.cell_probabilities(docs, targets={"source": source, "lang": lang}).toPandas()
    cells["expected"] = cells.tokens * cells.probability / (cells.tokens * cells.probability).sum()
    for m, want in (("source", {"hot": 0.05, "cold": 0.55, None: 0.4, "gone": 0.0}), ("lang", {"en": 0.75, "de": 0.25})):
        got = cells.assign(**{m: cells[m].where(cells[m].notna(), None)}).groupby(m, dropna=False).expected.sum()
        assert {None if k != k else k: round(v, 6) for k, v in got.items()} == want
    assert cells[cells.source == "gone"].probability.max() == 0 and cells.probability.max() == 1
    kept = mixing.sample_to_targets(docs, targets={"source": source}).where("mix_kept").toPandas()
    share = kept.groupby(kept.source.fillna("-")).mix_tokens.sum() / kept.mix_tokens.sum()
    assert abs(share["hot"] - 0.05) < 0.02 and abs(share["-"] - 0.4) < 0.05 and "gone" not in share
    assert mixing.sample_to_targets(docs.limit(0), targets={"source": source}).count() == 0


@pytest.mark.parametrize("rows", [[("hot", -1.0)], [("hot", None)], [("hot", float("nan"))], [("hot", 1.0), ("hot", 2.0)],
                                  [("hot", 0.0)], [("surplus", 1.0)]])
def test_weights_that_cannot_be_meant(spark, docs_of, rows):
    with pytest.raises(ValueError):
        mixing.cell_probabilities(docs_of([(1, "some words", "en", "hot")]), sweeps=1, targets={
            "source": spark.createDataFrame(rows, "value string, weight double")})


def cells_of(spark, rows):
    return spark.createDataFrame([(s, lang, "prose", n) for s, lang, n in rows],
                                 "source string, lang string, topic string, tokens long")


def test_raking_goes_on_until_the_targets_are_met(spark):
    """A source mostly in one language: 10 sweeps leave the source 0.0008 off."""
    cells = cells_of(spark, [("a", "en", 10_000), ("a", "de", 1_000), ("b", "en", 1_000), ("b", "de", 10_000)])
    targets = {m: spark.createDataFrame(w, "value string, weight double") for m, w in (
        ("source", [("a", 0.5), ("b", 0.5)]), ("lang", [("en", 0.45), ("de", 0.55)]))}
    raked = mixing.rake(cells, targets=targets).toPandas()
    assert abs(raked.groupby("source").mass.sum() - [0.5, 0.5]).max() < 1e-6
    assert abs(raked.groupby("lang").mass.sum()[["en", "de"]] - [0.45, 0.55]).max() < 1e-6


def test_targets_that_cannot_be_met_are_reported(spark):
    cells = cells_of(spark, [("a", "en", 100), ("b", "de", 100)])
    targets = {m: spark.createDataFrame(w, "value string, weight double") for m, w in (
        ("source", [("a", 0.9), ("b", 0.1)]), ("lang", [("en", 0.2), ("de", 0.8)]))}
    with pytest.warns(UserWarning, match="source': 0.7"):
        mixing.rake(cells, targets=targets).collect()


def test_the_production_setting_meets_all_marginals(spark, recwarn):
    cells = mixing.cell_probabilities(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    for m in mixing.MARGINS:
        share = cells.groupby(m).tokens.sum() ** mixing.POWER[m]
        got = cells.groupby(m).mass.sum()
        assert abs(got / got.sum() - share / share.sum()).max() < mixing.TOLERANCE
    assert not [w for w in recwarn if "mixing targets" in str(w.message)]


def test_the_registered_query_mixes_to_even_languages_and_capped_sources(spark, docs_of, recwarn):
    rows = [(i, "four words in all", ("en", "en", "en", "de", None)[i % 5], f"src{i % 7}" if i % 2 else "hot")
            for i in range(2000)]
    docs = docs_of([*rows, (5000, "", "fr", "empty"), (5001, None, "fr", None)])
    cells = mixing.cell_probabilities(docs, targets=mixing.even_targets).toPandas()
    cells["expected"] = cells.tokens * cells.probability / (cells.tokens * cells.probability).sum()
    by_lang = cells.groupby(cells.lang.fillna("-")).expected.sum()
    assert abs(by_lang[["en", "de", "-"]] - 1 / 3).max() < 1e-6 and by_lang["fr"] == 0
    before = cells.groupby("source").tokens.sum()
    want = before.clip(upper=mixing.SOURCE_CAP * before.sum())
    got = cells.groupby("source").expected.sum()
    assert before["hot"] / before.sum() == 0.5 and abs(got - want / want.sum()).max() < 1e-6
    report = {r.doc_id: r for r in mixing.mixing_report(docs).collect()}
    assert len(report) == 2002 and report[5000].kept and report[5001].kept  # without tokens nothing is out of balance
    assert mixing.mixing_report(docs.limit(0)).count() == 0
    assert not [w for w in recwarn if "mixing targets" in str(w.message)]
