"""Toxicity (operator 10): gradient-boosted trees over dense features.

Features of a text: densities of a lexicon and of its stems, how close lexicon
words stand to second-person pronouns, rates of capitals, punctuation and
obfuscated words, and obfuscated lexicon words once their stand-in characters
are undone. Labels are used in three separate folds of crc32(id) mod 4: one
learns lexicon entries (log-odds by document), one fits the trees, one the
isotonic calibration that turns the trees' output into a probability. Each fold
gives at most ``sample_rows`` labelled rows (those with the smallest id hash),
which bounds training at any input size; scoring reads every whole text.

Cases: null text counts as empty and is scored like one; without
labels of both kinds every score is the smoothed rate of toxic labels (0 without
labels); an id labelled twice trains on the larger label, one with several texts
on the text of the smallest hash; texts of equal features get equal scores; an
empty table gives no rows; repeated rows are scored each and other columns are
kept by ``with_scores`` (but for one named like its score column, which is replaced).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from lendscope.llm.common import batch, fold, staged, str_texts

SAMPLE_ROWS = 8_000
LEXICON_SIZE = 400
MIN_DOCS = 3
MIN_LOG_ODDS = math.log(3.0)
THRESHOLD = 0.3
NEAR = 6
#: The raw output's share in the score: isotonic steps tie many texts, this orders them.
RAW_SHARE = 0.02

#: Common insults (a starting lexicon; the rest is learned)
INSULTS = frozenset("""
    idiot idiots stupid moron morons loser losers scum trash clown pathetic worthless disgusting dumb fool ugly
    hate shut freak creep imbecile vermin garbage filth bastard jerk
    idiota estupido estúpido imbecil imbécil basura asqueroso inutil inútil
    stupide débile ordure minable crétin
    dumm idiotisch abschaum versager widerlich trottel
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti tuyo usted ustedes vosotros
""".split())
_WORD = re.compile(r"[^\W_]+(?:[@$*!|.][^\W_]+)*")
_PLAIN = re.compile(r"[^\W\d_]+")
_STAND_IN = re.compile(r"[^\W\d_][0-9@$*!|]+[^\W\d_]")
_UNDO = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                       "|": "l", "*": "", ".": ""})
N_FEATURES = 15
_COUNTS = pa.schema([("entry", pa.string()), ("toxic_docs", pa.int64()), ("docs", pa.int64())])


def entries_of(text: str) -> set[str]:
    """What can enter the lexicon: words, and stems of four to six letters (marked *)."""
    words = set(_PLAIN.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        toxic, docs = Counter(), Counter()
        for text, label in zip(str_texts(b.column(0)), b.column(1).to_pylist(), strict=True):
            found = entries_of(text)
            docs.update(found)
            if label:
                toxic.update(found)
        yield batch(_COUNTS, list(docs), [toxic[e] for e in docs], list(docs.values()))


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """The ``size`` entries with the strongest log-odds of a toxic label."""
    n = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    t, c = float(n["t"] or 0), float((n["n"] or 0) - (n["t"] or 0))
    if not t or not c:
        return {}
    a, rest = F.col("toxic_docs"), F.col("docs") - F.col("toxic_docs")
    odds = F.log((a + 0.5) / (t + 1.0)) - F.log((rest + 0.5) / (c + 1.0))
    rows = (sample.select("text", "toxic").mapInArrow(_entry_counts, "entry string, toxic_docs long, docs long")
            .groupBy("entry").agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("docs").alias("docs"))
            .where(a >= MIN_DOCS).select("entry", odds.alias("odds"), a.alias("a"))
            .where(F.col("odds") >= MIN_LOG_ODDS)
            .orderBy(F.desc(F.col("odds") * F.sqrt("a")), "entry").limit(size).collect())
    return {r["entry"]: r["odds"] for r in rows}


def features_of(text: str, lexicon: dict[str, float]) -> list[float]:
    lower = text.lower()
    words = _WORD.findall(lower)
    n, chars = max(1, len(words)), max(1, len(text))
    hits = stems = odd = undone = exact = 0
    weight, top, seen = 0.0, 0.0, set()
    at_hit, at_you = [], []
    for i, w in enumerate(words):
        v = lexicon.get(w, 0.0)
        if w in INSULTS:
            exact += 1
            v = max(v, 3.0)
        elif not v and len(w) > 4:
            v = max(lexicon.get(w[:4] + "*", 0.0), lexicon.get(w[:5] + "*", 0.0), lexicon.get(w[:6] + "*", 0.0))
            stems += v > 0
        if not w.isalpha() and _STAND_IN.search(w):
            odd += 1
            plain = w.translate(_UNDO)
            if plain in INSULTS or plain in lexicon:
                undone += 1
                v = max(v, 3.0)
        if v:
            hits += 1
            weight += v
            top = max(top, v)
            seen.add(w)
            at_hit.append(i)
        if w in SECOND_PERSON:
            at_you.append(i)
    near = 0
    if at_hit and at_you:
        you = np.array(at_you)
        at = np.searchsorted(you, at_hit)
        left = np.abs(np.array(at_hit) - you[np.maximum(at - 1, 0)])
        right = np.abs(np.array(at_hit) - you[np.minimum(at, len(you) - 1)])
        near = int((np.minimum(left, right) <= NEAR).sum())
    caps = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = len(text) - sum(map(str.isalnum, text)) - text.count(" ")
    return [math.log1p(n), math.log1p(hits), hits / n, math.log1p(exact), stems / n, near / n, caps / chars,
            marks / chars, text.count("!") / chars, odd / n, float(undone), float(len(seen)), weight, top, weight / n]


def _feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features_of(t or "", lexicon))
    return array_to_vector(features(F.coalesce(text, F.lit(""))))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows of each training fold: fold, text, toxic. Each
    fold is a top-k by id hash, so a task sorts and hands on no more than ``rows``."""
    part = fold(id_col, 4)
    lab = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col)
           .agg(F.max("toxic").cast("int").alias("toxic")).select(id_col, part.alias("fold"), "toxic")
           .where(F.col("fold") != 2))
    have = docs.select(id_col).where(fold(id_col, 4) != 2).distinct()
    known = staged(lab.join(have, id_col, "left_semi"), "toxicity-labels")
    chosen = reduce(lambda a, b: a.unionByName(b), [
        known.where(F.col("fold") == k).orderBy(F.xxhash64(id_col), id_col).limit(rows) for k in (0, 1, 3)])
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(id_col, text.alias("text")).join(F.broadcast(chosen), id_col)  # 3 x rows at most
            .groupBy(id_col, "fold", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one"))
            .select("fold", F.col("one.text").alias("text"), "toxic"))


class ToxicityModel:
    """Lexicon, trees and calibration, or a constant where labels don't suffice."""

    def __init__(self, lexicon, trees=None, calibration=None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def with_scores(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``docs`` with one more column, the calibrated score in 0..1."""
        if self.trees is None:
            return docs.withColumn(score_col, F.lit(float(self.constant)))
        df = docs.withColumn("_tox_x", _feature_column(F.col(text_col), self.lexicon))
        df = self.trees.transform(df).withColumn("_tox_p", vector_to_array("_tox_prob")[1])
        score = F.col("_tox_p")
        if self.calibration is not None:
            df = self.calibration.transform(df)
            score = F.col("_tox_iso") * (1 - RAW_SHARE) + F.col("_tox_p") * RAW_SHARE
        return (df.withColumn(score_col, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))
                .drop("_tox_x", "_tox_raw", "_tox_prob", "_tox_pred", "_tox_p", "_tox_iso"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS, trees: int = 15, depth: int = 4) -> ToxicityModel:
    sample = staged(labelled_sample(docs, labels, id_col, text_col, sample_rows), "toxicity-sample")
    lexicon = learn_lexicon(sample.where(F.col("fold") == 0))
    x = staged(sample.where(F.col("fold") != 0)
               .select("fold", F.col("toxic").cast("double").alias("toxic"),
                       _feature_column(F.col("text"), lexicon).alias("_tox_x")), "toxicity-features").coalesce(4)
    kinds = {(r["fold"], r["toxic"]): r["count"] for r in x.groupBy("fold", "toxic").count().collect()}
    n, t = sum(kinds.values()), sum(v for (_, k), v in kinds.items() if k)
    if not (kinds.get((1, 0.0)) and kinds.get((1, 1.0))):
        return ToxicityModel(lexicon, constant=(t + 1) / (n + 2) if n else 0.0)
    model = (GBTClassifier(featuresCol="_tox_x", labelCol="toxic", predictionCol="_tox_pred", maxIter=trees,
                           maxDepth=depth, stepSize=0.3, seed=7).fit(x.where(F.col("fold") == 1))
             .setRawPredictionCol("_tox_raw").setProbabilityCol("_tox_prob"))
    held = x.where(F.col("fold") == 3)
    calibration = None
    if kinds.get((3, 0.0)) and kinds.get((3, 1.0)):
        p = model.transform(held).select("toxic", vector_to_array("_tox_prob")[1].alias("_tox_p"))
        calibration = IsotonicRegression(featuresCol="_tox_p", labelCol="toxic", predictionCol="_tox_iso").fit(p)
    return ToxicityModel(lexicon, model, calibration)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fit(docs, labels, id_col, text_col, sample_rows)
    return (model.with_scores(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                          F.col(text_col).alias("_tox_text")), "_tox_text")
            .select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored under the threshold, with their own columns."""
    scored = fit(docs, labels).with_scores(docs, score_col="_tox_score")
    return scored.where(F.col("_tox_score") < threshold).select(*docs.columns)
