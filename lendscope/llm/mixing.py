"""Mixing sources to target weights (operator 8): iterative proportional fitting.

Native: DataFrame functions only. Token counts are summed by cell (source,
language, topic); the cells' token mass is raked in turn to the three target
marginals, each sweep scaling every cell by target / current of its source, then
language, then topic. A document is kept with the probability of its cell,
proportional to raked mass / tokens, so the kept tokens follow all three
marginals in expectation. After each ``SWEEPS`` sweeps the largest marginal error
is taken; raking ends when it is at most ``TOLERANCE``, or when it stands still
(targets that the cells cannot meet) or after ``ROUNDS`` rounds, and then the
error by marginal is given as a warning. The largest probability is 1, hence nothing is
repeated. The draw is a hash of the id: the same rows are kept in every run.

Targets are the present shares raised to ``power`` and scaled to one (below 1:
small sources, languages and topics gain). A caller may pass own targets: for any
of the marginals a table with one ``weight`` for each ``value``, scaled to one. A
value that its table lacks has weight 0, and weight 0 keeps none of its documents;
weights of values without tokens are left out and the others scaled up; a
null, negative or infinite weight, a repeated value or weights that leave no tokens at
all raise ValueError. A function of the cell table may stand for the tables, as
``even_targets`` does for the registered query: languages even, no source above
``SOURCE_CAP``. Tokens are counted as words between single spaces. The topic
comes from fixed marks in the text (see ``TOPIC_MARKS``).

Only the cell table goes through the sweeps: its size follows the number of
sources, languages and topics, not of rows. It is written before it meets the
documents, so Spark knows its size and broadcasts it only if small.

Cases: a null source, language or text is a value of its own (null text: no
tokens, topic prose); cells without tokens have probability 1, or 0 where a value has
weight 0; a null id draws 0 and is kept unless its probability is 0; repeated rows are drawn alike; an empty table gives no rows; documents'
other columns are kept by ``sample_to_targets``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.llm.common import staged

POWER = {"source": 0.95, "lang": 0.95, "topic": 0.98}
#: Part of the present tokens that ``even_targets`` leaves a source at most, before weights are scaled to one
SOURCE_CAP = 0.1
SWEEPS = 10
#: Largest difference between a value's share of the raked mass and its target
TOLERANCE = 1e-6
#: Rounds of sweeps at most. Raking can start very slowly, so only an error that stands still (to STILL) ends it before.
ROUNDS = 50
STILL = 1e-12
MARGINS = ("source", "lang", "topic")
#: (topic, mark): the first mark that a text holds names its topic
TOPIC_MARKS = (("license", "icensed under"), ("table", " | "), ("shout", "!!"), ("contact", "@"))
DEFAULT_TOPIC = "prose"

#: Own targets by marginal, or what derives them from the cell table
Targets = Mapping[str, DataFrame] | Callable[[DataFrame], Mapping[str, DataFrame]]


def token_count(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).otherwise(
        F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    out = F.lit(DEFAULT_TOPIC)
    for topic, mark in reversed(TOPIC_MARKS):
        out = F.when(F.contains(text, F.lit(mark)), F.lit(topic)).otherwise(out)
    return out


def uniform(id_col: Column) -> Column:
    """A number in [0, 1) from the id."""
    return F.coalesce(F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("double") / 4294967296.0,
                      F.lit(0.0))


def _weights(cells: DataFrame, margin: str, given: DataFrame) -> DataFrame:
    """``given`` as _value and _weight, checked."""
    out = given.select(F.col("value").cast(cells.schema[margin].dataType).alias("_value"),
                       F.col("weight").cast("double").alias("_weight"))
    fit = (F.col("_weight") >= 0) & (F.col("_weight") < F.lit(float("inf")))
    bad = (out.groupBy("_value").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce(fit, F.lit(False))).alias("fit"))
           .where((F.col("n") > 1) | ~F.col("fit")).limit(5).collect())
    if bad:
        raise ValueError(f"{margin} targets need one weight >= 0 for a value: {[r['_value'] for r in bad]}")
    return out


def rake(cells: DataFrame, margins=MARGINS, power: dict[str, float] | None = None, sweeps: int = SWEEPS,
         targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (one row per combination of ``margins``, with ``tokens``) with
    ``mass``, the raked token mass, and ``barred``, whether a given weight is 0."""
    power, targets = power or POWER, targets or {}
    if unknown := set(targets) - set(margins):
        raise ValueError(f"no such marginals: {sorted(unknown)}")
    over = {m: Window.partitionBy(m) for m in margins}
    df = cells.withColumn("barred", F.lit(False))
    for m in margins:
        marginal = cells.groupBy(m).agg(F.sum("tokens").cast("double").alias("_share"))
        if m in targets:
            weights = _weights(cells, m, targets[m])
            marginal = marginal.join(weights, marginal[m].eqNullSafe(weights["_value"]), "left").drop("_value")
            weight = F.coalesce("_weight", F.lit(0.0))
            part, barred = F.when(F.col("_share") > 0, weight), weight == 0
        else:
            part, barred = F.when(F.col("_share") > 0, F.pow("_share", F.lit(power[m]))), F.lit(False)
        target = marginal.select(F.col(m).alias(f"_{m}"), barred.alias("_barred"), F.coalesce(
            F.try_divide(part, marginal.agg(F.sum(part)).scalar()), F.lit(0.0)).alias(f"_target_{m}"))
        df = (df.join(target, df[m].eqNullSafe(target[f"_{m}"]))
              .withColumn("barred", F.col("barred") | F.col("_barred")).drop(f"_{m}", "_barred"))
    df = df.withColumn("mass", F.col("tokens").cast("double"))
    before = float("inf")
    for _ in range(ROUNDS):
        for _ in range(sweeps):
            for m in margins:
                now = F.sum("mass").over(over[m])
                df = df.withColumn("mass", F.when(now > 0, F.col("mass") * F.col(f"_target_{m}") / now)
                                   .otherwise(F.col("mass")))
        df = staged(df, "swept")
        errors = marginal_errors(df, margins)
        error = max(errors.values())
        if error <= TOLERANCE or abs(before - error) <= STILL:
            break
        before = error
    if error > TOLERANCE:
        warnings.warn(f"mixing targets missed by up to {errors} of the tokens", stacklevel=2)
    return df.drop(*[f"_target_{m}" for m in margins])


def even_targets(cells: DataFrame) -> dict[str, DataFrame]:
    """Equal weights for the languages; sources by their tokens, capped at ``SOURCE_CAP`` of all."""
    cap = F.lit(SOURCE_CAP) * cells.agg(F.sum("tokens")).scalar()
    n = F.sum("tokens").cast("double")
    return {"lang": cells.select(F.col("lang").alias("value")).distinct().withColumn("weight", F.lit(1.0)),
            "source": cells.groupBy(F.col("source").alias("value")).agg(
                F.when(n > 0, F.least(n, cap)).otherwise(1.0).alias("weight"))}


def marginal_errors(raked: DataFrame, margins=MARGINS) -> dict[str, float]:
    """By marginal, the largest difference between a share of the mass and its target."""
    total = raked.agg(F.sum("mass")).scalar()
    rows = None
    for m in margins:
        by_value = raked.groupBy(m).agg(F.sum("mass").alias("got"), F.max(f"_target_{m}").alias("want"))
        off = F.abs(F.coalesce(F.try_divide(F.col("got"), total), F.lit(0.0)) - F.col("want"))
        row = by_value.agg(F.lit(m).alias("margin"), F.coalesce(F.max(off), F.lit(0.0)).alias("off"))
        rows = row if rows is None else rows.unionByName(row)
    return {r["margin"]: r["off"] for r in rows.collect()}


def cell_probabilities(docs: DataFrame, source_col="source", lang_col="lang", text_col="text",
                       power: dict[str, float] | None = None, sweeps: int = SWEEPS,
                       targets: Targets | None = None) -> DataFrame:
    """source, lang, topic, tokens, mass, probability by cell."""
    cells = staged(docs.select(F.col(source_col).alias("source"), F.col(lang_col).alias("lang"),
                               topic_of(F.col(text_col)).alias("topic"), token_count(F.col(text_col)).alias("n"))
                   .groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens")), "cells")
    if callable(targets):
        targets = targets(cells)
    raked = rake(cells, power=power, sweeps=sweeps, targets=targets)
    if targets:
        total = raked.agg(F.sum("tokens").alias("tokens"), F.sum("mass").alias("mass")).first()
        if total["tokens"] and not total["mass"]:
            raise ValueError("the target weights leave no tokens")
    ratio = F.col("mass") / F.col("tokens")
    top = raked.where(F.col("tokens") > 0).agg(F.max(ratio)).scalar()
    return raked.select(
        "source", "lang", "topic", "tokens", "mass",
        F.when(F.col("tokens") > 0, F.round(ratio / top, 9))
        .otherwise(F.when(F.col("barred"), 0.0).otherwise(1.0)).alias("probability"))


def sample_to_targets(docs: DataFrame, id_col="doc_id", source_col="source", lang_col="lang", text_col="text",
                      power: dict[str, float] | None = None, sweeps: int = SWEEPS,
                      targets: Targets | None = None) -> DataFrame:
    """``docs`` with mix_topic, mix_tokens, mix_probability, mix_kept."""
    cells = staged(cell_probabilities(docs, source_col, lang_col, text_col, power, sweeps, targets), "probabilities")
    cells = cells.select(F.col("source").alias("_mix_s"), F.col("lang").alias("_mix_l"), F.col("topic").alias("_mix_t"),
                         F.col("probability").alias("mix_probability"))
    df = docs.withColumns({"mix_topic": topic_of(F.col(text_col)), "mix_tokens": token_count(F.col(text_col))})
    same = (df[source_col].eqNullSafe(cells["_mix_s"]) & df[lang_col].eqNullSafe(cells["_mix_l"])
            & (df["mix_topic"] == cells["_mix_t"]))
    return (df.join(cells, same).drop("_mix_s", "_mix_l", "_mix_t")
            .withColumn("mix_kept", uniform(F.col(id_col)) < F.col("mix_probability")))


def mixing_report(docs: DataFrame, targets: Targets | None = even_targets) -> DataFrame:
    """The registered query: every document's cell, probability and draw."""
    narrow = docs.select("doc_id", "source", "lang", "text")
    return sample_to_targets(narrow, targets=targets).select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"))
