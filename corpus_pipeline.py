"""The corpus pipeline: five operators in a row over ``documents``.

Each stage gets what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``. ``ORACLE_SQL`` is
None: boosted trees and near-duplicate classes have no SQL form; the tests hold
the pipeline against a plain version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.llm import exact_dedup, minhash_dedup, mixing, packing, toxicity
from lendscope.llm.common import staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return minhash_dedup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target weights."""
    return mixing.sample_to_targets(docs).where(F.col("mix_kept")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, one row per piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
