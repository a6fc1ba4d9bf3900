"""Input tables of a data directory (one Parquet file or folder per table)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


STAR_TABLES = ("orders", "customer", "nation", "lineitem")


@dataclass(frozen=True)
class StarTables:
    orders: DataFrame
    customer: DataFrame
    nation: DataFrame
    lineitem: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def star_tables(spark: SparkSession, sf_dir: str) -> StarTables:
    """Lazy scans; Catalyst prunes each to the columns a query uses."""
    return StarTables(
        orders=read_table(spark, sf_dir, "orders"),
        customer=read_table(spark, sf_dir, "customer"),
        nation=read_table(spark, sf_dir, "nation"),
        lineitem=read_table(spark, sf_dir, "lineitem"),
    )
