"""Batch table scans (S7) and inline relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import join_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; projections and filters applied later reach the Parquet scan."""
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal relation, the DataFrame form of ``VALUES``."""
    return spark.createDataFrame(rows, schema)
