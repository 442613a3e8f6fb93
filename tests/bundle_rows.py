"""Inline bundles for the tests."""

from pyspark.sql import functions as F

from bundleflow.plans import bronze
from bundleflow.plans.synth import file_metadata


def bronze_rows(spark, texts: list[str]):
    """Bronze-shaped rows from inline JSON texts (file metadata synthesised per row)."""
    df = spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(texts)], "bundle_id string, value string")
    df = df.select("bundle_id", file_metadata(F.concat(F.lit("mem/"), "bundle_id"), F.col("bundle_id"),
                                              F.col("value"), F.current_timestamp()).alias("file_metadata"), "value")
    return bronze.bronze_from_text(df, "hash", F.col("bundle_id"))
