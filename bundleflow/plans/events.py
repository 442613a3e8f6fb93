"""Observation bundles from the ``events`` table, for the streaming path.

One bundle per (user, half of the month), however many events it has.  The
``interpretation`` element only appears from the second half of the month on:
the source gains a field mid-stream, which the silver hop must absorb (ST8).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .synth import _close_header, _entry_text

# Fixed value: the day from which the source sends ``interpretation``.
SECOND_HALF_FROM = "2024-01-16"


def observation_json() -> Column:
    late = F.col("ts") >= F.lit(SECOND_HALF_FROM).cast("timestamp_ntz")
    return F.to_json(F.struct(
        F.lit("Observation").alias("resourceType"),
        F.col("event_id").cast("string").alias("id"),
        F.lit("final").alias("status"),
        F.struct(F.array(F.struct(F.col("event_type").alias("code"))).alias("coding")).alias("code"),
        F.struct(F.col("value").alias("value"), F.lit("1").alias("unit")).alias("valueQuantity"),
        F.struct(F.concat(F.lit("User/"), F.col("user_id").cast("string")).alias("reference")).alias("subject"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("effectiveDateTime"),
        F.when(late, F.struct(F.col("event_type").alias("text"))).alias("interpretation"),
    ))


def observation_bundles(events: DataFrame) -> DataFrame:
    """(bundle_id, half, value) rows: JSON text of each bundle; ``half`` is 1 or 2."""
    e = events.select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.when(F.col("ts") >= F.lit(SECOND_HALF_FROM).cast("timestamp_ntz"), 2).otherwise(1).alias("half"),
        F.date_format("ts", "yyyy-MM").alias("month"),
    )
    e = e.withColumn("group_key", F.concat_ws("-", F.lit("u"), F.col("user_id").cast("string"), "month",
                                              F.col("half").cast("string")))
    g = e.groupBy("group_key", "half").agg(F.array_sort(F.collect_list(F.struct(
        "event_id", observation_json().alias("j")))).alias("obs"))
    bid = F.col("group_key")
    entries = F.array_join(F.transform("obs", lambda x: _entry_text(
        F.concat(F.lit("Observation/"), x["event_id"].cast("string")), x["j"])), ",")
    header = F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.lit("collection").alias("type"),
                                bid.alias("id")))
    return g.select(bid.alias("bundle_id"), "half", _close_header(header, entries).alias("value"))
