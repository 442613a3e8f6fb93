"""Key drift, column order and the per-resource-type wide table.

Wide row: ``{type}_uuid, bundle_uuid, {type}_url, <one VARIANT column per key>``.

The reference pivots the long table with ``first(value)`` grouped by
(resource_uuid, bundle_uuid, url).  When ``fullUrl`` is unique inside a bundle
(FHIR requires it) that pivot equals a projection of the resource object, so
those entries are projected with no shuffle at all.  Only entries flagged
``dup_url`` (same fullUrl twice in one bundle) go through the grouped pivot,
which merges them per key with ``min_by(value, entry_pos)`` (first entry that
has the key, deterministic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import as_object, get, json_path
from ..operators.keys import check_case_collisions
from .resources import resources_long

SILVER_FIXED = ("{t}_uuid", "bundle_uuid", "{t}_url")


def fixed_columns(resource_type: str) -> list[str]:
    t = resource_type.lower()
    return [c.format(t=t) for c in SILVER_FIXED]


def _key_column(key: str):
    try:
        return get("resource", json_path(key)).alias(key)
    except ValueError:  # key not addressable by path: go through the object map
        return as_object("resource")[key].alias(key)


def silver_table(ent: DataFrame, resource_type: str, keys: list[str]) -> DataFrame:
    """Wide table of one resource type for the given ordered key list."""
    check_case_collisions(keys, resource_type)
    uuid_c, bundle_c, url_c = fixed_columns(resource_type)
    base = ent.where(F.col("resourceType") == resource_type)

    direct = base.where(~F.col("dup_url")).select(
        F.col("resource_uuid").alias(uuid_c), "bundle_uuid", F.col("fullUrl").alias(url_c),
        *[_key_column(k) for k in keys],
    )
    dup_long = resources_long(base.where(F.col("dup_url")))
    merged = (
        dup_long.groupBy(F.col("resource_uuid").alias(uuid_c), "bundle_uuid", F.col("fullUrl").alias(url_c))
        .pivot("key", keys)
        .agg(F.min_by("value", "entry_pos"))
    )
    return direct.unionByName(merged.select(uuid_c, bundle_c, url_c, *[F.col(f"`{k}`") for k in keys]))


def silver_table_legacy(ent: DataFrame, resource_type: str, keys: list[str]) -> DataFrame:
    """C10 as the older pipeline generation builds it: no resource uuid, one row per
    (bundle_uuid, ``{Type}_url``) (semantic trap 9), merging duplicates the same way."""
    t = silver_table(ent, resource_type, keys)
    uuid_c, _bundle_c, url_c = fixed_columns(resource_type)
    return t.drop(uuid_c).withColumnRenamed(url_c, f"{resource_type}_url")
