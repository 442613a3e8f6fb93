"""C17-C20: bundle header, entry table, nested bundles, per-bundle resource arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import get, to_variant
from ..operators.pivot import pivot_fixed
from .bronze import entry_array

# The keys of the Meta object and the shape of a bundle's meta.
META_KEYS = ["Destinations", "Transmission", "DataModel", "EventType", "Logs"]
BUNDLE_META_STRUCT = "struct<lastUpdated: string, profile: array<string>, versionId: string>"


def bundle_header(vb: DataFrame) -> DataFrame:
    """C17: top-level object explode + header pivot, typed."""
    # Each header key is read straight from the object in one projection (the
    # pivot of a single-object explode); keys equal up to case (meta / Meta)
    # never become same-named intermediate columns.
    return vb.where(F.col("fhir").isNotNull()).select(
        "bundle_uuid", "file_metadata", entry_array().alias("entry"),
        get("fhir", "$['id']", "string").alias("bundle_id"),
        get("fhir", "$['resourceType']", "string").alias("bundle_resourceType"),
        get("fhir", "$['type']", "string").alias("bundle_type"),
        get("fhir", "$['timestamp']", "timestamp").alias("bundle_timestamp"),
        get("fhir", "$['meta']", BUNDLE_META_STRUCT).alias("bundle_meta"),
        get("fhir", "$['Meta']").alias("bundle_meta_v"),
    )


def entry_table(header: DataFrame) -> DataFrame:
    """One row per entry with the request struct and the resource variant."""
    e = header.select(
        *[c for c in header.columns if c != "entry"],
        F.posexplode("entry").alias("entry_pos", "entry_value"))
    return e.select(
        *[c for c in header.columns if c != "entry"], "entry_pos",
        get("entry_value", "$.fullUrl", "string").alias("fullUrl"),
        get("entry_value", "$.request", "struct<method: string, url: string>").alias("request"),
        get("entry_value", "$.resource.resourceType", "string").alias("resourceType"),
        get("entry_value", "$.resource").alias("resource"),
    )


def nested_resources(entries: DataFrame, inner_type: str) -> DataFrame:
    """C19 first half: entries that are bundles, exploded again, keeping ``inner_type``."""
    # one cast reads what is kept of all inner entries: a resource is copied once, not with its bundle,
    # its entry array and its entry first
    kept = "array<struct<fullUrl: string, resource: variant>>"
    b = entries.where(F.col("resourceType") == "Bundle")
    e = b.select(
        "bundle_uuid", "bundle_id", F.col("fullUrl").alias("outer_url"),
        F.col("resourceType").alias("outer_type"),
        F.posexplode(get("resource", "$.entry", kept)).alias("inner_pos", "inner_entry"))
    e = e.select(
        "bundle_uuid", "bundle_id", "outer_url", "outer_type", "inner_pos",
        F.col("inner_entry.fullUrl").alias("inner_url"),
        get("inner_entry.resource", "$.resourceType", "string").alias("inner_resource_type"),
        F.col("inner_entry.resource").alias("inner_resource"),
    )
    return e.where(F.col("inner_resource_type") == inner_type)


def resource_arrays(vb: DataFrame, types: list[str]) -> DataFrame:
    """Per bundle, one array of VARIANT entries per resource type, in bundle order.

    The reference explodes the entries, pivots on resource type and regroups by
    bundle (two aggregations).  All entries of a bundle live in one bronze row,
    so the same arrays are a per-row filter of that row's ``entry`` array: no
    shuffle at all.  A type absent from a bundle gives an empty array.  The arrays stay arrays, as
    those of a large bundle do not fit one VARIANT; ``array_heads`` makes one of their first entries.
    """
    staged = vb.where(F.col("fhir").isNotNull()).select("bundle_uuid", entry_array().alias("_entries"))

    def of_type(t: str) -> Column:
        kept = F.filter(F.coalesce(F.col("_entries"), F.array().cast("array<variant>")),
                        lambda e: F.try_variant_get(e, "$.resource.resourceType", "string") == t)
        return kept.alias(t)

    return staged.select("bundle_uuid", *[of_type(t) for t in types])


def array_heads(arrays: DataFrame, types: list[str], n: int) -> DataFrame:
    """The first ``n`` entries of each type's array as one VARIANT, for root-array paths."""
    return arrays.select("bundle_uuid", *[to_variant(F.slice(t, 1, n)).alias(t) for t in types])


def resource_arrays_grouped(entries: DataFrame, types: list[str]) -> DataFrame:
    """C20 in the reference's shape (explode, pivot by type, regroup by bundle) over entry rows.

    Use when entry rows of one bundle may come from several inputs; otherwise
    ``resource_arrays`` gives the same arrays without the shuffle.
    """
    e = entries.select(
        "bundle_uuid", "resourceType",
        F.struct("entry_pos", F.to_variant_object(F.struct("fullUrl", "resource")).alias("e")).alias("x"))
    p = pivot_fixed(e, ["bundle_uuid"], "resourceType", types, F.collect_list("x"))

    def ordered(c: str) -> Column:
        arr = F.array_sort(F.col(f"`{c}`"), lambda a, b: (a["entry_pos"] - b["entry_pos"]).cast("int"))
        return F.transform(arr, lambda x: x["e"]).alias(c)

    return p.select("bundle_uuid", *[ordered(t) for t in types])
