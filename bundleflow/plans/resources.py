"""Bundle header, entry rows, long key/value rows, resource types, schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import as_object, get, object_to_struct, schema_agg


def bundle_meta(vb: DataFrame) -> DataFrame:
    """One row per bundle with header fields and the ``Meta`` object (case-sensitive path)."""
    return vb.where(F.col("fhir").isNotNull()).select(
        "bundle_uuid", "file_metadata", "ingest_time",
        get("fhir", "$.resourceType", "string").alias("bundle_resourceType"),
        get("fhir", "$.type", "string").alias("bundle_type"),
        get("fhir", "$.Meta").alias("meta"),
    )


def meta_exploded(vb: DataFrame) -> DataFrame:
    """C4 first half: ``Meta`` as (bundle_uuid, pos, key, value) rows."""
    return vb.select(
        "bundle_uuid", "ingest_time",
        F.posexplode(as_object(get("fhir", "$.Meta"))).alias("pos", "key", "value"),
    )


def resource_uuid() -> Column:
    """The id of an entry: a hash of its bundle's id and its url."""
    return F.sha2(F.concat("bundle_uuid", "fullUrl"), 256)


def entries(vb: DataFrame) -> DataFrame:
    """One row per bundle entry (V12): the entry-level form of the long table.

    ``dup_url`` flags entries whose ``fullUrl`` occurs more than once in the same bundle.  The flags
    are found inside the bundle row, before it is exploded (urls sorted with their places, compared
    with their neighbours, put back in order), so they need no shuffle and no row carries the urls
    of its bundle.  Bundles without ``entry`` give no rows.
    """
    # one cast reads all that is kept of all entries (an entry by itself only where the bundle was cut):
    # a resource is copied once, not with its entry first
    kept = "struct<fullUrl: string, request: variant, resource: variant>"
    arr = F.coalesce(F.transform("parts", lambda e: F.try_variant_get(e, "$", kept)),
                     F.try_variant_get("fhir", "$.entry", f"array<{kept}>"))
    staged = vb.where(F.col("fhir").isNotNull()).select("bundle_uuid", arr.alias("_arr"))
    staged = staged.withColumn("_urls", F.col("_arr")["fullUrl"])
    # NULL urls group together in the reference's pivot, so several of them count as duplicates
    repeats = F.size(F.array_distinct("_urls")) < F.size("_urls")
    staged = staged.withColumn("_sorted", F.when(repeats, F.sort_array(
        F.transform("_urls", lambda u, i: F.struct(u.alias("url"), i.alias("place"))))))
    flags = F.expr("transform(_sorted, (x, i) -> struct(x.place, (i > 0 and get(_sorted, i - 1).url <=> x.url) "
                   "or (i + 1 < size(_sorted) and get(_sorted, i + 1).url <=> x.url) as dup))")
    staged = staged.withColumn("_flags", flags)
    staged = staged.select("bundle_uuid", "_arr", F.coalesce(
        F.transform(F.sort_array("_flags"), lambda x: x["dup"]), F.transform("_arr", lambda _: F.lit(False))).alias("_dup"))
    e = staged.select("bundle_uuid", F.posexplode(F.arrays_zip(F.col("_arr").alias("entry"), F.col("_dup").alias("dup_url")))
                      .alias("entry_pos", "_x")).select("bundle_uuid", "entry_pos", "_x.entry.*", "_x.dup_url")
    return e.select(
        "bundle_uuid",
        "entry_pos",
        "fullUrl",
        get("resource", "$.resourceType", "string").alias("resourceType"),
        resource_uuid().alias("resource_uuid"),
        "dup_url",
        "request",
        "resource",
    )


def resources_long(ent: DataFrame) -> DataFrame:
    """(resource_uuid, bundle_uuid, fullUrl, resourceType, pos, key, value) + entry_pos.

    A narrow explode of each resource object: keys in sorted order, ``pos`` the
    key index.  Entries without a resource object give no rows.
    """
    return ent.select(
        "resource_uuid", "bundle_uuid", "fullUrl", "resourceType", "entry_pos",
        F.posexplode(as_object("resource")).alias("pos", "key", "value"),
    )


def resource_types(ent: DataFrame) -> DataFrame:
    """Distinct resource types (the fan-out list)."""
    return ent.where(F.col("resourceType").isNotNull()).select("resourceType").distinct()


def resource_schemas(long_df: DataFrame) -> DataFrame:
    """Inferred type per (resourceType, key); partial aggregation before the shuffle."""
    return long_df.groupBy("resourceType", F.col("key").alias("column_name")).agg(
        schema_agg("value").alias("schema_of_variant"),
    ).withColumn("schema_as_struct", object_to_struct("schema_of_variant"))
