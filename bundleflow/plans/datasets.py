"""Materialised hops per input folder: variant bronze, entries, nested bundles.

Each hop is written once under the shared work folder and scanned afterwards,
like the reference's streaming tables.  ``entries`` is partitioned by
``resourceType`` so per-type silver builds read only their partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path
from ..sinks.store import dataset_root, materialize
from . import bronze, resources, synth


def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return join_path(dataset_root(spark, sf_dir), name)


def bronze_text(spark: SparkSession, sf_dir: str, id_mode: str = "hash") -> DataFrame:
    """C1 over generated order bundles (lazy; the text is not stored twice)."""
    ob = synth.order_bundles(spark, sf_dir)
    return bronze.bronze_from_text(ob, id_mode, F.col("bundle_id"))


def _hashed(stored: DataFrame) -> DataFrame:
    """A hop as its readers see it: stored is the key of a bundle's source, for its hash, the bundle's
    id, packs to nothing and would stand in every entry of the bundle."""
    return stored.withColumn("bundle_uuid", bronze.stable_bundle_uuid(F.col("bundle_uuid")))


def _stored_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, _path(spark, sf_dir, "bronze_variant"),
                       lambda: bronze.variant_bronze(bronze_text(spark, sf_dir, "key")))


def bronze_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2, materialised."""
    return _hashed(_stored_variant(spark, sf_dir))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundles that did not parse, with their text (V23), read from the stored hop."""
    return bronze.quarantine(bronze_variant(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry rows, partitioned by ``resourceType``.

    A narrow explode of the stored bundles, written where the rows lie: no entry is shuffled or
    sorted, each task writes one file per type (``configure`` lets it keep several writers open).
    ``bundle_uuid`` and ``resource_uuid``, hashes that no packing shortens, are not stored.
    """
    stored = materialize(spark, _path(spark, sf_dir, "entries"),
                         lambda: resources.entries(_stored_variant(spark, sf_dir)).drop("resource_uuid"),
                         partition_by=["resourceType"])
    return _hashed(stored).withColumn("resource_uuid", resources.resource_uuid())


def repeated_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of eight bytes (``bundle_hash``) of all bundle ids that several bundles have, and of a few more
    whose hashes are equal by chance; materialised, as its size decides how it is joined."""
    ids = bronze_variant(spark, sf_dir).select(F.xxhash64("bundle_uuid").alias("bundle_hash"))
    return materialize(spark, _path(spark, sf_dir, "repeated_bundles"),
                       lambda: ids.groupBy("bundle_hash").count().where("count > 1").select("bundle_hash"))


def resources_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 from the stored entries (a narrow explode; cheaper to recompute than to store 10x rows)."""
    return resources.resources_long(entries(spark, sf_dir))


def resource_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7, materialised (small: one row per (type, key))."""
    return materialize(spark, _path(spark, sf_dir, "resource_schemas"),
                       lambda: resources.resource_schemas(resources_long(spark, sf_dir)))


def nested_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant bronze of the per-customer outer bundles (C17-C19 input)."""
    return materialize(spark, _path(spark, sf_dir, "nested_variant"),
                       lambda: synth.customer_bundles_variant(bronze_variant(spark, sf_dir)))


def registry_keys(spark: SparkSession, sf_dir: str, resource_type: str) -> list[str]:
    """Sorted key list of one type from the registry (bounded by schema width)."""
    rows = (resource_schemas(spark, sf_dir).where(F.col("resourceType") == resource_type)
            .select("column_name").orderBy("column_name").collect())
    return [r.column_name for r in rows]


def silver(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    """C10 for one type with the registry's key list (projection; see silver.py)."""
    from .silver import silver_table
    return silver_table(entries(spark, sf_dir), resource_type, registry_keys(spark, sf_dir, resource_type))


def bundle_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.bundle_meta(bronze_variant(spark, sf_dir))
