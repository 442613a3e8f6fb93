"""Text bronze and variant bronze.

Bronze row: (file_metadata, ingest_time, bundle_uuid, value).  Variant bronze holds the parsed
document in ``fhir`` (and ``parts``, see ``variant_bronze``) and keeps the text of malformed rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import parse, parse_parts

BRONZE_COLUMNS = ["file_metadata", "ingest_time", "bundle_uuid", "value"]


def stable_bundle_uuid(source_key: Column) -> Column:
    """Replay-stable bundle id: sha2 over a key of the source (S5 ``id_mode='hash'``)."""
    return F.sha2(F.concat(F.lit("bundle:"), source_key.cast("string")), 256)


def bundle_uuid_column(id_mode: str, source_key: Column | None = None) -> Column:
    """``uuid()`` like the reference, or a hash of the source for replay-safe ids; ``key`` is the
    source's key itself, for tables whose reader hashes it (``stable_bundle_uuid``)."""
    if id_mode == "uuid":
        return F.expr("uuid()")
    if id_mode == "key":
        return source_key.cast("string")
    if id_mode == "hash":
        if source_key is None:
            source_key = F.concat(F.col("file_metadata.file_path"), F.lit("@"),
                                  F.col("file_metadata.file_modification_time").cast("string"))
        return stable_bundle_uuid(source_key)
    raise ValueError(f"id_mode must be 'uuid', 'hash' or 'key', not {id_mode!r}")


def bronze_from_text(df: DataFrame, id_mode: str = "hash", source_key: Column | None = None) -> DataFrame:
    """C1 over any frame with ``file_metadata`` and ``value`` (file scan or generated rows)."""
    return df.select(
        "file_metadata",
        F.current_timestamp().alias("ingest_time"),
        bundle_uuid_column(id_mode, source_key).alias("bundle_uuid"),
        "value",
    )


def variant_bronze(bronze: DataFrame) -> DataFrame:
    """Parse once.

    ``fhir`` is the whole document, and ``parts`` NULL.  A document beyond the size of one VARIANT
    value is cut: ``fhir`` is its header and ``parts`` its entries, each a VARIANT (``entry_array``
    reads either form).  Text that is no JSON has neither and stays in ``unparsed`` for the
    quarantine; no row is dropped here.
    """
    rows = bronze.select("bundle_uuid", "ingest_time", "file_metadata", "value", parse("value").alias("_whole"))
    # the second look is only taken at rows that the first could not read
    rows = rows.withColumn("_cut", parse_parts(F.when(F.col("_whole").isNull(), F.col("value"))))
    fhir = F.coalesce("_whole", "_cut.header")
    return rows.select("bundle_uuid", "ingest_time", "file_metadata", fhir.alias("fhir"),
                       F.col("_cut.entries").alias("parts"), F.when(fhir.isNull(), F.col("value")).alias("unparsed"))


def entry_array(fhir: str = "fhir", parts: str = "parts") -> Column:
    """The entries of a variant-bronze row as ARRAY<VARIANT>; NULL where there are none."""
    return F.coalesce(F.col(parts), F.try_variant_get(F.col(fhir), "$.entry", "array<variant>"))


def quarantine(variant_rows: DataFrame) -> DataFrame:
    """The bronze rows whose text does not parse, with their text, from the variant bronze
    (nothing is parsed a second time)."""
    return variant_rows.where(F.col("fhir").isNull()).select(
        "file_metadata", "ingest_time", "bundle_uuid", F.col("unparsed").alias("value"))
