"""Lateral explodes of variant arrays and objects.

``variant_explode`` semantics: arrays give (pos, NULL key, value); objects give
(pos, key, value) in sorted key order; NULL or scalar input gives no row
(``outer=True`` keeps one NULL row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import as_array, as_object, get


def explode_array(df: DataFrame, v: Column | str, prefix: str = "", outer: bool = False) -> DataFrame:
    """Lateral explode of a variant array: adds ``{prefix}pos`` and ``{prefix}value``."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select("*", gen(as_array(v)).alias(f"{prefix}pos", f"{prefix}value"))


def explode_object(df: DataFrame, v: Column | str, prefix: str = "", outer: bool = False) -> DataFrame:
    """Lateral explode of a variant object: adds ``{prefix}pos``, ``{prefix}key``, ``{prefix}value``."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select("*", gen(as_object(v)).alias(f"{prefix}pos", f"{prefix}key", f"{prefix}value"))


def object_fields(v: Column | str, keys: list[str], prefix: str = "") -> list[Column]:
    """``LATERAL variant_explode(obj) |> PIVOT (first(value) FOR key IN (keys))`` grouped by
    the row itself, written as what it equals: one field read per key (object keys
    are unique once parsed), so no shuffle is needed."""
    return [get(v, f"$['{k}']").alias(prefix + k) for k in keys]
