"""J2-J5 helpers: size-checked broadcast and in-bundle reference joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """Size in bytes that the optimizer estimates for ``df`` from file statistics (no job)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated bytes are below ``max_bytes``; beyond it the join
    is left to the planner, and AQE may still broadcast on the size measured at run time."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def reference_key(full_url: Column) -> Column:
    """J5: 'Type/id' from the last two segments of a fullUrl (works for relative and absolute urls)."""
    parts = F.split(full_url, "/")
    return F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))


def url_segment(url: Column, index: int) -> Column:
    """``url.split('/')[index]`` with Python-style negative indexes."""
    parts = F.split(url, "/")
    return F.element_at(parts, index if index < 0 else index + 1)
