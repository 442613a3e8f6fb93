"""Clustering of a written table on several columns.

A row's place on a space-filling curve comes from the quantile ranks of its clustering columns, their
bits interleaved: rows close in any of the columns lie close on the curve.  One range partitioning by
the curve deals the rows to files of equal size, so a filter on either column meets few row groups.
Ranks, not values, make it even for skewed columns.  The quantiles are sketched in one pass (bounded
by ``RANKS`` per column); files are bounded by the number of partitions that the range takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

BITS = 8
RANKS = 1 << BITS


def _ordinal(df: DataFrame, column: str) -> Column:
    """A number that sorts as the column does (of a string: its first six bytes)."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def curve(df: DataFrame, columns: list[str]) -> Column:
    """The place of a row on the curve; NULLs come first in their column."""
    shares = F.array(*[F.lit(i / RANKS) for i in range(1, RANKS)])
    ordinals = [_ordinal(df, c) for c in columns]
    borders = df.agg(*[F.percentile_approx(o, shares, 10 * RANKS).alias(f"b{i}") for i, o in enumerate(ordinals)]).first()
    place = F.lit(0).cast("long")
    for i, o in enumerate(ordinals):
        # the bits of a rank, spread to the column's turns on the curve
        ranks = [min(below + 1, RANKS - 1) for below in range(RANKS)]
        spread = [sum((r >> b & 1) << (b * len(columns) + i) for b in range(BITS)) for r in ranks]
        below = _borders_below(o, sorted(set(borders[i] or [])))
        place = place.bitwiseOR(F.when(o.isNotNull(), F.get(_numbers(spread, "bigint"), below)).otherwise(F.lit(0).cast("long")))
    return place


def _numbers(values: list, kind: str) -> Column:
    return F.array(*[F.lit(x).cast(kind) for x in values])


def _borders_below(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` lie below the value, by halving: ``BITS`` comparisons a row.
    The list is filled up to ``RANKS - 1`` with NaN, which lies below nothing."""
    filled = _numbers(cuts + [float("nan")] * (RANKS - 1 - len(cuts)), "double")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(filled, n + step - 1) < value, n + step).otherwise(n))


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` dealt and sorted by the curve (one column: by the column itself)."""
    if len(columns) == 1:
        return df.repartitionByRange(F.col(f"`{columns[0]}`")).sortWithinPartitions(f"`{columns[0]}`")
    placed = df.withColumn("curve place", curve(df, columns))
    return placed.repartitionByRange("curve place").sortWithinPartitions("curve place").drop("curve place")
