"""Range join through an index of period bins.

Few equality keys (six price keys, say) would put each key's rows into one task.  Periods are cut
into bins of ``BIN_DAYS`` days, and a point's bin joins beside the keys, so rows are dealt by (keys,
bin); the exact borders are a residual predicate.  A hot bin is split further by AQE, as the join is
an ordinary equi join, or needs no shuffle of the points at all where the binned periods are small
enough to broadcast (checked by bytes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import small_side

BIN_DAYS = 32


def bin_of(day: str):
    return F.floor(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) / F.lit(BIN_DAYS))


def binned(periods: DataFrame, points: DataFrame, day: str, since: str, until: str) -> DataFrame:
    """``periods`` once for every bin they meet, as ``bin``; an open end (NULL) reaches the last day
    of ``points`` (one aggregate, one value)."""
    last = F.lit(points.agg(F.max(day)).first()[0])
    rows = periods.withColumn("open end", F.coalesce(F.col(until), F.greatest(last, F.col(since))))
    return rows.where(F.col(since) <= F.col("open end")).withColumn(
        "bin", F.explode(F.sequence(bin_of(since), bin_of("open end")))).drop("open end")


def range_join(points: DataFrame, periods: DataFrame, keys: list[str], day: str, since: str, until: str,
               values: list[str]) -> DataFrame:
    """``points`` with ``values`` of every period of their key that holds their day (``until``
    inclusive, NULL open); points without a period stay, with NULLs."""
    index = binned(periods, points, day, since, until).select(
        *[F.col(k).alias(f"period {k}") for k in keys], F.col(since).alias("period since"),
        F.col(until).alias("period until"), "bin", *values)
    side = small_side(index)
    rows = points.withColumn("point bin", bin_of(day))
    cond = [rows[k] == side[f"period {k}"] for k in keys]
    cond += [rows["point bin"] == side["bin"], rows[day] >= side["period since"],
             (rows[day] <= side["period until"]) | side["period until"].isNull()]
    return rows.join(side, cond, "left").select(*[rows[c] for c in points.columns], *[side[v] for v in values])
