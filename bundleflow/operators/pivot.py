"""Pivots with a fixed or a data-derived value list.

The value list is always passed explicitly, which saves Spark the extra
distinct job.  A data-derived list (A13) is collected from a DataFrame whose size
is bounded by the schema (distinct keys), never by the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_fixed(df: DataFrame, group_cols: list[str], key_col: str, values: list[str],
                agg: Column | None = None, value_col: str = "value") -> DataFrame:
    """``PIVOT (first(value) FOR key IN (values))`` grouped by ``group_cols``."""
    agg = agg if agg is not None else F.first(value_col)
    return df.groupBy(*group_cols).pivot(key_col, values).agg(agg)


def distinct_values(df: DataFrame, col: str) -> list[str]:
    """A13 step 1: sorted distinct values of a column of keys.  They become columns, so their
    number is bounded by the width of the resulting schema."""
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def pivot_data_keys(df: DataFrame, group_cols: list[str], key_col: str,
                    agg: Column | None = None, value_col: str = "value") -> DataFrame:
    """Two-step pivot, keys collected from the data first."""
    return pivot_fixed(df, group_cols, key_col, distinct_values(df, key_col), agg, value_col)
