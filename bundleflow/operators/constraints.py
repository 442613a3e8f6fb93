"""D3: declared constraints checked as one job (Parquet has no constraint DDL).

Every table is scanned once.  A row gives one tagged key for each check that concerns it; all checks
of all tables are then counted by one grouping, whose partial aggregates collapse a hot key before
it is shuffled.  A foreign key needs no join: the keys of child and parent meet in their group.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "check_name string, table_name string, violations long"


@dataclass(frozen=True)
class Checks:
    """The checks of one table: columns that are never null, keys, columns that refer to another
    table's key (name of the reference), and keys that others refer to."""

    not_null: list[str] = field(default_factory=list)
    keys: list[list[str]] = field(default_factory=list)
    refers: dict[str, str] = field(default_factory=dict)
    referred: dict[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return ([f"not_null:{c}" for c in self.not_null] + [f"primary_key:{','.join(k)}" for k in self.keys]
                + [f"foreign_key:{c}" for c in self.refers])


def _tag(check: str, table: str, key: Column, child: int, parent: int) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), key.alias("key"),
                    F.lit(child).alias("child"), F.lit(parent).alias("parent"))


def tagged(df: DataFrame, table: str, checks: Checks, owners: dict[str, tuple[str, str]]) -> DataFrame:
    """(check_name, table_name, key, child, parent) of every row of ``df``; ``owners`` names check and
    table that use a reference."""
    none = F.lit(None).cast("string")
    tags = [F.when(F.col(c).isNull(), _tag(f"not_null:{c}", table, none, 1, 0)) for c in checks.not_null]
    # the text of the key's columns as JSON: equal for equal keys only
    tags += [_tag(f"primary_key:{','.join(k)}", table, F.to_json(F.struct(*k), {"ignoreNullFields": "false"}), 1, 0)
             for k in checks.keys]
    tags += [F.when(F.col(c).isNotNull(), _tag(f"foreign_key:{c}", table, F.col(c).cast("string"), 1, 0))
             for c in checks.refers]
    tags += [F.when(F.col(c).isNotNull(), _tag(*owners[name], F.col(c).cast("string"), 0, 1))
             for c, name in checks.referred.items() if name in owners]
    return df.select(F.inline(F.array_compact(F.array(*tags))))


def report(spark: SparkSession, tables: dict[str, tuple[DataFrame, Checks]]) -> DataFrame:
    """(check_name, table_name, violations): one row per check, zero where none is violated.

    NOT NULL: rows with a null; key: rows beyond the first of a key; reference: rows whose key the
    other table lacks.
    """
    names = [(n, t) for t, (_, c) in tables.items() for n in c.names()]
    if not names:
        return spark.createDataFrame([], REPORT_SCHEMA)
    owners = {ref: (f"foreign_key:{c}", t) for t, (_, checks) in tables.items() for c, ref in checks.refers.items()}
    rows = reduce(DataFrame.unionByName, [tagged(df, t, c, owners) for t, (df, c) in tables.items()])
    keys = rows.groupBy("check_name", "table_name", "key").agg(
        F.sum(F.col("child").cast("long")).alias("child"), F.max("parent").alias("parent"))
    wrong = (F.when(F.col("check_name").startswith("primary_key:"), F.greatest(F.col("child") - 1, F.lit(0)))
             .when(F.col("check_name").startswith("foreign_key:"), F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
             .otherwise(F.col("child")))
    found = keys.groupBy("check_name", "table_name").agg(F.sum(wrong).alias("violations"))
    listed = spark.createDataFrame(names, "check_name string, table_name string")
    return listed.join(found, ["check_name", "table_name"], "left").select(
        "check_name", "table_name", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
