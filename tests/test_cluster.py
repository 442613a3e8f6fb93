"""Clustering on several columns: fewer files meet a filter on either of them."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from bundleflow.sinks.store import write_table


def _met(path, column, low, high):
    """Row groups whose statistics meet the range, of all."""
    met = n = 0
    for f in glob.glob(os.path.join(path, "*.parquet")):
        m = pq.ParquetFile(f).metadata
        for g in range(m.num_row_groups):
            stats = {m.row_group(g).column(i).path_in_schema: m.row_group(g).column(i).statistics for i in range(m.num_columns)}[column]
            n += 1
            met += stats is None or not stats.has_min_max or (stats.min <= high and stats.max >= low)
    return met, n


def test_filters_on_either_column_meet_few_groups(spark, tmp):
    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"),
        F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)), F.lit(3)).alias("b"),  # skewed values
        F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)).cast("string"), 4, "0")).alias("s")).repartition(16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df.write.parquet(f"{tmp}/plain")
        write_table(df, f"{tmp}/ab", cluster_by=["a", "b"])
        write_table(df, f"{tmp}/as", cluster_by=["a", "s"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert spark.read.parquet(f"{tmp}/ab").count() == 40_000 and spark.read.parquet(f"{tmp}/ab").columns == ["a", "b", "s"]
    for table, column, low, high in (("ab", "a", 100, 150), ("ab", "b", 1000.0, 1500.0), ("as", "a", 4000, 4050), ("as", "s", "k0500", "k0510")):
        plain, all_ = _met(f"{tmp}/plain", column, low, high)
        met, n = _met(f"{tmp}/{table}", column, low, high)
        assert plain == all_ == 16 and n >= 12 and met <= 6, (table, column, met, n)


def test_nulls_and_empty_tables(spark, tmp):
    df = spark.createDataFrame([(None, 1.0), (2, None), (None, None), (3, 1.0)], "a int, b double")
    write_table(df, f"{tmp}/n", cluster_by=["a", "b"])
    assert sorted(map(str, spark.read.parquet(f"{tmp}/n").collect())) == sorted(map(str, df.collect()))
    write_table(df.limit(0), f"{tmp}/e", cluster_by=["a", "b"])
    assert spark.read.parquet(f"{tmp}/e").count() == 0


def test_ranks_are_found_by_halving(spark):
    """The place of a row is that of its ranks among the borders, without a walk along all of them."""
    from bundleflow.sinks.cluster import RANKS, curve
    df = spark.range(2_000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id") % 31).alias("b"))
    place = curve(df, ["a", "b"])
    plan = df.select(place.alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and plan.count("aggregate(") == 2
    shares = F.array(*[F.lit(i / RANKS) for i in range(1, RANKS)])
    cuts = {c: sorted(set(df.agg(F.percentile_approx(F.col(c).cast("double"), shares, 10 * RANKS)).first()[0])) for c in ("a", "b")}

    def bits(value, borders, turn):
        rank = 0 if value is None else min(sum(x < value for x in borders) + 1, RANKS - 1)
        return sum((rank >> i & 1) << (2 * i + turn) for i in range(8))

    for r in df.select("a", "b", place.alias("p")).collect():
        assert r.p == bits(r.a, cuts["a"], 0) | bits(r.b, cuts["b"], 1)
