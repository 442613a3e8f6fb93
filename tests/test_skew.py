"""Hot keys and missing orders: every bundle query still equals its oracle."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from bundleflow.plans import catalog
from bundleflow.sources.tables import TABLES
from test_queries import _rows

SRC = "/root/testdata/sf0.001"
BUNDLE_QUERIES = sorted(q for q, sql in catalog.ORACLES.items() if "orders" in sql or "lineitem" in sql)


def _copy(spark, folder, change):
    for t in TABLES:
        change(t, spark.read.parquet(f"{SRC}/{t}.parquet")).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """One order holds half of the lines, one customer half of the orders."""
    def change(t, df):
        half = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
        if t == "lineitem":
            return df.withColumn("l_orderkey", F.when(half, F.lit(1)).otherwise(F.col("l_orderkey")))
        if t == "orders":
            return df.withColumn("o_custkey", F.when(half, F.lit(7)).otherwise(F.col("o_custkey")))
        return df
    return _copy(spark, os.path.join(str(tmp_path_factory.mktemp("hot")), "sf"), change)


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    """Ten orders are left; the lines of all others stand without an order."""
    def change(t, df):
        return df.orderBy("o_orderkey").limit(10) if t == "orders" else df
    return _copy(spark, os.path.join(str(tmp_path_factory.mktemp("cut")), "sf"), change)


def _check(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    df = se.queries()[name](spark, folder)
    res = con.execute(catalog.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, res.fetchall())


@pytest.mark.parametrize("name", BUNDLE_QUERIES)
def test_hot_order_and_customer(spark, hot, name):
    _check(spark, hot, name)


@pytest.mark.parametrize("name", BUNDLE_QUERIES)
def test_lines_without_an_order(spark, cut, name):
    _check(spark, cut, name)


@pytest.fixture(scope="module")
def huge(spark, tmp_path_factory):
    """One order has so many lines that its document exceeds the size of one VARIANT value."""
    lines = 330_000

    def change(t, df):
        if t != "lineitem":
            return df.orderBy("o_orderkey").limit(300) if t == "orders" else df
        first = df.select(F.min("l_orderkey")).first()[0]
        one = df.where(F.col("l_orderkey") == first).limit(1)
        many = one.drop("l_linenumber").crossJoin(spark.range(lines).select(
            F.col("id").cast(df.schema["l_linenumber"].dataType).alias("l_linenumber"))).withColumn(
            "l_returnflag", F.repeat("l_returnflag", F.lit(300)))
        return df.unionByName(many.select(*df.columns))
    return _copy(spark, os.path.join(str(tmp_path_factory.mktemp("huge")), "sf"), change)


def test_the_document_exceeds_one_value(spark, huge):
    from bundleflow.plans import datasets as ds
    size = ds.bronze_text(spark, huge).select(F.max(F.length("value"))).first()[0]
    assert size > 143_000_000
    rows = ds.bronze_variant(spark, huge)
    assert rows.where("parts IS NOT NULL").count() == 1 and rows.where("fhir IS NULL").count() == 0
    assert ds.quarantine(spark, huge).count() == 0


@pytest.mark.parametrize("name", ["resource_counts", "silver_lineitem", "silver_order", "entry_table", "bundle_meta",
                                  "bundle_header", "nested_bundle", "prior_auth_arrays", "claim_review", "array_paths",
                                  "event_type_profile", "reference_join", "resources_long"])
def test_document_above_the_size_of_one_value(spark, huge, name):
    _check(spark, huge, name)


def test_reference_join_without_customers(spark, tmp_path_factory):
    """Lines whose order names an unknown customer stay, without a customer."""
    folder = _copy(spark, os.path.join(str(tmp_path_factory.mktemp("few")), "sf"),
                   lambda t, df: df.where("c_custkey % 2 = 0") if t == "customer" else df)
    known = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet").join(known, F.col("o_custkey") == F.col("c_custkey"), "left")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    want = lines.groupBy(F.col("o_orderkey").cast("string"), F.col("c_custkey").cast("string")).count().collect()
    found = se.queries()["reference_join"](spark, folder).groupBy("order_id", "customer_id").count().collect()
    assert any(r.customer_id is None for r in found)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, map(tuple, want)))
