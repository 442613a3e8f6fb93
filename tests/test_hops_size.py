"""What the bundle hops shuffle and store, and the counts that rest on them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from bundleflow.plans import datasets as ds
from bundleflow.plans.declare import infer_by_group, typed_groups
from bundleflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan()


def _shuffled_rows(df):
    """Rows that the shuffles of ``df`` wrote in its last run."""
    total, todo = 0, [_plan(df)]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += p.metrics().get("shuffleRecordsWritten").get().value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Order 1 stands three times, with lines; order 2 once; one order and one line have no key."""
    folder = os.path.join(str(tmp_path_factory.mktemp("odd")), "sf")
    day = dt.datetime(1995, 3, 1)
    rows = {
        "orders": [(k, 1, "O", 10.0, day, "1-URGENT") for k in (1, 1, 1, 2, None)],
        "lineitem": [(k, n, 1, n, 1.0, 2.0, 0.1, 0.2, "A", "F", day) for k, n in ((1, 1), (1, 2), (2, 1), (3, 1), (None, 1))],
    }
    names = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
             "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                          "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]}
    for t in TABLES:
        src = spark.read.parquet(f"{SF}/{t}.parquet")
        df = src
        if t in rows:
            types = {f.name: f.dataType.simpleString() for f in src.schema.fields}
            df = spark.createDataFrame([tuple(r) for r in rows[t]], ", ".join(
                f"{n} {'timestamp' if 'date' in n else 'double' if isinstance(rows[t][0][i], float) else 'long' if isinstance(rows[t][0][i], int) else 'string'}"
                for i, n in enumerate(names[t]))).select(*[F.col(n).cast(types[n]).alias(n) for n in names[t]])
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return folder


def test_counts_are_of_distinct_keys(spark, odd):
    """Also where bundles share an id, or have none."""
    ent = ds.entries(spark, odd).where(F.col("resource").isNotNull())
    exact = ent.select("resourceType", F.concat("bundle_uuid", "fullUrl").alias("k")).distinct().groupBy("resourceType").count()
    found = {r.resourceType: r.cnt for r in se.queries()["resource_counts"](spark, odd).collect()}
    assert found == {r[0]: r[1] for r in exact.collect()}
    assert ent.count() > sum(found.values()) and found["LineItem"] >= 4


def test_counting_shuffles_no_entry_that_is_distinct_as_it_stands(spark):
    n = ds.entries(spark, SF).count()
    counts = se.queries()["resource_counts"](spark, SF)
    assert sum(r.cnt for r in counts.collect()) == n
    assert _shuffled_rows(counts) < 100 < n


def test_no_hash_of_a_bundle_is_stored(spark):
    for name, df in (("bronze_variant", ds.bronze_variant(spark, SF)), ("entries", ds.entries(spark, SF))):
        stored = spark.read.parquet(ds._path(spark, SF, name))
        assert stored.agg(F.max(F.length("bundle_uuid"))).first()[0] < 20
        seen = stored.select(F.sha2(F.concat(F.lit("bundle:"), "bundle_uuid"), 256).alias("bundle_uuid"))
        assert seen.exceptAll(df.select("bundle_uuid")).isEmpty() and df.count() == seen.count()
    uuids = ds.bronze_text(spark, SF).select("bundle_uuid").distinct()
    assert uuids.exceptAll(ds.bronze_variant(spark, SF).select("bundle_uuid").distinct()).isEmpty()


def test_typed_groups_keep_every_row(spark):
    rows = spark.createDataFrame(
        [("a", '{"x": 1}', "A"), ("b", '{"x": 2}', "A"), ("c", '{"y": [1, 2]}', "B.b"), ("d", None, "C"), ("e", '{"z": 1}', None)],
        "id string, text string, kind string").withColumn("v", F.try_parse_json("text")).drop("text")
    typed = typed_groups(rows, "kind", "v", infer_by_group(rows, "kind", ["v"]))
    assert typed.columns == ["id", "kind", "A", "B.b", "C"]
    found = {r.id: (r.kind, r["A"] and r["A"].x, r["B.b"] and r["B.b"].y) for r in typed.collect()}
    assert found == {"a": ("A", 1, None), "b": ("A", 2, None), "c": ("B.b", None, [1, 2]), "d": ("C", None, None),
                     "e": (None, None, None)}
    # one cast a branch, none in a case of several
    assert "CASE WHEN" not in typed._jdf.queryExecution().optimizedPlan().toString()
