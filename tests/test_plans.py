"""Physical-plan shape of the Spark-first designs (guards against regressions to shuffles)."""

import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = se.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["prior_auth_arrays", "bundle_header", "array_paths", "entry_table", "bundle_meta"])
def test_per_row_views_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_silver_reads_one_type_and_shuffles_only_duplicates(spark):
    p = plan(spark, "silver_order")
    assert "resourceType#" in p and "= Order" in p  # partition filter on the stored entries
    assert p.count("Exchange hashpartitioning") == 1  # the duplicate-fullUrl branch only
    assert "EqualTo(dup_url,true)" in p  # ...which reads only row groups that can hold duplicates


def test_price_periods_are_broadcast(spark):
    p = plan(spark, "usage_cost")
    assert "BroadcastHashJoin" in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_reference_join_is_a_projection(spark):
    p = plan(spark, "reference_join")
    assert "Exchange" not in p and "Join" not in p and p.count("Scan parquet") == 1


def test_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "topk_latest")


def test_variant_paths_are_pushed_to_the_scan(spark):
    p = plan(spark, "silver_lineitem")
    assert "ReadSchema: struct<" in p or "struct<" in p
    assert "resource:struct<0:" in p  # only the requested variant paths are read


def test_batch_entries_write_is_rebalanced(spark):
    from bundleflow.plans import datasets as ds, resources
    df = resources.entries(ds.bronze_variant(spark, SF)).hint("rebalance", "resourceType")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in p or "RebalancePartitions" in p or "rebalance" in p.lower()


@pytest.mark.parametrize("name", ["meta_pivot", "reference_join"])
def test_look_ups_in_one_object_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_coordinates_shuffle_nothing_but_duplicates(spark):
    assert plan(spark, "triple_explode_pivot").count("Exchange hashpartitioning") == 1  # as in silver_order


def test_exploded_rows_carry_no_list_of_their_bundle(spark):
    """The explode of entries keeps the bundle's id only; a list beside it would be quadratic."""
    from bundleflow.plans import datasets as ds, resources
    entries = resources.entries(ds.bronze_variant(spark, SF))._jdf.queryExecution().executedPlan().toString()
    kept = entries.split("Generate posexplode")[1].split("), [")[1].split("]")[0]
    assert kept.startswith("bundle_uuid#") and "," not in kept


def test_declared_older_tables_hold_no_rows(spark):
    """Key drift reads the columns of the stored tables; their rows are never written for it."""
    from bundleflow.plans import datasets as ds
    from bundleflow.session import join_path
    from bundleflow.sinks.store import dataset_root
    se.queries()["new_keys"](spark, SF).count()
    stored = spark.read.parquet(join_path(dataset_root(spark, SF), "silver_before_lineitem"))
    assert stored.count() == 0 and len(stored.columns) > 3 and ds.silver(spark, SF, "LineItem").count() > 0


def test_bundle_texts_are_built_after_the_last_shuffle(spark):
    """Columns travel through the joins of the input; no JSON text does."""
    from bundleflow.plans import datasets as ds
    lines = ds.bronze_text(spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    texts = [i for i, x in enumerate(lines) if "to_json" in x.lower() or "structstojson" in x.lower()]
    shuffles = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert texts and shuffles and max(texts) < min(shuffles)  # the plan's root comes first


def test_entries_are_stored_without_a_shuffle(spark, monkeypatch):
    from bundleflow.plans import datasets as ds
    se.queries()["resource_types"](spark, SF).count()
    path = ds._path(spark, SF, "entries")
    stored = spark.read.parquet(path)
    assert "resource_uuid" not in stored.columns and "dup_url" in stored.columns
    assert all(".zstd." in f for f in stored.inputFiles())
    import pyarrow.parquet as pq
    assert "typed_value" not in str(pq.ParquetFile(stored.inputFiles()[0].removeprefix("file:")).schema)  # values lie whole
    built = {}
    keep = ds.materialize
    monkeypatch.setattr(ds, "materialize", lambda s, p, build, **k: built.setdefault(p, build) and keep(s, p, build, **k))
    whole = ds.entries(spark, SF)
    plan_text = built[path]()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan_text and "ebalance" not in plan_text
    assert whole.where("resource_uuid <> sha2(concat(bundle_uuid, fullUrl), 256)").count() == 0
    assert whole.where("resource_uuid IS NULL").count() == 0


def test_a_resource_is_read_from_its_bundle_by_one_cast(spark):
    """Neither the entry nor, in a nested bundle, the bundle and its entries are copied on the way."""
    from bundleflow.plans import datasets as ds, resources
    from bundleflow.plans.bundles import bundle_header, entry_table, nested_resources
    p = resources.entries(ds.bronze_variant(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "$.resource, VariantType" not in p
    nested = nested_resources(entry_table(bundle_header(ds.nested_variant(spark, SF))), "Order")
    p = nested._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrayType(VariantType" not in p.split("posexplode")[1]  # the inner explode, nearer to the result


def test_odd_entries_keep_their_rows(spark):
    """Entries that are no objects, lack a resource or hold a null request give the rows they gave."""
    from pyspark.sql import functions as F
    from bundleflow.plans import bronze, resources
    text = ('{"entry":[7,null,{"fullUrl":5},{"fullUrl":"a","resource":{"resourceType":"X"},"request":null},'
            '{"fullUrl":"a","resource":"t"},{"resource":{"resourceType":"Y","n":[1]}}]}')
    b = spark.createDataFrame([("u", text), ("v", '{"entry":{}}')], "bundle_uuid string, value string").select(
        "bundle_uuid", F.current_timestamp().alias("ingest_time"), F.lit(None).cast("string").alias("file_metadata"), "value")
    rows = resources.entries(bronze.variant_bronze(b)).orderBy("entry_pos").select(
        "fullUrl", "resourceType", "dup_url", F.to_json("request"), F.to_json("resource")).collect()
    assert [tuple(r) for r in rows] == [
        (None, None, True, None, None), (None, None, True, None, None), ("5", None, False, None, None),
        ("a", "X", True, "null", '{"resourceType":"X"}'), ("a", None, True, None, '"t"'),
        (None, "Y", True, None, '{"n":[1],"resourceType":"Y"}')]


def test_bundle_texts_need_no_pattern(spark):
    from bundleflow.plans import synth
    assert "regexp_replace" not in synth.order_bundles(spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_bundle_text_of_many_lines(spark, tmp_path):
    """More lines than one call writes keep their order and places; lines without a key have no entry."""
    import json

    from bundleflow.plans import synth
    n = 2 * synth.PART_ENTRIES + 1
    spark.sql("SELECT 7L AS o_orderkey, 3L AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice, "
              "timestamp'1995-01-02' AS o_orderdate, '1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 3L AS c_custkey, '[\"]' AS c_name, 1 AS c_nationkey, 2.5D AS c_acctbal, 'X' AS c_mktsegment").write.parquet(
        f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql(f"SELECT if(id = 0, NULL, 7L) AS l_orderkey, cast(id AS int) AS l_linenumber, id AS l_partkey, id AS l_suppkey, "
              f"1.0D AS l_quantity, 1.0D AS l_extendedprice, 0.0D AS l_discount, 0.0D AS l_tax, '[A]' AS l_returnflag, "
              f"']' AS l_linestatus, timestamp'1995-01-03' AS l_shipdate FROM range({n + 1})").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {r.bundle_id: r for r in synth.order_bundles(spark, str(tmp_path)).collect()}
    assert set(found) == {"7", None} and json.loads(found[None].value)["entry"] == []
    text = found["7"].value
    entries = json.loads(text)["entry"]
    assert [e["fullUrl"] for e in entries] == ["Order/7", "Customer/3", *(f"LineItem/7-{i}" for i in range(1, n + 1))]
    assert [e["resource"]["linenumber"] for e in entries[2:]] == list(range(1, n + 1))
    assert entries[1]["resource"]["name"] == '["]' and entries[-1]["resource"]["linestatus"] == "]"
    assert json.loads(text)["Meta"]["Transmission"]["Id"] == "7" and found["7"].file_metadata.file_size == len(text)
