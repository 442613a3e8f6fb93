import json

import pytest
from pyspark.sql import functions as F

from bundleflow.functions.variant import get
from bundleflow.operators import constraints as C
from bundleflow.operators.joins import reference_key, url_segment
from bundleflow.operators.keys import (KeyCollisionError, check_case_collisions, existing_columns, key_lists, new_keys,
                                       ordered_key_list)
from bundleflow.operators.pivot import distinct_values, pivot_data_keys, pivot_fixed
from bundleflow.plans import bronze, resources
from bundleflow.plans.silver import silver_table
from bundle_rows import bronze_rows


def _bundle(entries):
    return json.dumps({"resourceType": "Bundle", "type": "collection", "entry": entries})


def test_duplicate_fullurl_merges_like_pivot_first(spark):
    text = _bundle([
        {"fullUrl": "P/1", "resource": {"resourceType": "P", "a": 1}},
        {"fullUrl": "P/1", "resource": {"resourceType": "P", "a": 9, "b": "x"}},
        {"fullUrl": "P/2", "resource": {"resourceType": "P", "b": "y"}},
    ])
    ent = resources.entries(bronze.variant_bronze(bronze_rows(spark, [text])))
    assert sorted(r.dup_url for r in ent.collect()) == [False, True, True]
    s = silver_table(ent, "P", ["a", "b"]).select(
        "p_url", get("a", "$", "int").alias("a"), get("b", "$", "string").alias("b"))
    rows = {r.p_url: (r.a, r.b) for r in s.collect()}
    assert rows == {"P/1": (1, "x"), "P/2": (None, "y")}  # first entry having each key wins


def test_bundle_without_entry_gives_no_rows(spark):
    vb = bronze.variant_bronze(bronze_rows(spark, ['{"resourceType":"Bundle"}', "{broken"]))
    assert resources.entries(vb).count() == 0
    assert bronze.quarantine(bronze.variant_bronze(bronze_rows(spark, ["{broken"]))).first().value == "{broken"


def test_key_drift_and_order(spark):
    reg = spark.createDataFrame([("T", "b"), ("T", "a"), ("T", "z"), ("U", "q")], "resourceType string, column_name string")
    ex = existing_columns(spark, "T", ["t_uuid", "bundle_uuid", "t_url", "z", "a"], skip=["t_uuid", "bundle_uuid", "t_url"])
    assert [tuple(r) for r in new_keys(reg.select("resourceType", "column_name"), ex).orderBy("resourceType").collect()] == [
        ("T", "b"), ("U", "q")]
    assert {r.resourceType: r["keys"] for r in key_lists(reg, ex).collect()} == {"T": ["z", "a", "b"], "U": ["q"]}
    assert ordered_key_list(reg, ex, "T") == ["z", "a", "b"] and ordered_key_list(reg, ex, "V") == []


def test_case_collision_fails():
    with pytest.raises(KeyCollisionError):
        check_case_collisions(["meta", "Meta"], "Bundle")


def test_pivots(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "x", 3.0)], "g int, key string, value double")
    p = pivot_fixed(df, ["g"], "key", ["x", "y", "w"]).orderBy("g").collect()
    assert [(r.g, r.x, r.y, r.w) for r in p] == [(1, 1.0, 2.0, None), (2, 3.0, None, None)]
    assert distinct_values(df, "key") == ["x", "y"]
    assert pivot_data_keys(df, ["g"], "key").columns == ["g", "x", "y"]


def test_reference_key_and_segments(spark):
    r = spark.createDataFrame([("http://h/fhir/Patient/7",)], "u string").select(
        reference_key(F.col("u")).alias("k"), url_segment(F.col("u"), -3).alias("s")).first()
    assert r.k == "Patient/7" and r.s == "fhir"


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "c")], "k int, v string")
    parent = spark.createDataFrame([(1,), (None,), (7,), (7,)], "k int")
    checks = {"t": (df, C.Checks(not_null=["v"], keys=[["k"], ["k", "v"]], refers={"k": "p"})),
              "p": (parent, C.Checks(not_null=["k"], keys=[["k"]], referred={"k": "p"}))}
    rep = {(r.table_name, r.check_name): r.violations for r in C.report(spark, checks).collect()}
    assert rep == {("t", "not_null:v"): 1, ("t", "primary_key:k"): 2, ("t", "primary_key:k,v"): 1, ("t", "foreign_key:k"): 1,
                   ("p", "not_null:k"): 1, ("p", "primary_key:k"): 1}
    empty = {t: (d.limit(0), c) for t, (d, c) in checks.items()}
    assert {r.violations for r in C.report(spark, empty).collect()} == {0} and C.report(spark, {}).count() == 0


def test_constraint_report_scans_each_table_once(spark, tmp):
    for name in ("a", "b"):
        spark.range(50).selectExpr("id", "id % 7 AS k").write.parquet(f"{tmp}/{name}")
    a, b = (spark.read.parquet(f"{tmp}/{name}") for name in ("a", "b"))
    plan = C.report(spark, {"a": (a, C.Checks(not_null=["id", "k"], keys=[["id"], ["k"]], refers={"k": "b"})),
                            "b": (b, C.Checks(keys=[["id"]], referred={"k": "b"}))})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_emitted_responses_and_typed_paths(spark, tmp):
    import os

    import pytest

    from bundleflow.plans.writeback import Mapping, bundle_of, emit, nest
    df = spark.createDataFrame([("7", "x"), ("8", None)], "id string, v string")
    res = nest([Mapping("id", "ClaimResponse.id"), Mapping("v", "ClaimResponse.type.coding.code"), Mapping(None, "use", "claim")])
    assert emit(df.select("id", F.to_json(bundle_of(res)).alias("j")), "id", "j", os.path.join(tmp, "out dir")) == 2
    with open(os.path.join(tmp, "out dir", "7.json")) as f:
        assert json.load(f)["entry"][0]["resource"] == {
            "resourceType": "ClaimResponse", "id": "7", "type": {"coding": [{"code": "x"}]}, "use": "claim"}
    with pytest.raises(ValueError):
        nest([Mapping("id", "Claim.id"), Mapping("id", "Patient.id")])


def test_writeback_nesting(spark):
    from bundleflow.plans.writeback import Mapping, bundle_of, nest
    df = spark.createDataFrame([("7", 12.5)], "id string, amount double")
    res = nest([Mapping(None, "resourceType", "ClaimResponse"), Mapping("id", "id"),
                Mapping("amount", "item.adjudication.amount.value"),
                Mapping(None, "item.adjudication.category.coding.code", "submitted")])
    j = json.loads(df.select(F.to_json(bundle_of(res)).alias("j")).first().j)
    item = j["entry"][0]["resource"]["item"]
    assert isinstance(item, list) and item[0]["adjudication"][0]["amount"]["value"] == 12.5
    assert item[0]["adjudication"][0]["category"]["coding"][0]["code"] == "submitted"
    with pytest.raises(ValueError):
        nest([Mapping("id", "a.b"), Mapping("id", "a.b")])


def test_enrichment_requests(spark):
    from bundleflow.plans.enrich import request_batches

    def stub_transport():
        """Answers a GET with the resource it names and a POST with its payload."""
        def call(requests):
            return [{"status_code": 200, "text": json.dumps({"resourceType": r["resource"], "id": r["id"]}, separators=(",", ":")),
                     "url": f"stub://fhir/{r['resource']}/{r['id']}"} if r["method"] == "get" else
                    {"status_code": 201, "text": r["payload"] or "", "url": f"stub://fhir/{r['resource']}"} for r in requests]
        return call

    df = spark.createDataFrame([("1", '{"x":1}')], "id string, body string")
    got = request_batches(df, stub_transport(), "get", "Patient", id_col="id").first()
    assert (got.status_code, got.url) == (200, "stub://fhir/Patient/1") and got.elapsed_seconds >= 0
    post = request_batches(df, stub_transport(), "post", "Patient", payload_col="body").first()
    assert post.status_code == 201 and post.text == '{"x":1}'
    with pytest.raises(ValueError):
        request_batches(df, stub_transport(), "post", "Patient", id_col="id")


def test_copy_files(spark, tmp):
    import os
    from bundleflow.sinks.files import copy_files
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    for n in ("a.json", "b.json", "c.txt"):
        with open(os.path.join(src, n), "w") as f:
            f.write(n)
    st = copy_files(spark, src, os.path.join(tmp, "dst"), "*.json").collect()
    assert sorted(r.status["status"] for r in st) == ["success", "success"]
    os.makedirs(os.path.join(src, "a b", "100%25"))
    for n in ("a b/a.json", "a b/100%25/x y.xml"):
        with open(os.path.join(src, n), "w") as f:
            f.write(n)
    st = copy_files(spark, src, os.path.join(tmp, "all of it"), ["*.json", "*.xml"]).collect()
    assert all(r.status["status"] == "success" for r in st)
    found = sorted(os.path.relpath(os.path.join(d, f), os.path.join(tmp, "all of it"))
                   for d, _, fs in os.walk(os.path.join(tmp, "all of it")) for f in fs)
    assert found == ["a b/100%25/x y.xml", "a b/a.json", "a.json", "b.json"]  # same names, other folders
    assert sorted(os.listdir(os.path.join(tmp, "dst"))) == ["a.json", "b.json"]
    again = copy_files(spark, src, os.path.join(tmp, "dst"), "*.json").collect()  # overwrite is fine
    assert all(r.status["status"] == "success" for r in again)


def test_describe_codes_large_lookup_path(spark, monkeypatch):
    import bundleflow.operators.joins as J
    from bundleflow.plans.enrich import describe_codes
    monkeypatch.setattr(J.small_side, "__defaults__", (0,))  # nothing is small
    df = spark.createDataFrame([("a", "b"), ("c", None)], "c1 string, c2 string")
    lk = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), ("z", "Z")], "k string, d string")
    got = {(r.c1, r.c1_desc, r.c2_desc) for r in describe_codes(df, ["c1", "c2"], lk, "k", "d").collect()}
    assert got == {("a", "A", "B"), ("c", "C", None)}


def test_apply_ddl_direct_and_via_json(spark):
    from bundleflow.plans.writeback import apply_ddl, infer_ddl
    from bundleflow.functions.variant import parse
    v = spark.createDataFrame([('{"a":1.5,"b":{"c":"x"}}',), ('{"a":2,"b":{"c":"y"}}',)], "t string").select(
        parse("t").alias("v"))
    ddl = infer_ddl(v, ["v"])
    direct = sorted((r.v.a, r.v.b.c) for r in apply_ddl(v, ddl).collect())
    via = sorted((r.v.a, r.v.b.c) for r in apply_ddl(v, ddl, via_json=True).collect())
    assert direct == via and [float(a) for a, _ in direct] == [1.5, 2.0]


def test_null_fullurls_merge_like_the_pivot(spark):
    text = _bundle([
        {"resource": {"resourceType": "P", "a": 1}},
        {"resource": {"resourceType": "P", "b": 2}},
        {"resource": {"resourceType": "Q", "c": 3}},
        {"fullUrl": "P/9", "resource": {"resourceType": "P", "a": 5}},
    ])
    ent = resources.entries(bronze.variant_bronze(bronze_rows(spark, [text])))
    s = silver_table(ent, "P", ["a", "b"]).select(
        "p_url", get("a", "$", "int").alias("a"), get("b", "$", "int").alias("b"))
    rows = sorted((r.p_url or "", r.a, r.b) for r in s.collect())
    assert rows == [("", 1, 2), ("P/9", 5, None)]  # the two url-less P entries form one row
    assert silver_table(ent, "Q", ["c"]).count() == 1


def test_odd_entry_shapes_never_drop_rows(spark):
    text = json.dumps({"resourceType": "Bundle", "entry": [
        {"fullUrl": {"not": "a string"}, "resource": {"resourceType": "P", "a": 1}},
        "not an object",
        {"fullUrl": "P/2", "resource": {"resourceType": "P", "a": 2}},
    ]})
    ent = resources.entries(bronze.variant_bronze(bronze_rows(spark, [text])))
    assert ent.where(F.col("dup_url").isNull()).count() == 0
    assert silver_table(ent, "P", ["a"]).count() == 2


def test_legacy_silver_shape(spark):
    from bundleflow.plans.silver import silver_table_legacy
    text = _bundle([{"fullUrl": "P/1", "resource": {"resourceType": "P", "a": 1}}])
    ent = resources.entries(bronze.variant_bronze(bronze_rows(spark, [text])))
    s = silver_table_legacy(ent, "P", ["a"])
    assert s.columns == ["bundle_uuid", "P_url", "a"] and s.count() == 1


def test_file_systems_of_spark_paths():
    from pyarrow import fs as pafs

    from bundleflow.sinks.files import file_system
    for path, want in (("file:/a b/c", "/a b/c"), ("file:///a%20b", "/a%20b"), ("/x y:z", "/x y:z"),
                       ("dbfs:/mnt/a b", "/dbfs/mnt/a b"), ("dbfs:///mnt/a", "/dbfs/mnt/a")):
        fs, p = file_system(path)
        assert isinstance(fs, pafs.LocalFileSystem) and p == want
    asked = []
    resolve = lambda uri: asked.append(uri) or (None, uri.split("//")[1])
    assert file_system("s3a://bucket/some key/%41.json", resolve) == (None, "bucket/some key/%41.json")
    assert file_system("hdfs://host:8020/a b", resolve)[1] == "host:8020/a b" and asked == ["s3://bucket", "hdfs://host:8020"]


def test_schema_apply_with_void(spark):
    from bundleflow.functions.variant import parse
    from bundleflow.plans.writeback import apply_ddl, infer_ddl, without_void
    v = spark.createDataFrame([('{"a":[],"b":null,"c":{"VOID":1}}',), ('{"a":[],"c":{"VOID":2}}',)], "t string").select(
        parse("t").alias("v"))
    ddl = infer_ddl(v, ["v"])
    assert "VARIANT" in ddl["v"]
    for via_json in (False, True):
        rows = apply_ddl(v, ddl, via_json=via_json).collect()
        assert sorted(r.v["c"]["VOID"] for r in rows) == [1, 2]
    assert without_void("STRUCT<VOID: VOID, `a: VOID`: ARRAY<VOID>, x: STRUCT<y: VOID>>") == \
        "STRUCT<VOID: VARIANT, `a: VOID`: ARRAY<VARIANT>, x: STRUCT<y: VARIANT>>"


def test_materialised_hops_follow_their_input(spark, tmp):
    import os

    import __spark_entry__ as se
    sf = os.path.join(tmp, "sf")
    for t in ("orders", "lineitem", "customer", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(40).write.parquet(f"{sf}/{t}.parquet")
    count = lambda: {r.resourceType: r.cnt for r in se.queries()["resource_counts"](spark, sf).collect()}["Order"]
    assert count() == 40
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(10).write.mode("overwrite").parquet(f"{sf}/orders.parquet")
    assert count() == 10
