import json
import os

from bundleflow.sinks.store import materialize, replace_table, replace_view, with_comments


def test_replace_table_view_and_comments(spark, tmp):
    p = os.path.join(tmp, "t")
    df = with_comments(spark.createDataFrame([(1, "a")], "k int, v string"), {"k": "the key"})
    replace_table(df, p)
    again = replace_table(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), p)
    assert again.count() == 2  # replaced, not appended
    replace_table(df, p)
    assert spark.read.parquet(p).schema["k"].metadata.get("comment") == "the key"  # comment survives Parquet
    v = replace_view(spark.read.parquet(p), "bf_view")
    assert spark.sql("SELECT count(*) AS n FROM bf_view").first().n == v.count() == 1


def test_materialize_once(spark, tmp):
    p = os.path.join(tmp, "m")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert materialize(spark, p, build).count() == 3
    assert materialize(spark, p, build).count() == 3
    assert len(calls) == 1 and not [d for d in os.listdir(tmp) if ".tmp-" in d]


def test_processing_time_trigger(spark, tmp):
    from bundleflow.streaming.hops import Layout, bronze_hop, refresh, text_files_stream
    from bundleflow.plans import bronze
    land = os.path.join(tmp, "in")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        json.dump({"resourceType": "Bundle"}, f)
    layout = Layout(os.path.join(tmp, "root"))
    q = refresh(bronze.bronze_from_text(text_files_stream(spark, land)), "bronze", layout,
                processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(layout.table("bronze")).count() == 1
    bronze_hop(spark, land, layout)  # availableNow on the same checkpoint: nothing new
    assert spark.read.parquet(layout.table("bronze")).count() == 1


def test_declared_table(spark, tmp):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from bundleflow.sinks.store import read_table_info, write_table
    schema = StructType([StructField("id", StringType(), metadata={"comment": "resource id"}),
                         StructField("n", LongType())])
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, id string")
    out = write_table(df, os.path.join(tmp, "t"), schema=schema, comment="demo", properties={"quality": "bronze"},
                      cluster_by=["id"])
    assert out.columns == ["id", "n"] and out.schema["n"].dataType == LongType()
    assert out.schema["id"].metadata["comment"] == "resource id"
    assert read_table_info(spark, os.path.join(tmp, "t")) == {"comment": "demo", "properties": {"quality": "bronze"}}


def test_pipeline_tables_carry_quality(spark, tmp):
    from bundleflow.sinks.store import read_table_info
    from bundleflow.streaming.hops import run
    land = os.path.join(tmp, "in")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        json.dump({"resourceType": "Bundle", "entry": [{"fullUrl": "P/1", "resource": {"resourceType": "P"}}]}, f)
    layout = run(spark, land, os.path.join(tmp, "root"))
    assert read_table_info(spark, layout.table("bronze"))["properties"] == {"quality": "bronze"}
    assert read_table_info(spark, layout.silver("P"))["properties"] == {"quality": "silver"}
