"""Bundles of several resources, mapping positions, and descriptions of any number of codes."""

import json

import pytest
from pyspark.sql import functions as F

from bundleflow.plans.enrich import describe_positions
from bundleflow.plans.writeback import Linked, Mapping, linked_bundle, nest, refer


def test_positions_in_paths(spark):
    df = spark.createDataFrame([("1", "x", None), ("2", None, 'q"uote')], "a string, b string, c string")
    m = [Mapping("a", "Patient.identifier[0].value"), Mapping("b", "Patient.identifier[1].value"),
         Mapping(None, "Patient.identifier[1].system", "s"), Mapping("c", "Patient.name.given[0]"), Mapping("a", "Patient.name.given[1]")]
    rows = [json.loads(r.j) for r in df.select(F.to_json(nest(m)).alias("j")).collect()]
    assert rows[0]["identifier"] == [{"value": "1"}, {"value": "x", "system": "s"}] and rows[0]["resourceType"] == "Patient"
    assert rows[1]["name"] == [{"given": ['q"uote', "2"]}]
    for bad in (["x[1].v"], ["x[0].v", "x.w"], ["x[0]", "x[0]"], ["x[-1].v"]):
        with pytest.raises(ValueError):
            nest([Mapping("a", p) for p in bad])


def test_linked_entries(spark):
    df = spark.createDataFrame([("p1", "c1"), ("p1", "c2")], "p string, c string")
    text = linked_bundle([Linked("Coverage", F.col("c"), [Mapping("c", "id"), Mapping(refer("Patient"), "beneficiary.reference")]),
                          Linked("Patient", F.col("p"), [Mapping("p", "id")])])
    found = [json.loads(r.t) for r in df.select(text.alias("t")).collect()]
    for b in found:
        entry = {e["resource"]["resourceType"]: e for e in b["entry"]}
        assert entry["Coverage"]["resource"]["beneficiary"]["reference"] == entry["Patient"]["fullUrl"]
        assert entry["Patient"]["fullUrl"].startswith("urn:uuid:") and len(entry["Patient"]["fullUrl"]) == 45
    assert found[0]["entry"][1]["fullUrl"] == found[1]["entry"][1]["fullUrl"] != found[0]["entry"][0]["fullUrl"]
    with pytest.raises(ValueError):
        linked_bundle([Linked("A", F.col("c"), []), Linked("A", F.col("p"), [])])


def test_descriptions_keep_order_and_gaps(spark):
    df = spark.createDataFrame([(1, ["b", "a", None, "zz", "a"], ["a"]), (2, [], None), (3, None, ["b", "b"])],
                               "id int, x array<string>, y array<string>")
    lookup = spark.createDataFrame([("u", "a", "A"), ("u", "b", "B"), ("v", "a", "other")], "kind string, code string, description string")
    rows = {r.id: r for r in describe_positions(df, ["id"], {"u": "x", "v": "y"}, lookup).collect()}
    assert [tuple(c) for c in rows[1].u] == [("b", "B"), ("a", "A"), (None, None), ("zz", None), ("a", "A")]
    assert [tuple(c) for c in rows[1].v] == [("a", "other")] and rows[2].u == [] == rows[2].v
    assert rows[3].u == [] and [tuple(c) for c in rows[3].v] == [("b", None), ("b", None)]
