"""Golden facts on the reference's sample prior-authorization bundle (read as data)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bundleflow.functions.variant import get
from bundleflow.plans import bronze, bundles, resources
from bundle_rows import bronze_rows


@pytest.fixture(scope="module")
def vb(spark, fixture_text):
    return bronze.variant_bronze(bronze_rows(spark, [fixture_text])).persist()


def test_entries_and_types(vb):
    ent = resources.entries(vb)
    assert ent.count() == 8
    counts = {r.resourceType: r["count"] for r in ent.groupBy("resourceType").count().collect()}
    assert counts == {"Claim": 1, "Patient": 1, "Practitioner": 1, "Organization": 2, "Coverage": 1,
                      "RelatedPerson": 1, "ServiceRequest": 1}


def test_long_table_and_registry(vb):
    long_df = resources.resources_long(resources.entries(vb))
    assert long_df.count() == 70
    assert long_df.select("key").distinct().count() == 34
    reg = resources.resource_schemas(long_df)
    assert reg.count() == 63
    got = {(r.resourceType, r.column_name): r.schema_of_variant for r in reg.collect()}
    assert got[("Claim", "insurer")] == "OBJECT<reference: STRING>"
    assert got[("Coverage", "payor")] == "ARRAY<OBJECT<reference: STRING>>"
    assert got[("Organization", "active")] == "BOOLEAN"


def test_header_and_meta(vb):
    h = bundles.bundle_header(vb).first()
    assert (h.bundle_resourceType, h.bundle_type, h.bundle_id) == ("Bundle", "collection", "002028080")
    m = resources.bundle_meta(vb).select(get("meta", "$.EventType", "string").alias("e")).first()
    assert m.e is None


def test_claim_review_paths(spark, vb):
    types = ["Claim", "Patient", "Practitioner", "Organization", "Coverage", "RelatedPerson", "ServiceRequest"]
    arr = bundles.resource_arrays(vb, types)
    grouped = bundles.resource_arrays_grouped(resources.entries(vb), types)
    assert ([r.asDict() for r in arr.select(*[F.to_json(t).alias(t) for t in types]).collect()]
            == [r.asDict() for r in grouped.select(*[F.to_json(t).alias(t) for t in types]).collect()])
    r = spark.sql("""
        SELECT Claim:[0].resource.id::string AS claim_id
              ,Claim:[0].resource.created::timestamp AS created
              ,Claim:[0].resource.diagnosis[2].diagnosisCodeableConcept.coding[0].code::string AS diag_3
              ,Organization:[1].resource.name::string AS org_2
              ,Patient:[0].resource.birthDate::date AS birth
              ,Patient:[0].resource.gender::string AS gender
        FROM {arr}""", arr=bundles.array_heads(arr, types, 3)).first()
    assert r.claim_id == "e95745e2-1e43-4b18-aef8-22f243a9494d"
    assert r.created == dt.datetime(2025, 1, 24, 12, 2, 13, 985000)
    assert r.diag_3 == "M23.201"
    assert r.org_2 == "Payer Company 1"
    assert r.birth == dt.date(1992, 3, 14) and r.gender == "male"


def test_silver_patient(spark, vb):
    from bundleflow.plans.silver import silver_table
    ent = resources.entries(vb)
    keys = sorted(r.key for r in resources.resources_long(ent).where(F.col("resourceType") == "Patient")
                  .select("key").distinct().collect())
    s = silver_table(ent, "Patient", keys)
    assert s.columns[:3] == ["patient_uuid", "bundle_uuid", "patient_url"]
    row = s.select(get("gender", "$", "string").alias("g")).first()
    assert s.count() == 1 and row.g == "male"


def test_fixture_through_streaming_pipeline(spark, fixture_text, tmp):
    import os
    from bundleflow.streaming.hops import latest_schemas, read_silver, run
    land = os.path.join(tmp, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "prior_auth.json"), "w", encoding="utf-8") as f:
        f.write(fixture_text)
    layout = run(spark, land, os.path.join(tmp, "root"))
    assert latest_schemas(spark, layout).count() == 63
    org = read_silver(spark, layout, "Organization")
    assert org.count() == 2 and org.columns[:3] == ["organization_uuid", "bundle_uuid", "organization_url"]
    claim = read_silver(spark, layout, "Claim")
    assert len(claim.columns) == 3 + 19
    assert claim.select(get("use", "$", "string").alias("u")).first().u is not None
