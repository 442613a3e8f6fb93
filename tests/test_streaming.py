import json
import os

from pyspark.sql import functions as F

from bundleflow.streaming.hops import Layout, drop_all, read_silver, run


def _land(dirpath, name, resources):
    os.makedirs(dirpath, exist_ok=True)
    entry = [{"fullUrl": f"{r['resourceType']}/{r['id']}", "resource": r} for r in resources]
    with open(os.path.join(dirpath, name), "w") as f:
        json.dump({"resourceType": "Bundle", "type": "collection", "id": name, "entry": entry}, f)


def _counts(spark, layout):
    return (spark.read.parquet(layout.table("bronze")).count(),
            read_silver(spark, layout, "Patient").count())


def test_incremental_replay_and_drift(spark, tmp):
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1", "gender": "male"}])
    _land(landing, "b.json", [{"resourceType": "Patient", "id": "2", "gender": "female"},
                              {"resourceType": "Claim", "id": "9", "use": "claim"}])
    drift = []
    layout = run(spark, landing, root, max_files_per_trigger=1, drift_log=drift)
    assert _counts(spark, layout) == (2, 2)

    run(spark, landing, root)  # nothing new: nothing added
    assert _counts(spark, layout) == (2, 2)

    _land(landing, "c.json", [{"resourceType": "Patient", "id": "3", "gender": "other", "birthDate": "2000-01-01"}])
    with open(os.path.join(landing, "bad.json"), "w") as f:
        f.write("{not json")
    run(spark, landing, root, drift_log=drift)
    assert _counts(spark, layout) == (4, 3)  # malformed file kept in bronze only
    vb = spark.read.parquet(layout.table("bronze_variant"))
    assert vb.where(F.col("fhir").isNull()).count() == 1
    assert any(t == "Patient" and "birthDate" in keys for _, t, keys in drift)
    s = read_silver(spark, layout, "Patient")
    assert s.columns[:3] == ["patient_uuid", "bundle_uuid", "patient_url"]
    assert s.where(F.col("birthDate").isNotNull()).count() == 1  # older batches widened with NULL

    before = sorted(r.patient_url for r in s.collect())
    run(spark, landing, root, full_refresh=True)
    after = sorted(r.patient_url for r in read_silver(spark, layout, "Patient").collect())
    assert before == after


def test_hash_ids_are_stable_on_rebuild(spark, tmp):
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1"}])
    layout = run(spark, landing, root)
    ids1 = [r.bundle_uuid for r in spark.read.parquet(layout.table("bronze")).collect()]
    drop_all(spark, layout)
    run(spark, landing, root)
    ids2 = [r.bundle_uuid for r in spark.read.parquet(Layout(root).table("bronze")).collect()]
    assert ids1 == ids2


def test_document_staging(spark, tmp):
    from bundleflow.streaming.ccda import read_documents, stage_documents
    landing = os.path.join(tmp, "in")
    os.makedirs(landing)
    for i in range(3):
        with open(os.path.join(landing, f"d{i}.xml"), "w") as f:
            f.write(f"<ClinicalDocument id='{i}'/>")
    layout = stage_documents(spark, landing, os.path.join(tmp, "staged"), os.path.join(tmp, "root"),
                             max_files_per_trigger=2)
    docs = read_documents(spark, layout).collect()
    assert len(docs) == 3 and all(d.copy_status["status"] == "success" for d in docs)
    assert sorted(os.listdir(os.path.join(tmp, "staged"))) == ["d0.xml", "d1.xml", "d2.xml"]


def test_config_driven_ingest(spark, tmp):
    from bundleflow.streaming.ccda import read_documents
    from bundleflow.streaming.configured import run_definitions
    cfg = os.path.join(tmp, "cfg")
    os.makedirs(cfg)
    for name in ("alpha", "beta"):
        land = os.path.join(tmp, name)
        os.makedirs(land)
        for i in range(2):
            with open(os.path.join(land, f"{name}{i}.xml"), "w") as f:
                f.write(f"<doc n='{i}'/>")
        with open(os.path.join(cfg, f"{name}.json"), "w") as f:
            json.dump({"name": name, "landing": land, "glob": "*.xml", "stage_dir": os.path.join(tmp, "st", name),
                       "root": os.path.join(tmp, "out", name), "max_files_per_trigger": 1}, f, indent=2)
    layouts = run_definitions(spark, cfg)
    assert sorted(layouts) == ["alpha", "beta"]
    assert all(read_documents(spark, lay).count() == 2 for lay in layouts.values())


def test_uuid_and_hash_ids(spark):
    from bundleflow.plans import bronze
    df = spark.createDataFrame([("a", "{}"), ("b", "{}")], "k string, value string").select(
        F.struct(F.col("k").alias("file_path"), F.current_timestamp().alias("file_modification_time")
                 ).alias("file_metadata"), "value")
    u = [r.bundle_uuid for r in bronze.bronze_from_text(df, "uuid").collect()]
    assert len(set(u)) == 2 and all(len(x) == 36 for x in u)
    h1 = [r.bundle_uuid for r in bronze.bronze_from_text(df, "hash", F.col("file_metadata.file_path")).collect()]
    h2 = [r.bundle_uuid for r in bronze.bronze_from_text(df, "hash", F.col("file_metadata.file_path")).collect()]
    assert h1 == h2 and len(h1[0]) == 64


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_drift_leaves_the_history_alone(spark, tmp):
    """New keys rewrite no file in a run; a rebuild rewrites only the batches that lack a column."""
    from bundleflow.streaming.hops import rebuild_silver, silver_batches, silver_columns, silver_version
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    silver = os.path.join(root, "tables", "silver", "patient")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1", "gender": "male"}])
    layout = run(spark, landing, root)
    for n, key in (("b", "active"), ("c", "gender")):
        before = _files(silver)
        _land(landing, f"{n}.json", [{"resourceType": "Patient", "id": n, key: "x"}])
        run(spark, landing, root)
        assert before.items() <= _files(silver).items() and silver_version(spark, layout, "Patient") == 0
    assert silver_columns(spark, layout, "Patient")[3:] == ["gender", "id", "resourceType", "active"]
    rows = read_silver(spark, layout, "Patient")
    assert rows.count() == 3 and rows.where("active IS NOT NULL").count() == 1
    before = _files(silver)
    rewritten = rebuild_silver(spark, layout, "Patient")
    assert len(rewritten) == 1 and silver_version(spark, layout, "Patient") == 1
    assert before.items() <= _files(silver).items()  # the folder before stays for open readers
    batches = silver_batches(spark, layout, "Patient")
    assert [p.split("/v=")[1][0] for p in batches.values()] == ["1", "0", "0"]
    assert all("active" in spark.read.parquet(p).columns for p in batches.values())
    assert read_silver(spark, layout, "Patient").count() == 3 and rebuild_silver(spark, layout, "Patient") == []
    _land(landing, "d.json", [{"resourceType": "Patient", "id": "4", "name": "n"}])
    run(spark, landing, root, rebuild_on_drift=True)
    assert read_silver(spark, layout, "Patient").count() == 4
    assert all("name" in spark.read.parquet(p).columns for p in silver_batches(spark, layout, "Patient").values())


def test_replay_after_rebuild_keeps_all_rows(spark, tmp):
    """The last batch's commit is lost after a rebuild: its replay replaces that batch alone."""
    from bundleflow.streaming.hops import rebuild_silver
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    for n, key in (("a", "gender"), ("b", "active")):
        _land(landing, f"{n}.json", [{"resourceType": "Patient", "id": n, key: "x"}])
        layout = run(spark, landing, root)
    rebuild_silver(spark, layout, "Patient")
    commits = os.path.join(root, "checkpoints", "silver", "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    run(spark, landing, root)
    assert sorted(r.patient_url for r in read_silver(spark, layout, "Patient").collect()) == ["Patient/a", "Patient/b"]


def test_one_bad_type_does_not_stop_the_others(spark, tmp):
    import pytest

    from bundleflow.streaming.hops import SilverTypeError, drop_silver
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1", "Id": "2"}, {"resourceType": "Claim", "id": "9"}])
    with pytest.raises(SilverTypeError, match="Patient"):
        run(spark, landing, root)
    layout = Layout(root)
    assert read_silver(spark, layout, "Claim").count() == 1
    assert spark.read.parquet(os.path.join(root, "tables", "silver_failed", "patient")).count() == 1
    assert drop_silver(spark, layout) == ["Claim", "Patient"] and not os.path.exists(layout.silver("Claim"))


def test_several_batches_give_the_tables_of_one(spark, tmp):
    landing = os.path.join(tmp, "landing")
    for n in range(5):
        _land(landing, f"{n}.json", [{"resourceType": "Patient", "id": str(n), f"k{n % 2}": n}, {"resourceType": "Claim", "id": "c"}])
    with open(os.path.join(landing, "bad.json"), "w") as f:
        f.write("{no")
    one, many = (run(spark, landing, os.path.join(tmp, str(k)), max_files_per_trigger=k) for k in (None, 1))
    for t in ("Patient", "Claim"):
        a, b = ({r[f"{t.lower()}_uuid"] for r in read_silver(spark, x, t).collect()} for x in (one, many))
        assert a == b and len(a) == 5
    assert sorted(read_silver(spark, one, "Patient").columns) == sorted(read_silver(spark, many, "Patient").columns)
    assert [r.value for r in spark.read.parquet(many.table("quarantine")).collect()] == ["{no"]


def test_staging_keeps_folders_and_retries(spark, tmp):
    from bundleflow.streaming.ccda import read_documents, stage_documents
    landing, staged, root = (os.path.join(tmp, n) for n in ("in here", "staged", "root"))
    for d in ("a", "b+c", "d e"):
        os.makedirs(os.path.join(landing, d))
        with open(os.path.join(landing, d, "same name.xml"), "w") as f:
            f.write(d)
    os.makedirs(os.path.join(staged, "a", "same name.xml"))  # a folder is in the way of this copy
    layout = stage_documents(spark, landing, staged, root)
    status = lambda: sorted((r.value, r.copy_status["status"]) for r in read_documents(spark, layout).collect())
    assert status() == [("a", "error"), ("b+c", "success"), ("d e", "success")]
    os.rmdir(os.path.join(staged, "a", "same name.xml"))
    stage_documents(spark, landing, staged, root)
    assert status() == [("a", "success"), ("b+c", "success"), ("d e", "success")]
    for d in ("a", "b+c", "d e"):
        with open(os.path.join(staged, d, "same name.xml")) as f:
            assert f.read() == d


def test_archive_keeps_the_path_below_its_root(spark, tmp):
    import datetime as dt

    from bundleflow.sinks.files import archive_older_than
    src = os.path.join(tmp, "landing", "x", "landing")
    os.makedirs(os.path.join(src, "s"))
    with open(os.path.join(src, "s", "o.json"), "w") as f:
        f.write("{}")
    os.utime(os.path.join(src, "s", "o.json"), (1, 1))
    rows = archive_older_than(spark, src, os.path.join(tmp, "arch"), dt.datetime(2000, 1, 1)).collect()
    assert [r.dst for r in rows] == [os.path.join(tmp, "arch", "s", "o.json")]


def test_archive_older_than(spark, tmp):
    import datetime as dt
    import time
    from bundleflow.sinks.files import archive_older_than
    src = os.path.join(tmp, "land")
    os.makedirs(os.path.join(src, "sub"))
    for n in ("old1.json", "sub/old2.json"):
        with open(os.path.join(src, n), "w") as f:
            f.write("{}")
    old = time.time() - 40 * 86400
    for n in ("old1.json", "sub/old2.json"):
        os.utime(os.path.join(src, n), (old, old))
    with open(os.path.join(src, "new.json"), "w") as f:
        f.write("{}")
    cutoff = dt.datetime.now() - dt.timedelta(days=30)
    rows = archive_older_than(spark, src, os.path.join(tmp, "archive"), cutoff).collect()
    assert sorted(r.dst.split("archive/")[1] for r in rows) == ["old1.json", "sub/old2.json"]
    assert all(r.copied["status"] == "success" and r.removed["status"] == "success" for r in rows)
    assert sorted(os.listdir(src)) == ["new.json", "sub"] and os.listdir(os.path.join(src, "sub")) == []


def test_constraints_are_observed_per_batch(spark, tmp):
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1"}, {"resourceType": "Patient", "id": "2"}])
    layout = run(spark, landing, root)
    with open(os.path.join(landing, "b.json"), "w") as f:
        json.dump({"resourceType": "Bundle", "entry": [{"resource": {"id": "x"}}, {"fullUrl": "P/3", "resource": {"resourceType": "P"}}]}, f)
    run(spark, landing, root)
    rows = spark.read.parquet(layout.table("constraint_metrics")).orderBy("batch_id", "check_name").collect()
    assert [(r.check_name, r.rows, r.violations) for r in rows] == [
        ("not_null:fullUrl", 2, 0), ("not_null:resourceType", 2, 0), ("not_null:fullUrl", 2, 1), ("not_null:resourceType", 2, 1)]


def test_documents_above_one_value_in_the_stream(spark, tmp, monkeypatch):
    """A document that does not parse as one value is cut, and only broken text is quarantined."""
    from bundleflow.plans import bronze
    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "root")
    _land(landing, "a.json", [{"resourceType": "Patient", "id": "1"}])
    _land(landing, "big.json", [{"resourceType": "Patient", "id": "2", "text": "large " * 20}])
    with open(os.path.join(landing, "bad.json"), "w") as f:
        f.write('{"entry": [')
    whole = bronze.parse
    monkeypatch.setattr(bronze, "parse", lambda c: F.when(F.length(c) < 180, whole(c)))
    layout = run(spark, landing, root)
    vb = spark.read.parquet(layout.table("bronze_variant"))
    assert vb.where("parts IS NOT NULL").count() == 1 and vb.where("unparsed IS NOT NULL").count() == 1
    assert [r.value for r in spark.read.parquet(layout.table("quarantine")).collect()] == ['{"entry": [']
    assert read_silver(spark, layout, "Patient").count() == 2
    assert spark.read.parquet(layout.table("bundle_meta")).where("bundle_resourceType = 'Bundle'").count() == 2


def test_many_small_documents_give_few_stored_files(spark, tmp):
    """The scan deals small files out a few at a time; a batch stores a few files per core only."""
    import os

    from bundleflow.streaming import ccda
    os.makedirs(f"{tmp}/landing")
    for i in range(100):
        with open(f"{tmp}/landing/{i}.txt", "w", encoding="utf-8") as f:
            f.write(f"text {i}")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    try:
        layout = ccda.stage_documents(spark, f"{tmp}/landing", f"{tmp}/staged", f"{tmp}/out", glob="*.txt")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    stored = spark.read.parquet(layout.table("documents_bronze"))
    assert {r.value for r in stored.collect()} == {f"text {i}" for i in range(100)}
    assert len(stored.inputFiles()) <= ccda.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 50
    assert len(os.listdir(f"{tmp}/staged")) == 100
