"""Listings are made by executors: the driver's plan holds paths of tables, not of landed files."""

import os

import pytest

from bundleflow.sources.files import inventory, list_files, newest


def _landing(tmp, n=60):
    for i in range(n):
        folder = os.path.join(tmp, "in", f"d {i % 3}" if i % 2 else "")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{i}.txt"), "w", encoding="utf-8") as f:
            f.write("é" * (i + 1))
    for hidden in ("_h/x.txt", ".h.txt", "empty.txt"):
        os.makedirs(os.path.dirname(os.path.join(tmp, "in", hidden)), exist_ok=True)
        with open(os.path.join(tmp, "in", hidden), "w") as f:
            f.write("" if hidden == "empty.txt" else "x")
    return os.path.join(tmp, "in")


def test_the_driver_holds_no_list_of_landed_files(spark, tmp):
    land = _landing(tmp)
    files = list_files(spark, land, "*.txt")
    assert files.count() == 60
    # the plan names the stored listing: one file a folder and level at most, however many files landed
    assert not [f for f in files.inputFiles() if f.endswith(".txt")] and len(files.inputFiles()) < 20


def test_listing_equals_that_of_sparks_reader(spark, tmp):
    land = _landing(tmp)
    for glob in ("*.txt", "{1,2}?.t[a-x]t", "[!1-4].txt"):
        own = list_files(spark, land, glob)
        theirs = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
                  .load(land).select("path", "length", "modificationTime"))
        assert sorted(own.select("path", "length", "modificationTime").collect()) == sorted(theirs.collect()) != []
    assert {os.path.dirname(r.path) for r in list_files(spark, land, recursive=False).collect()} == {f"file:{land}"}
    total = inventory(list_files(spark, land)).first()
    assert total.n_files == 60 and total.total_bytes == sum(2 * (i + 1) for i in range(60))
    assert newest(list_files(spark, land), 3).count() == 3
    with pytest.raises(FileNotFoundError):
        list_files(spark, os.path.join(tmp, "none"))


def _texts(spark, layout):
    return sorted((r.value, *r.file_metadata[:5]) for r in spark.read.parquet(layout.table("bronze")).collect())


def test_a_hop_follows_the_log_of_landed_files(spark, tmp):
    from bundleflow.streaming.hops import Layout, bronze_hop
    from bundleflow.streaming.landing import log_path
    land = os.path.join(tmp, "in here")
    os.makedirs(os.path.join(land, "b+c"))
    names = ["a.json", "b+c/ä #1%20.json", "no.txt"]
    for n in names:
        with open(os.path.join(land, n), "wb") as f:
            f.write("{} é".encode() + b"\xff")  # not all texts are UTF-8
    layout = Layout(os.path.join(tmp, "root"))
    bronze_hop(spark, land, layout)
    theirs = (spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(land)
              .selectExpr("_metadata.file_path", "_metadata.file_name", "_metadata.file_size", "_metadata.file_block_start",
                          "_metadata.file_block_length", "_metadata.file_modification_time", "hex(value) AS value"))
    ours = spark.read.parquet(layout.table("bronze")).selectExpr("file_metadata.*", "hex(value) AS value")
    assert sorted(ours.collect()) == sorted(theirs.collect()) and ours.count() == 2
    # the log, not the landing, is what the stream lists on the driver
    assert os.path.isdir(log_path(layout.checkpoint("bronze")))
    with open(os.path.join(land, "late.json"), "w") as f:
        f.write("{}")
    for _ in range(2):  # what landed since comes once; a run without news adds nothing
        bronze_hop(spark, land, layout)
        assert spark.read.parquet(layout.table("bronze")).count() == 3


def test_the_log_is_cut_into_batches(spark, tmp, monkeypatch):
    from bundleflow.streaming import hops
    land = _landing(tmp)
    whole, cut = hops.Layout(os.path.join(tmp, "whole")), hops.Layout(os.path.join(tmp, "cut"))
    hops.bronze_hop(spark, land, whole, glob="*.txt")
    monkeypatch.setattr(hops, "MAX_BYTES", 1000)
    hops.bronze_hop(spark, land, cut, glob="*.txt")
    assert _texts(spark, whole) == _texts(spark, cut) and len(_texts(spark, cut)) == 60
    commits = lambda layout: len([c for c in os.listdir(os.path.join(layout.checkpoint("bronze"), "commits")) if c.isdigit()])
    assert commits(whole) == 1 and commits(cut) == 4  # 3,660 bytes


def test_cleaning_a_logged_source_is_refused(spark, tmp):
    from bundleflow.streaming.ccda import stage_documents
    land = _landing(tmp)
    stage_documents(spark, land, f"{tmp}/staged", f"{tmp}/root", glob="*.txt")
    with pytest.raises(ValueError, match="cleans up nothing"):
        stage_documents(spark, land, f"{tmp}/staged", f"{tmp}/root", glob="*.txt", clean_source="delete")
    # bounds in files are kept to by a hop that goes by its log
    with open(os.path.join(land, "later.txt"), "w") as f:
        f.write("x")
    stage_documents(spark, land, f"{tmp}/staged", f"{tmp}/root", glob="*.txt", max_files_per_trigger=1)
    assert spark.read.parquet(f"{tmp}/root/tables/documents_bronze").count() == 61


def test_a_bundle_hop_reads_many_small_files_in_few_tasks(spark, tmp):
    """Spark's text source would deal these out one a task, and store a file for each."""
    from bundleflow.streaming.hops import Layout, bronze_hop
    from bundleflow.streaming.landing import TASKS_PER_CORE
    land, layout = _landing(tmp), Layout(os.path.join(tmp, "root"))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    try:
        bronze_hop(spark, land, layout, glob="*.txt")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    stored = spark.read.parquet(layout.table("bronze"))
    assert stored.count() == 60 and len(stored.inputFiles()) <= TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 60
