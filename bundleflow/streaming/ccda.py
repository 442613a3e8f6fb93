"""C25/S2/S3/ST9: document ingest with a copy (stage-out) status per file.

Stream of whole text files -> ``foreachBatch``: each row's file is copied to the staging folder
(below it at the same relative path as below the landing folder) by the executor that holds the
row, which adds the ``{status, message}`` map; the batch is written to
``documents_bronze/batch_id=<n>`` (overwrite: replay-safe), the paths of its failed copies to
``documents_failed/batch_id=<n>``.  A scan deals small files out some thirty at a time; such shares
are joined to a few per core, so a landing of many small files gives neither a task nor a stored file
for every thirty of them.  Failed copies are tried again at the start of the next run, which reads
that small table alone; their new status replaces the stored one on reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path
from ..sinks.files import copy_status, relative_path
from ..sinks.store import list_dirs, path_exists
from .hops import Layout, landed_texts, refresh
from .landing import TASKS_PER_CORE


def _decoded(path: Column) -> Column:
    """File metadata holds percent-encoded paths; a plus sign stands for itself in them."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def stage_documents(spark: SparkSession, landing: str, stage_dir: str, root: str, glob: str = "*.xml",
                    max_files_per_trigger: int | None = None, clean_source: str = "off",
                    archive_dir: str | None = None, cluster_by: str | None = "file_metadata.file_path") -> Layout:
    layout = Layout(root)
    retry_failed(spark, layout)
    stream = landed_texts(spark, landing, glob, layout, "documents_bronze", max_files_per_trigger,
                          clean_source, archive_dir)
    out = layout.table("documents_bronze")

    def write(batch: DataFrame, batch_id: int) -> None:
        path = _decoded(F.col("file_metadata.file_path"))
        rows = batch.select(
            "file_metadata", F.current_timestamp().alias("ingest_time"), "value", path.alias("source_path"),
            F.concat(F.lit(stage_dir.rstrip("/") + "/"), relative_path(spark, landing, path)).alias("stage_path"))
        if not max_files_per_trigger:  # no shuffle: a task reads several of the scan's shares
            rows = rows.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        if cluster_by:  # D2: sorted where the rows lie, so no text is read twice or shuffled
            rows = rows.sortWithinPartitions(cluster_by)
        copied = copy_status.asNondeterministic()("source_path", "stage_path")
        folder = f"batch_id={batch_id:09d}"
        rows.withColumn("copy_status", copied).write.mode("overwrite").parquet(join_path(out, folder))
        failed = spark.read.parquet(join_path(out, folder)).where(F.col("copy_status")["status"] == "error")
        failed.select("source_path", "stage_path").write.mode("overwrite").parquet(
            join_path(layout.table("documents_failed"), folder))

    refresh(stream, "documents_bronze", layout, foreach_batch=write)
    return layout


def _last_retries(spark: SparkSession, layout: Layout) -> DataFrame | None:
    retries = layout.table("documents_retries")
    if not path_exists(spark, retries):
        return None
    return spark.read.parquet(retries).groupBy("source_path").agg(
        F.max_by("retry_status", "retry_time").alias("retry_status"))


def retry_failed(spark: SparkSession, layout: Layout) -> int:
    """Copies again what failed and was not mended since; returns the number of files."""
    if not list_dirs(spark, layout.table("documents_failed")):
        return 0
    failed = spark.read.parquet(layout.table("documents_failed")).select("source_path", "stage_path").distinct()
    last = _last_retries(spark, layout)
    if last is not None:
        mended = last.where(F.col("retry_status")["status"] != "error").select("source_path")
        failed = failed.join(mended, "source_path", "left_anti")
    if failed.isEmpty():
        return 0
    again = failed.withColumn("retry_status", copy_status.asNondeterministic()("source_path", "stage_path"))
    out = join_path(layout.table("documents_retries"), f"run={uuid.uuid4().hex}")
    again.withColumn("retry_time", F.current_timestamp()).write.parquet(out)
    return spark.read.parquet(out).count()


def read_documents(spark: SparkSession, layout: Layout) -> DataFrame:
    """The documents with the newest status of their copy."""
    docs = spark.read.parquet(layout.table("documents_bronze")).drop("batch_id")
    last = _last_retries(spark, layout)
    if last is None:
        return docs
    return (docs.join(last, "source_path", "left")
            .withColumn("copy_status", F.coalesce("retry_status", "copy_status"))
            .select(*docs.columns))
