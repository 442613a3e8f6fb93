"""Directory listings, inventories and config-driven ingest definitions.

Folders are listed by executors, one level of them after the other, and the listing is stored, so
that a landing of any number of files passes the driver as a path and not as a list.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path, work_dir
from ..sinks.files import file_system

LISTING = "path string, name string, length long, modificationTime timestamp, folder boolean"
# Rows that a listing task hands over at a time.
LISTED_ROWS = 10_000


def _children(folder: str) -> Iterator[tuple[str, int, int, bool]]:
    """(name, length, milliseconds of the last change, is a folder) of what lies in ``folder``; a local
    folder is read entry by entry."""
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem
    fs, root = file_system(folder)
    if not isinstance(fs, LocalFileSystem):
        for i in fs.get_file_info(FileSelector(root)):
            yield i.base_name, i.size or 0, (i.mtime_ns or 0) // 1_000_000, i.type == FileType.Directory
        return
    with os.scandir(root) as found:
        for e in found:
            try:
                s = e.stat()
            except FileNotFoundError:  # gone since, or a link to nothing
                continue
            yield e.name, s.st_size, s.st_mtime_ns // 1_000_000, e.is_dir()


def _hidden(name: str) -> bool:
    """What Spark's readers pass over as well."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        path, name, length, millis, folder = zip(*rows)
        times = pa.array([m * 1000 for m in millis], pa.timestamp("us", tz="UTC"))
        return pa.RecordBatch.from_arrays(
            [pa.array(path), pa.array(name), pa.array(length, pa.int64()), times, pa.array(folder)],
            names=["path", "name", "length", "modificationTime", "folder"])

    for b in batches:
        for parent in b.column(0).to_pylist():
            rows = []
            for name, *rest in _children(parent):
                if not _hidden(name):
                    rows.append((f"{parent.rstrip('/')}/{name}", name, *rest))
                if len(rows) == LISTED_ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """``LIST path`` as a DataFrame (path, name, length, modificationTime); contents are not read.

    A snapshot: each level of folders is listed by one job, a task a folder at most, into a stored table.
    Empty files are left out, as Spark's readers leave them out.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    roots = p.getFileSystem(conf).globStatus(p)
    if not roots:
        raise FileNotFoundError(path)
    listing = join_path(work_dir(spark), "bundleflow", "listings", uuid.uuid4().hex)
    rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime(), s.isDirectory()) for s in roots]
    spark.createDataFrame(rows, LISTING.replace("timestamp", "long")).withColumn(
        "modificationTime", F.timestamp_millis("modificationTime")).coalesce(1).write.parquet(join_path(listing, "level=0"))
    for level in range(1, 1 << 30):
        folders = spark.read.schema(LISTING).parquet(join_path(listing, f"level={level - 1}")).where("folder").select("path")
        if (level > 1 and not recursive) or folders.isEmpty():
            break
        folders.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(_list_folders, LISTING).write.parquet(
            join_path(listing, f"level={level}"))
    found = spark.read.schema(LISTING).parquet(listing).where(~F.col("folder") & (F.col("length") > 0))
    if glob:  # Hadoop's own reading of the pattern, as a regular expression
        pattern = jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().toString()
        found = found.where(F.col("name").rlike(f"(?s)^(?:{pattern})$"))
    return found.select("path", "name", "length", "modificationTime")


def inventory(listing: DataFrame) -> DataFrame:
    """File count, total size and newest file in one aggregate."""
    return listing.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("total_bytes"),
        F.max_by("name", F.struct("modificationTime", "name")).alias("newest_file"),
        F.max("modificationTime").alias("newest_time"),
    )


def newest(listing: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` files (top-k, planned as TakeOrderedAndProject)."""
    return listing.orderBy(F.desc("modificationTime"), "name").limit(n)


def ingest_definitions(spark: SparkSession, config_dir: str) -> list[dict]:
    """JSON ingest definitions (multi-line files), collected: one row per definition."""
    df = spark.read.option("multiLine", True).json(config_dir)
    return [r.asDict(recursive=True) for r in df.collect()]
