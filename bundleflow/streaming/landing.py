"""S1-S4 for landings of any number of files: a log of the landed files, and a stream that follows it.

Spark's file source lists a landing on the driver, and keeps every file it has seen there, which a
landing of millions of documents outgrows.  Here ``discover`` lists the landing by executors
(``sources.files.list_files``) and appends what the log does not hold yet, oldest first, a log file
for every micro-batch of some ``max_bytes``.  The stream reads the log, a file of it at a time, and
its tasks read the texts; the driver sees the log's few files only.

The log lies in the hop's checkpoint, so both are dropped together, and appears by one rename.  As in
Spark's source a path is read once, also if its file is written anew.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path
from ..sinks.files import file_system
from ..sinks.store import path_exists
from ..sources.files import list_files

LOGGED = "path string, length long, modificationTime timestamp"
READ = "file_path string, file_name string, file_size long, file_modification_time timestamp, value binary"
# Tasks of a batch per core; a batch is bounded by bytes, so is a task.
TASKS_PER_CORE = 4
# What a task hands over at a time: texts of this size together, or this many.
HANDED_BYTES, HANDED_ROWS = 4 << 20, 1000


def log_path(checkpoint: str) -> str:
    return join_path(checkpoint, "landed")


def follows_log(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a hop goes by the log: a new one does; one that began on Spark's file source goes on there."""
    return path_exists(spark, log_path(checkpoint)) or not path_exists(spark, join_path(checkpoint, "offsets"))


def discover(spark: SparkSession, landing: str, glob: str, log: str, max_bytes: int, max_files: int | None = None) -> None:
    """Appends the landed files that the log lacks."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(log).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(log))
    found = list_files(spark, landing, glob).select("path", "length", "modificationTime")
    if fs.listStatus(path(log)):
        found = found.join(spark.read.schema(LOGGED).option("recursiveFileLookup", True).parquet(log), "path", "left_anti")
    total = found.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    if not total.files:
        return
    batches = -(-total.files // max_files) if max_files else -(-total.bytes // max_bytes)
    new = join_path(log, f"_writing-{uuid.uuid4().hex}")
    found.repartitionByRange(batches, "modificationTime", "path").write.parquet(new)
    if not fs.rename(path(new), path(join_path(log, f"run-{uuid.uuid4().hex}"))):
        raise OSError(f"cannot rename {new}")


# What java.net.URI leaves as it is in a path, as Spark's file metadata shows it; other ASCII is escaped.
_ESCAPED = re.compile(r"[^A-Za-z0-9\-_.!~*'():@&=+$,;/\u0080-\U0010ffff]")


def _encoded(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, colon, rest = "", "", path
    return scheme + colon + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", rest)


def _read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        path, name, size, time, text = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(path), pa.array(name), pa.array(size, pa.int64()), pa.array(time, pa.timestamp("us", tz="UTC")),
             pa.array(text, pa.binary())], names=["file_path", "file_name", "file_size", "file_modification_time", "value"])

    for b in batches:
        rows, held = [], 0
        for path, size, time in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.int64()).to_pylist()):
            fs, p = file_system(path)
            with fs.open_input_stream(p) as f:
                text = f.read()
            if rows and held + len(text) > HANDED_BYTES or len(rows) == HANDED_ROWS:
                yield batch(rows)
                rows, held = [], 0
            shown = _encoded(path)
            rows.append((shown, shown.rpartition("/")[2], size, time, text))
            held += len(text)
        if rows:
            yield batch(rows)


def logged_texts(spark: SparkSession, landing: str, glob: str, checkpoint: str, max_bytes: int,
                 max_files: int | None = None) -> DataFrame:
    """The stream of the landing's whole texts, (file_metadata, value) as of Spark's text source; the
    landing is looked at once, when this is called."""
    log = log_path(checkpoint)
    discover(spark, landing, glob, log, max_bytes, max_files)
    rows = (spark.readStream.schema(LOGGED).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(log))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    read = rows.repartition(tasks).mapInArrow(_read_texts, READ)
    meta = F.struct("file_path", "file_name", "file_size", F.lit(0).cast("long").alias("file_block_start"),
                    F.col("file_size").alias("file_block_length"), "file_modification_time")
    return read.select(meta.alias("file_metadata"), F.col("value").cast("string").alias("value"))
