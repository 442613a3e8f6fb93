"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path, work_dir
from ..sinks.store import delete_path

# A side of a join is broadcast only when its counted rows times their width stay below this.
BROADCAST_BYTES = 8 << 20
# Characters of text that one numpy pass holds at a time.
CHUNK_CHARS = 1 << 20
# Bytes of text whose words are held at a time.
STRETCH = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Written intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

    A table is written once and reread, so a lost executor costs no recomputation of
    what came before it.  ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = join_path(work_dir(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return join_path(self.root, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for n in names:
            delete_path(self.spark, self.path(n))


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its counted size is below ``limit``;
    otherwise as it is, and the join shuffles (AQE splits its hot keys)."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def holdout(id_col: str, mod: int, rest: int) -> Column:
    """True where crc32 of the id as text leaves ``rest`` modulo ``mod`` (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rest, F.lit(False))


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task function: ``make()`` runs once in each task and returns
    the function of one batch, so that tables are built once and caches live for the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
        del fn
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns the memory of a finished task to the system: Python workers are used again by
    later stages, and each would otherwise keep the most that any stage before it needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds what one batch of the reader and one Arrow batch hold, as documents may be long."""
    from ..session import configure
    configure(spark)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "256")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return spark


def text_groups(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` that hold about ``limit`` characters each."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def strings(col: pa.Array) -> list[str]:
    """Python strings of a string column, null as empty."""
    return [t or "" for t in col.to_pylist()]


def number_in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` (narrow rows) with its place 0, 1, 2, ... in ``order`` as ``n``.

    One range sort, position as last key so that equal rows spread over tasks, and an offset
    per partition of it; only one row a partition reaches the driver.
    """
    spark, names = df.sparkSession, df.columns
    placed = df.withColumn("sort position", F.monotonically_increasing_id())
    placed = placed.orderBy(*order, "sort position").checkpoint().select(
        *names, F.spark_partition_id().alias("sort part"), F.monotonically_increasing_id().alias("sort at"))
    parts = placed.groupBy("sort part").agg(F.count("*").alias("rows"), F.min("sort at").alias("low")).collect()
    shift, total = [], 0
    for part, rows, low in sorted(map(tuple, parts)):
        shift.append((part, total - low))
        total += rows
    offsets = spark.createDataFrame(shift, "`sort part` int, `sort shift` long")
    return placed.join(F.broadcast(offsets), "sort part").select(
        *names, (F.col("sort at") + F.col("sort shift")).alias("n"))


_KEPT = re.compile(rb"[0-9a-z\x80-\xff]")
# Lower-cases A-Z, keeps digits and everything beyond ASCII, blanks the rest.
WORD_TABLE = bytes(b if _KEPT.match(bytes([b])) else 32 for b in bytes(range(256)).lower())


def word_stretches(text: str, size: int | None = None) -> Iterator[list[bytes]]:
    """The words of a text (runs of letters, digits and all beyond ASCII, A-Z lower-cased), in
    lists from about ``size`` bytes each; no word is cut."""
    size, raw, at = size or STRETCH, text.encode("utf-8").translate(WORD_TABLE), 0
    while len(raw) - at > size:
        end = raw.rfind(b" ", at + 1, at + size)
        if end < 0:
            end = raw.find(b" ", at + size)
            if end < 0:
                break
        yield raw[at:end].split()
        at = end
    yield raw[at:].split()
