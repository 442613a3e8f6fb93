"""Materialised tables under the shared work folder.

A hop is written once per input folder, input state and code version and then read back, so
later queries start from Parquet instead of recomputing lineage.  Presence of
``_SUCCESS`` marks a complete write; a partial write is simply overwritten.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import INPUT_STATES, join_path, work_dir

STORE_VERSION = "v3"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop file system of the path (any scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


_CODE_HASH: list[str] = []


def code_version() -> str:
    """Hash of the package source: stored hops are keyed by it, so a cache written by
    other code is never read back."""
    if not _CODE_HASH:
        import os
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        h = hashlib.sha1(STORE_VERSION.encode())
        for base, _dirs, files in sorted(os.walk(root)):
            if os.path.relpath(base, root).split(os.sep)[0] == "llm":  # stores nothing here
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(base, f), "rb") as fh:
                        h.update(f.encode() + fh.read())
        _CODE_HASH.append(h.hexdigest()[:12])
    return _CODE_HASH[0]


def input_state(spark: SparkSession, folder: str) -> str:
    """Digest of name, length and modification time of every file below ``folder``, so that a
    hop stored for other data is never read back.  The folder is listed once a query."""
    if folder in INPUT_STATES:
        return INPUT_STATES[folder]
    fs, p = _fs(spark, folder)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}")
    INPUT_STATES[folder] = hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()[:16]
    return INPUT_STATES[folder]


def dataset_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored hops of one input folder, in its present state, and code version."""
    digest = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return join_path(work_dir(spark), "bundleflow", code_version(), digest, input_state(spark, sf_dir))


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write ``build()`` to ``path`` unless a complete copy exists; return a scan of it.

    The write goes to a fresh sibling folder that is renamed into place, so a
    reader never sees a half-written table and two writers racing on the same
    path leave exactly one complete copy.  Hops are packed with zstd: their documents repeat the
    same names in every row.
    """
    if not path_exists(spark, join_path(path, "_SUCCESS")):
        tmp = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
        w = build().write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(tmp)
        fs, src = _fs(spark, tmp)
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        dst = jpath(path)
        if fs.exists(jpath(join_path(path, "_SUCCESS"))):
            fs.delete(src, True)  # another writer finished first; keep its copy
        else:
            if fs.exists(dst):
                fs.delete(dst, True)  # leftover of an interrupted write
            # rename onto an existing folder would nest it, hence the checks above
            if not fs.rename(src, dst):
                fs.delete(src, True)
    return spark.read.parquet(path)


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column comments as field metadata (kept in the Parquet footer's Spark schema)."""
    for c, text in comments.items():
        if c in df.columns:
            df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE ... AS SELECT`` as an overwrite of a Parquet folder."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW`` over a parametrised DataFrame (session-scoped)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


TABLE_INFO = "_table.json"


def write_table_info(spark: SparkSession, path: str, comment: str | None = None,
                     properties: dict[str, str] | None = None) -> None:
    """Table comment and properties (``TBLPROPERTIES``) as a sidecar file in the table
    folder; names starting with ``_`` are ignored by Parquet readers."""
    import json
    fs, p = _fs(spark, join_path(path, TABLE_INFO))
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps({"comment": comment, "properties": properties or {}},
                                       sort_keys=True).encode("utf-8")))
    finally:
        out.close()


def read_table_info(spark: SparkSession, path: str) -> dict:
    import json
    fs, p = _fs(spark, join_path(path, TABLE_INFO))
    if not fs.exists(p):
        return {"comment": None, "properties": {}}
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(data).decode("utf-8"))


def write_table(df: DataFrame, path: str, schema=None, comment: str | None = None,
                properties: dict[str, str] | None = None, cluster_by: list[str] | None = None,
                partition_by: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """A declared table.  ``schema`` (a StructType whose fields may carry comments)
    fixes column order, types and comments; ``cluster_by`` deals and sorts
    the rows so that files cluster on every one of those columns (``sinks.cluster``); comment/properties go to the table info file."""
    from pyspark.sql import functions as F

    from .cluster import clustered
    if schema is not None:
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        df = with_comments(df, {f.name: f.metadata["comment"] for f in schema.fields if "comment" in f.metadata})
    if cluster_by:
        df = clustered(df, cluster_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    write_table_info(df.sparkSession, path, comment, properties)
    return df.sparkSession.read.parquet(path)
