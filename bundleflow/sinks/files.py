"""File copies and one-file-per-record text output.

Copies run inside executors (``mapInPandas`` over a file manifest) through
``pyarrow.fs``, which speaks local, HDFS and object-store URIs; nothing about
the files passes through the driver except the final count.  A copy overwrites
its target, so a retried task is harmless.
"""

from __future__ import annotations

import posixpath
import time

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

COPY_SCHEMA = "src string, dst string, status map<string,string>"
ATTEMPTS = 3
# Schemes of Spark paths and the names pyarrow has for them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "wasbs": "abfss"}


def file_system(path: str, resolve=None):
    """(file system, path within it) of a Spark path.  Only scheme and host are parsed as a URI;
    the rest is taken as it is, so names may hold spaces or percent signs.  ``resolve`` turns
    scheme and host into (file system, root); pyarrow's own lookup by default."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    scheme, colon, rest = path.partition(":")
    if path.startswith("/") or not colon or "/" in scheme:
        return LocalFileSystem(), path
    if scheme in ("file", "dbfs"):
        local = "/" + rest.lstrip("/")
        return LocalFileSystem(), "/dbfs" + local if scheme == "dbfs" else local
    host, _, tail = rest.removeprefix("//").partition("/")
    fs, root = (resolve or FileSystem.from_uri)(f"{SCHEMES.get(scheme, scheme)}://{host}")
    return fs, f"{root.rstrip('/')}/{tail}"


def copy_one(src: str, dst: str, attempts: int = ATTEMPTS) -> dict[str, str]:
    """Copy a file (overwrite), try again after a failure, and report ``{status, message}``
    instead of raising."""
    for left in reversed(range(attempts)):
        try:
            sfs, spath = file_system(src)
            dfs, dpath = file_system(dst)
            dfs.create_dir(posixpath.dirname(dpath), recursive=True)
            if type(sfs) is type(dfs):
                dfs.copy_file(spath, dpath)
            else:
                with sfs.open_input_stream(spath) as i, dfs.open_output_stream(dpath) as o:
                    while chunk := i.read(1 << 20):
                        o.write(chunk)
            return {"status": "success", "message": f"copied to {dst}"}
        except Exception as e:  # noqa: BLE001 - reported per file, like the reference's status map
            if not left:
                return {"status": "error", "message": f"{type(e).__name__}: {e}"}
            time.sleep(0.1)
    return {"status": "error", "message": "no attempt"}


def _plain(path: str | Column):
    """A path with one slash behind its scheme: ``file:///x`` and ``file:/x`` become the same."""
    if isinstance(path, str):
        scheme, colon, rest = path.partition(":")
        return f"{scheme}:/{rest.lstrip('/')}" if colon and "/" not in scheme else path
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def relative_path(spark, folder: str, path: Column) -> Column:
    """``path`` below ``folder``: the resolved folder's own prefix is cut off, nothing is searched."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return F.substr(_plain(path), F.lit(len(_plain(root).rstrip("/")) + 2))


@F.pandas_udf(MapType(StringType(), StringType()))
def copy_status(src: pd.Series, dst: pd.Series) -> pd.Series:
    """Copies row by row; only the two paths travel to Python, the row's other columns do not."""
    return pd.Series([copy_one(s, d) for s, d in zip(src, dst)])


def copy_manifest(manifest: DataFrame, src_col: str, dst_col: str) -> DataFrame:
    """Copy every (src, dst) pair of a manifest; one status row per file."""
    def run(batches):
        for pdf in batches:
            out = pd.DataFrame({"src": pdf[src_col].values, "dst": pdf[dst_col].values})
            out["status"] = [copy_one(s, d) for s, d in zip(out["src"], out["dst"])]
            yield out
    return manifest.select(src_col, dst_col).mapInPandas(run, COPY_SCHEMA)


def copy_files(spark, src_dir: str, dst_dir: str, glob: str | list[str] = "*") -> DataFrame:
    """Copy files whose name fits one of the patterns from ``src_dir`` into ``dst_dir``,
    keeping their path below it; returns status rows.

    The listing uses the binaryFile source with only path metadata selected, so
    file contents are not read by Spark.
    """
    patterns = glob if isinstance(glob, str) else "{" + ",".join(glob) + "}"
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", patterns)
               .option("recursiveFileLookup", True).load(src_dir).select("path"))
    manifest = listing.select(
        F.col("path").alias("src"),
        F.concat(F.lit(dst_dir.rstrip("/") + "/"), relative_path(spark, src_dir, F.col("path"))).alias("dst"))
    return copy_manifest(manifest, "src", "dst")


def write_one_file_per_row(df: DataFrame, key_col: str, value_col: str, path: str, suffix: str = "") -> int:
    """D14 and landing generation: each row's text as its own file ``<path>/<key><suffix>``.

    Files are written by the executors holding the rows (``mapInPandas`` through
    ``pyarrow.fs``), with the exact text and no extra newline; the driver only
    receives the file count.  Keys must be unique; rewriting a file overwrites it.
    """
    base = path.rstrip("/")

    def run(batches):
        fs = root = None
        for pdf in batches:
            if fs is None:
                fs, root = file_system(base)
                fs.create_dir(root, recursive=True)
            for k, v in zip(pdf[key_col], pdf[value_col]):
                with fs.open_output_stream(f"{root}/{k}{suffix}") as o:
                    o.write((v or "").encode("utf-8"))
            yield pd.DataFrame({"n": [len(pdf)]})

    out = df.select(key_col, value_col).mapInPandas(run, "n long").agg(F.sum("n")).first()[0]
    return int(out or 0)


def delete_one(path: str) -> dict[str, str]:
    try:
        fs, p = file_system(path)
        fs.delete_file(p)
        return {"status": "success", "message": f"deleted {path}"}
    except Exception as e:  # noqa: BLE001
        return {"status": "error", "message": f"{type(e).__name__}: {e}"}


ARCHIVE_SCHEMA = "src string, dst string, copied map<string,string>, removed map<string,string>"


def archive_older_than(spark, src_dir: str, archive_dir: str, older_than, glob: str = "*") -> DataFrame:
    """S3 retention: move files last modified before ``older_than`` under ``archive_dir``,
    keeping their path relative to ``src_dir``.  Copy first, delete the source only when
    the copy succeeded; one status row per file, produced by the executors."""
    base = src_dir.rstrip("/")
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
               .load(base).where(F.col("modificationTime") < F.lit(older_than)).select("path"))
    rel = relative_path(spark, base, F.col("path"))
    manifest = listing.select(F.col("path").alias("src"),
                              F.concat(F.lit(archive_dir.rstrip("/") + "/"), rel).alias("dst"))

    def run(batches):
        for pdf in batches:
            copied = [copy_one(s, d) for s, d in zip(pdf["src"], pdf["dst"])]
            removed = [delete_one(s) if c["status"] == "success" else {"status": "skipped", "message": "copy failed"}
                       for s, c in zip(pdf["src"], copied)]
            yield pd.DataFrame({"src": pdf["src"].values, "dst": pdf["dst"].values,
                                "copied": copied, "removed": removed})

    return manifest.mapInPandas(run, ARCHIVE_SCHEMA)
