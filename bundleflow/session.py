"""Session construction and the shared work folder.

All intermediate tables are written below the folder the cluster names in
``spark.checkpoint.dir``.  A private folder is only chosen when that setting is
unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps (bundle times carry zones),
# adaptive execution with skew-join splitting, no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bundle tables hold whole documents per row; 4096-row reader batches would need
    # gigabytes per task.  Set for sessions built here only, never on a caller's session.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}


def build_session(
    master: str | None = None,
    app_name: str = "bundleflow",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


# State of the input folders that the present query has looked at (``sinks.store.input_state``).
INPUT_STATES: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (driver-made ones too); called at the
    start of every query, so input folders are looked at once a query."""
    INPUT_STATES.clear()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A micro-batch of many small files is listed by a distributed job with one
    # task per path up to 10,000; size that job to the cluster instead.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(max(8, spark.sparkContext.defaultParallelism)))
    # A write partitioned by few values keeps a writer open for each, instead of sorting (and at
    # size spilling) whole tasks of documents; beyond this number Spark sorts as before.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    # Stored documents stay whole values: dealing their paths out to columns costs more than half of
    # a hop's time, for writing and for putting them together again.
    spark.conf.set("spark.sql.variant.inferShreddingSchema", "false")
    work_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``bundleflow`` importable in executor Python workers (``--py-files`` equivalent).

    Arrow-batched functions (``mapInPandas``) are pickled by module reference,
    so executors need the package.  A zip is written once per application into
    the shared work folder and registered with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = join_path(work_dir(spark), "bundleflow", "pyfiles", app, "bundleflow.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised hops and checkpoints: ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a stable folder under the
    system's temp folder.  On a cluster such a folder would be another one on every machine,
    so a missing setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), f"bundleflow-work-{os.getuid()}")
        os.makedirs(d, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def join_path(*parts: str) -> str:
    head, *rest = parts
    return "/".join([head.rstrip("/")] + [p.strip("/") for p in rest])
