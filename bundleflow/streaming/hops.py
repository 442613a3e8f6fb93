"""ST1-ST8, D1, S1-S6: the bundle pipeline as chained Structured Streaming hops.

Every hop is ``readStream`` -> transformation -> ``writeStream`` with
``trigger(availableNow=True)`` (process what is new, then stop) and its own
checkpoint, like ``CREATE OR REFRESH STREAMING TABLE``.  A rerun with no new
input commits nothing; a new file flows through every hop once.

Layout under ``root``::

    tables/bronze  tables/quarantine  tables/bronze_variant  tables/bundle_meta  tables/entries
    tables/resource_schemas/version=<n>   tables/silver/<type>/v=<k>/batch_id=<n>
    tables/silver_failed/<type>/batch_id=<n>   checkpoints/<hop>

Every hop is bounded: a micro-batch takes ``maxFilesPerTrigger`` files or, by default,
``MAX_BYTES`` bytes of them, so a full refresh of any size runs as many batches of one size.

Parquet file sinks are exactly-once (the sink keeps a commit log that readers
and downstream file sources honour).  ``foreachBatch`` sinks write each batch
to a directory named after the batch id with overwrite, so a replayed batch
replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.variant import object_to_struct_text
from ..operators.keys import KeyCollisionError
from ..plans import bronze, resources
from ..plans.declare import merged_schema
from ..session import join_path
from ..sinks.store import delete_path, list_dirs, path_exists, write_table_info
from .landing import follows_log, log_path, logged_texts

FILE_METADATA_FIELDS = ["file_path", "file_name", "file_size", "file_block_start",
                        "file_block_length", "file_modification_time"]


@dataclass(frozen=True)
class Layout:
    root: str

    def table(self, name: str) -> str:
        return join_path(self.root, "tables", name)

    def checkpoint(self, name: str) -> str:
        return join_path(self.root, "checkpoints", name)

    def silver(self, resource_type: str) -> str:
        return join_path(self.root, "tables", "silver", resource_type.lower())


def refresh(stream: DataFrame, name: str, layout: Layout, partition_by: list[str] | None = None,
            output_mode: str = "append", foreach_batch: Callable | None = None,
            processing_time: str | None = None):
    """D1/ST1: run one hop until the available input is drained (or continuously, ST2)."""
    w = stream.writeStream.option("checkpointLocation", layout.checkpoint(name)).outputMode(output_mode)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        if partition_by:
            w = w.partitionBy(*partition_by)
        q = w.format("parquet").option("path", layout.table(name)).start()
    if processing_time is None:
        q.awaitTermination()
    return q


MAX_BYTES = 4 << 30


def _bounded(reader, max_files_per_trigger: int | None):
    """Spark takes one bound: files if given, else bytes."""
    if max_files_per_trigger:
        return reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option("maxBytesPerTrigger", MAX_BYTES)


def read_stream_table(spark: SparkSession, layout: Layout, name: str, schema: StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """``STREAM(t)`` over a Parquet sink (the file source follows the sink's commit log)."""
    return _bounded(spark.readStream.schema(schema), max_files_per_trigger).parquet(layout.table(name))


def text_files_stream(spark: SparkSession, landing: str, glob: str = "*.json",
                      max_files_per_trigger: int | None = None, latest_first: bool = False,
                      clean_source: str = "off", archive_dir: str | None = None) -> DataFrame:
    """Whole-file text stream with the six-field file metadata struct."""
    r = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
         .option("recursiveFileLookup", True).option("latestFirst", latest_first)
         .option("cleanSource", clean_source))
    r = _bounded(r, max_files_per_trigger)
    if archive_dir:
        r = r.option("sourceArchiveDir", archive_dir)
    df = r.schema("value string").load(landing)
    meta = F.struct(*[F.col(f"_metadata.{f}").alias(f) for f in FILE_METADATA_FIELDS])
    return df.select(meta.alias("file_metadata"), "value")


def landed_texts(spark: SparkSession, landing: str, glob: str, layout: Layout, hop: str,
                 max_files_per_trigger: int | None = None, clean_source: str = "off",
                 archive_dir: str | None = None) -> DataFrame:
    """The texts that landed since the hop's last run.  A hop without bounds in files goes by a log of the landed
    files, as Spark's own source keeps every one of them on the driver; one that began on that source, or
    that has the source clean up, stays with it."""
    checkpoint = layout.checkpoint(hop)
    logged = path_exists(spark, log_path(checkpoint))
    if logged and clean_source != "off":
        raise ValueError(f"{hop} goes by its log of landed files, which cleans up nothing: refresh it in full")
    if logged or (not max_files_per_trigger and clean_source == "off" and follows_log(spark, checkpoint)):
        return logged_texts(spark, landing, glob, checkpoint, MAX_BYTES, max_files_per_trigger)
    return text_files_stream(spark, landing, glob, max_files_per_trigger,
                             clean_source=clean_source, archive_dir=archive_dir)


# --- hops -------------------------------------------------------------------------------

def bronze_hop(spark: SparkSession, landing: str, layout: Layout, id_mode: str = "hash",
               max_files_per_trigger: int | None = None, glob: str = "*.json"):
    """Files -> bronze (file_metadata, ingest_time, bundle_uuid, value)."""
    s = landed_texts(spark, landing, glob, layout, "bronze", max_files_per_trigger)
    q = refresh(bronze.bronze_from_text(s, id_mode), "bronze", layout)
    if path_exists(spark, layout.table("bronze")):
        write_table_info(spark, layout.table("bronze"), "Raw bundle text, one row per landed file.",
                         {"quality": "bronze"})
    return q


def _schema_of(spark: SparkSession, layout: Layout, name: str) -> StructType:
    return spark.read.parquet(layout.table(name)).schema


def variant_hop(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None):
    """Bronze -> bronze_variant (parse once)."""
    s = read_stream_table(spark, layout, "bronze", _schema_of(spark, layout, "bronze"), max_files_per_trigger)
    return refresh(bronze.variant_bronze(s), "bronze_variant", layout)


def quarantine_hop(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None):
    """V23/ST7: bronze_variant -> quarantine, the rows whose text did not parse, with their text;
    the parse of the hop before decides, no text is parsed again."""
    s = read_stream_table(spark, layout, "bronze_variant", _schema_of(spark, layout, "bronze_variant"),
                          max_files_per_trigger)
    return refresh(bronze.quarantine(s), "quarantine", layout)


def meta_hop(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None):
    """bronze_variant -> bundle_meta."""
    s = read_stream_table(spark, layout, "bronze_variant", _schema_of(spark, layout, "bronze_variant"),
                          max_files_per_trigger)
    return refresh(resources.bundle_meta(s), "bundle_meta", layout)


def entries_hop(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None):
    """C5 (entry level): bronze_variant -> entries, partitioned by resource type.

    Micro-batches run without AQE, so the rows are spread by (type, salted bundle hash) over as
    many salts as the cluster has shuffle partitions: a dominant type uses every task, and the
    bundles of one task stay together, so a bundle's entries of a type lie in one file.
    """
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    s = read_stream_table(spark, layout, "bronze_variant", _schema_of(spark, layout, "bronze_variant"),
                          max_files_per_trigger)
    # counted while the rows pass by, so that checking costs no further scan
    checked = resources.entries(s).observe(
        CONSTRAINTS, F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"not_null:{c}") for c in ENTRY_NOT_NULL])
    ent = checked.repartition(F.col("resourceType"), F.pmod(F.xxhash64("bundle_uuid"), F.lit(salts)))
    q = refresh(ent, "entries", layout, partition_by=["resourceType"])
    store_metrics(spark, layout, "entries", q)
    return q


# D3 in the stream: the declared constraints of the entries, and the name of their metrics.
ENTRY_NOT_NULL = ("fullUrl", "resourceType")
CONSTRAINTS = "constraints"


def store_metrics(spark: SparkSession, layout: Layout, hop: str, query) -> None:
    """Writes the observed constraint counts of every batch of a hop's run to ``constraint_metrics``
    (hop, batch_id, check_name, rows, violations): one row per batch and check.  Spark keeps the
    progress of the last ``spark.sql.streaming.numRecentProgressUpdates`` batches."""
    rows = []
    for p in query.recentProgress:
        seen = (p.observedMetrics or {}).get(CONSTRAINTS)
        if seen is not None and p.numInputRows:
            counts = seen.asDict()
            total = counts.pop("rows")
            rows += [(hop, p.batchId, name, total, n) for name, n in counts.items()]
    if rows:
        spark.createDataFrame(rows, "hop string, batch_id long, check_name string, rows long, violations long").coalesce(
            1).write.mode("append").parquet(layout.table("constraint_metrics"))


def read_entries(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.parquet(layout.table("entries"))


def schemas_hop(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None):
    """C7/ST5: the registry of (type, key, inferred schema), kept up without a state store.

    Each batch infers the schemas of its own rows (a partial aggregate, then one row per key), merges
    their texts with the registry before it, and writes the result, whose size the width of the
    schemas bounds, to a new ``version=<batch>`` folder with a ``_SUCCESS`` marker; readers take the
    highest complete version.  The merge is associative, so the registry equals one inference over
    all rows, whatever the batches; a replayed batch starts again from the version before it.
    """
    ent = read_stream_table(spark, layout, "entries", read_entries(spark, layout).schema, max_files_per_trigger)
    out = layout.table("resource_schemas")

    def write(batch: DataFrame, batch_id: int) -> None:
        found = {(r.resourceType, r.column_name): r.schema_of_variant
                 for r in resources.resource_schemas(resources.resources_long(batch)).collect()}
        before = [v for v in schema_versions(spark, layout) if v < batch_id]
        if before:
            for r in spark.read.parquet(join_path(out, f"version={before[-1]:09d}")).collect():
                key = (r.resourceType, r.column_name)
                found[key] = merged_schema(r.schema_of_variant, found.get(key, "VOID"))
        rows = [(t, k, s, object_to_struct_text(s)) for (t, k), s in found.items()]
        spark.createDataFrame(rows, REGISTRY).coalesce(1).write.mode("overwrite").parquet(
            join_path(out, f"version={batch_id:09d}"))
        for v in before[:-1]:  # the version before stays for open readers
            delete_path(spark, join_path(out, f"version={v:09d}"))

    return refresh(ent, "resource_schemas", layout, foreach_batch=write)


REGISTRY = "resourceType string, column_name string, schema_of_variant string, schema_as_struct string"


def schema_versions(spark: SparkSession, layout: Layout) -> list[int]:
    """The complete versions of the registry, oldest first."""
    out = layout.table("resource_schemas")
    return sorted(int(d.split("=")[1]) for d in list_dirs(spark, out)
                  if d.startswith("version=") and path_exists(spark, join_path(out, d, "_SUCCESS")))


def latest_schemas(spark: SparkSession, layout: Layout) -> DataFrame | None:
    done = schema_versions(spark, layout)
    return spark.read.parquet(join_path(layout.table("resource_schemas"), f"version={done[-1]:09d}")) if done else None


def silver_version(spark: SparkSession, layout: Layout, resource_type: str) -> int:
    """The wide table's present version: its highest complete folder ``v=<k>`` (0 at first)."""
    found = [int(d[2:]) for d in list_dirs(spark, layout.silver(resource_type)) if re.fullmatch(r"v=\d+", d)]
    return max(found, default=0)


def silver_path(spark: SparkSession, layout: Layout, resource_type: str) -> str:
    """Where new batches go."""
    return join_path(layout.silver(resource_type), f"v={silver_version(spark, layout, resource_type)}")


def silver_batches(spark: SparkSession, layout: Layout, resource_type: str) -> dict[str, str]:
    """The folder of every batch of the wide table.  A version holds the batches that were rewritten
    or came with it; of a batch the highest version counts.  Version folders appear by one rename, so
    a reader meets all of a rewrite or nothing of it."""
    found: dict[str, str] = {}
    for k in range(silver_version(spark, layout, resource_type) + 1):
        base = join_path(layout.silver(resource_type), f"v={k}")
        found |= {d: join_path(base, d) for d in list_dirs(spark, base) if d.startswith("batch_id=")}
    return dict(sorted(found.items()))


def _widest(spark: SparkSession, layout: Layout, resource_type: str) -> StructType | None:
    """Schema of the newest batch, which holds the full ordered column list, as columns only ever
    widen; reading one footer keeps this constant-cost as batches accumulate."""
    batches = silver_batches(spark, layout, resource_type)
    return spark.read.parquet(batches[max(batches)]).schema if batches else None


def silver_columns(spark: SparkSession, layout: Layout, resource_type: str) -> list[str] | None:
    """Column list of the stored wide table (None when it does not exist)."""
    schema = _widest(spark, layout, resource_type)
    return None if schema is None else schema.names


def read_silver(spark: SparkSession, layout: Layout, resource_type: str) -> DataFrame:
    """Wide table of one type: all batches under the widest schema, so what older batches lack reads
    as NULL; no footers are merged."""
    return spark.read.schema(_widest(spark, layout, resource_type)).parquet(
        *silver_batches(spark, layout, resource_type).values())


class SilverTypeError(RuntimeError):
    """Some types could not be written as wide tables; the others were committed."""


def silver_hop(spark: SparkSession, layout: Layout, drift_log: list | None = None, parallel_types: int = 4,
               max_files_per_trigger: int | None = None):
    """C8-C10/ST6/ST8: wide tables per resource type, built inside ``foreachBatch``.

    A bundle is one file and so never spans micro-batches: every resource's
    keys arrive together and the batch is pivoted (projected) with no state.
    Per batch and type the key list is the registry's, in the stored column
    order with new keys appended alphabetically (C9).  New keys (C8) widen the
    table: earlier batches never carried them, so reading them back as NULL is
    exact.  The batch folder is overwritten on replay.  Each type reads its own
    partition of the batch's files, so nothing is cached.

    A type that fails (keys equal up to case) keeps its rows of the batch in
    ``silver_failed`` while the other types commit; after the last batch the hop
    raises ``SilverTypeError`` with every such type.
    """
    from ..operators.keys import existing_columns, new_keys, ordered_key_list
    from ..plans.declare import declarations, with_declaration
    from ..plans.silver import fixed_columns, silver_table

    stream = read_stream_table(spark, layout, "entries", read_entries(spark, layout).schema, max_files_per_trigger)
    failed: dict[str, str] = {}

    def one_type(batch: DataFrame, batch_id: int, registry: DataFrame, declared: dict, t: str) -> None:
        existing = existing_columns(spark, t, silver_columns(spark, layout, t), skip=fixed_columns(t))
        if drift_log is not None:
            added = [r.column_name for r in new_keys(registry.where(F.col("resourceType") == t), existing).collect()]
            if added:
                drift_log.append((batch_id, t, sorted(added)))
        keys = ordered_key_list(registry, existing, t)
        folder = f"batch_id={batch_id:09d}"
        try:
            wide = with_declaration(silver_table(batch, t, keys), declared.get(t, StructType([])))
        except KeyCollisionError as e:
            failed[t] = str(e)
            batch.where(F.col("resourceType") == t).write.mode("overwrite").parquet(
                join_path(layout.root, "tables", "silver_failed", t.lower(), folder))
            return
        wide.write.mode("overwrite").parquet(join_path(silver_path(spark, layout, t), folder))

    def write(batch: DataFrame, batch_id: int) -> None:
        registry = latest_schemas(spark, layout)
        declared = declarations(spark, registry)
        types = sorted(r[0] for r in batch.select("resourceType").where(F.col("resourceType").isNotNull())
                       .distinct().collect())  # C6: bounded by the number of resource types
        # ST10: the per-type writes are independent jobs; run them concurrently
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_types, len(types) or 1))) as pool:
            for f in [pool.submit(one_type, batch, batch_id, registry, declared, t) for t in types]:
                f.result()

    q = refresh(stream, "silver", layout, foreach_batch=write)
    for t in list_dirs(spark, join_path(layout.root, "tables", "silver")):
        write_table_info(spark, join_path(layout.root, "tables", "silver", t),
                         f"Parsed {t} resources, one column per observed key.", {"quality": "silver"})
    if failed:
        raise SilverTypeError("; ".join(f"{t}: {why}" for t, why in sorted(failed.items())))
    return q


def lacking_batches(spark: SparkSession, layout: Layout, resource_type: str) -> dict[str, str]:
    """The batches whose files lack a column of the present table, by one footer each."""
    columns = set(silver_columns(spark, layout, resource_type) or [])
    return {b: p for b, p in silver_batches(spark, layout, resource_type).items()
            if columns - set(spark.read.parquet(p).columns)}


def rebuild_silver(spark: SparkSession, layout: Layout, resource_type: str) -> list[str]:
    """Gives every file of one wide table every known key (between runs); returns the batches
    that were rewritten.

    For consumers that read the files without the table's schema: ``read_silver`` needs it never.
    Only the batches that lack a column are rewritten, into the next version folder, which appears by
    one rename; rows keep the batch they came with, so a later replay of a batch replaces that batch
    alone.  Of a rewritten batch the folder before stays for readers that have it open, older ones go.
    """
    from ..plans.declare import declarations, with_declaration
    lacking = lacking_batches(spark, layout, resource_type)
    if not lacking:
        return []
    schema, now = _widest(spark, layout, resource_type), silver_version(spark, layout, resource_type)
    declared = declarations(spark, latest_schemas(spark, layout)).get(resource_type, StructType([]))
    batch = F.regexp_extract("_metadata.file_path", r"batch_id=(\d+)", 1).alias("batch_id")
    old = spark.read.schema(schema).parquet(*lacking.values()).select(*[F.col(f"`{c}`") for c in schema.names], batch)
    base = layout.silver(resource_type)
    new, tmp = join_path(base, f"v={now + 1}"), join_path(base, f"_building-{now + 1}")
    delete_path(spark, tmp)
    with_declaration(old, declared).write.partitionBy("batch_id").parquet(tmp)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(tmp).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(tmp), path(new)):
        raise OSError(f"cannot rename {tmp} to {new}")
    for b in lacking:
        versions = [k for k in range(now + 1) if path_exists(spark, join_path(base, f"v={k}", b))]
        for k in versions[:-1]:
            delete_path(spark, join_path(base, f"v={k}", b))
    return sorted(lacking)


def drop_silver(spark: SparkSession, layout: Layout) -> list[str]:
    """Drops the wide tables that the registry names, and the hop's checkpoint, so that the
    next run builds them again from the stored entries; returns the types."""
    registry = latest_schemas(spark, layout)
    if registry is None:
        return []
    types = sorted(r[0] for r in registry.select("resourceType").distinct().collect())  # one per type
    for t in types:
        delete_path(spark, layout.silver(t))
        delete_path(spark, join_path(layout.root, "tables", "silver_failed", t.lower()))
    delete_path(spark, layout.checkpoint("silver"))
    return types


def drop_all(spark: SparkSession, layout: Layout) -> None:
    """D6/ST3: full refresh removes outputs and checkpoints together."""
    delete_path(spark, join_path(layout.root, "tables"))
    delete_path(spark, join_path(layout.root, "checkpoints"))


def run(spark: SparkSession, landing: str, root: str, full_refresh: bool = False, id_mode: str = "hash",
        max_files_per_trigger: int | None = None, glob: str = "*.json",
        drift_log: list | None = None, timings: dict | None = None, rebuild_on_drift: bool = False) -> Layout:
    """Optional full refresh (ST3) -> bronze -> variant -> quarantine, meta and entries ->
    schemas -> silver.  New keys widen a wide table without touching its history; with
    ``rebuild_on_drift`` the files that lack them are rewritten as well (D8)."""
    layout, bound = Layout(root), max_files_per_trigger

    def step(name, fn, *args, **kwargs):
        t0 = time.perf_counter()
        out = fn(*args, **kwargs)
        if timings is not None:
            timings[name] = timings.get(name, 0.0) + time.perf_counter() - t0
        return out

    if full_refresh:
        step("drop", drop_all, spark, layout)
    step("bronze", bronze_hop, spark, landing, layout, id_mode, bound, glob)
    if not path_exists(spark, layout.table("bronze")):
        return layout  # nothing landed yet
    step("variant", variant_hop, spark, layout, bound)
    step("quarantine", quarantine_hop, spark, layout, bound)
    step("meta", meta_hop, spark, layout, bound)
    step("entries", entries_hop, spark, layout, bound)
    if not list_dirs(spark, layout.table("entries")):
        return layout
    step("schemas", schemas_hop, spark, layout, bound)
    before = {t: silver_columns(spark, layout, t) for t in list_dirs(spark, join_path(root, "tables", "silver"))}
    step("silver", silver_hop, spark, layout, drift_log, max_files_per_trigger=bound)
    if rebuild_on_drift:
        for t, columns in before.items():
            if columns is not None and silver_columns(spark, layout, t) != columns:
                step("rebuild", rebuild_silver, spark, layout, t)
    return layout
