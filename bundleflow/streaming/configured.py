"""S12/ST10: config-driven ingest.  Each JSON definition names a landing folder, a glob, a staging
folder and an output root; one availableNow stream runs per definition, several at a time.

Definition fields: ``name``, ``landing``, ``glob`` (default ``*``), ``stage_dir``,
``root``, optional ``max_files_per_trigger``, ``clean_source`` (off|archive|delete)
and ``archive_dir``.  The definitions are few (collected); the data never is.

The streams are independent queries of one session, so the scheduler shares the cluster among them;
threads only start them and wait.  A definition that fails stops no other: its error stands in its
outcome, and ``run_definitions`` raises after the last one has ended, with every outcome.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import ingest_definitions
from ..sinks.store import list_dirs
from .ccda import read_documents, stage_documents
from .hops import Layout

PARALLEL = 4


@dataclass
class Outcome:
    """What became of one definition."""

    name: str
    layout: Layout | None = None
    error: str | None = None
    seconds: float = 0.0


class DefinitionError(RuntimeError):
    """Some definitions failed; ``outcomes`` holds all of them."""

    def __init__(self, outcomes: dict[str, Outcome]):
        failed = {n: o.error for n, o in outcomes.items() if o.error is not None}
        super().__init__("; ".join(f"{n}: {e}" for n, e in sorted(failed.items())))
        self.outcomes = outcomes


def run_one(spark: SparkSession, d: dict) -> Outcome:
    out, begin = Outcome(str(d.get("name"))), time.perf_counter()
    try:
        missing = [k for k in ("name", "landing", "stage_dir", "root") if not d.get(k)]
        if missing:
            raise ValueError(f"definition without {', '.join(missing)}")
        out.layout = stage_documents(
            spark, d["landing"], d["stage_dir"], d["root"], glob=d.get("glob") or "*",
            max_files_per_trigger=d.get("max_files_per_trigger"),
            clean_source=d.get("clean_source") or "off", archive_dir=d.get("archive_dir"))
    except Exception as e:  # whatever stops one source must not stop the others
        out.error = f"{type(e).__name__}: {e}".splitlines()[0]
    out.seconds = time.perf_counter() - begin
    return out


def run_all(spark: SparkSession, config_dir: str, parallel: int = PARALLEL) -> dict[str, Outcome]:
    """Runs every definition to the end of its landed files; the outcome of each by name."""
    found = sorted(ingest_definitions(spark, config_dir), key=lambda d: str(d.get("name")))
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(found) or 1))) as pool:
        return {o.name: o for o in pool.map(lambda d: run_one(spark, d), found)}


def run_definitions(spark: SparkSession, config_dir: str, parallel: int = PARALLEL) -> dict[str, Layout]:
    outcomes = run_all(spark, config_dir, parallel)
    if any(o.error is not None for o in outcomes.values()):
        raise DefinitionError(outcomes)
    return {name: o.layout for name, o in outcomes.items()}


def staged_documents(spark: SparkSession, outcomes: dict[str, Outcome]) -> DataFrame:
    """(definition, file_name, value, copy_status) of everything the successful definitions hold."""
    found = spark.createDataFrame([], "definition string, file_name string, value string, copy_status string")
    for name, o in sorted(outcomes.items()):
        if o.layout is not None and list_dirs(spark, o.layout.table("documents_bronze")):
            found = found.unionByName(read_documents(spark, o.layout).select(
                F.lit(name).alias("definition"), F.col("file_metadata.file_name").alias("file_name"), "value",
                F.col("copy_status")["status"].alias("copy_status")))
    return found
