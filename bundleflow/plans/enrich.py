"""Batched request/response enrichment; U7: code-description lookup.

The transport is injected: a callable taking a list of request dicts and
returning one response dict per request.  Requests travel in Arrow batches
(``mapInPandas``) and each batch is one transport call, so a real client can
pool connections or use a bulk endpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_side

RESULT_SCHEMA = (
    "request_method string, request_resource string, request_id string, request_payload string, "
    "status_code int, elapsed_seconds double, headers map<string,string>, text string, url string"
)

Transport = Callable[[list[dict]], list[dict]]


def request_batches(df: DataFrame, transport: Transport, method: str, resource: str,
                    id_col: str | None = None, payload_col: str | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """One request per row; ``get`` uses ``id_col``, ``post`` uses ``payload_col``."""
    method = method.lower()
    if method == "get" and not id_col:
        raise ValueError("get needs id_col")
    if method == "post" and not payload_col:
        raise ValueError("post needs payload_col")
    if method not in ("get", "post"):
        raise ValueError(f"unsupported method {method!r}")
    keep = keep or []
    src = df.select(
        *keep,
        (F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")).alias("_id"),
        (F.col(payload_col).cast("string") if payload_col else F.lit(None).cast("string")).alias("_payload"),
    )
    keep_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep)
    out_schema = (keep_schema + ", " if keep_schema else "") + RESULT_SCHEMA

    def run(batches):
        for pdf in batches:
            reqs = [{"method": method, "resource": resource, "id": i, "payload": p}
                    for i, p in zip(pdf["_id"], pdf["_payload"])]
            t0 = time.perf_counter()
            res = transport(reqs) if reqs else []
            per = (time.perf_counter() - t0) / max(len(reqs), 1)
            out = pdf[keep].copy() if keep else pd.DataFrame(index=pdf.index)
            out["request_method"] = method
            out["request_resource"] = resource
            out["request_id"] = pdf["_id"].values
            out["request_payload"] = pdf["_payload"].values
            out["status_code"] = [r["status_code"] for r in res]
            out["elapsed_seconds"] = per  # total seconds (not only the microsecond part)
            out["headers"] = [r.get("headers", {}) for r in res]
            out["text"] = [r.get("text") for r in res]
            out["url"] = [r.get("url") for r in res]
            yield out

    return src.mapInPandas(run, out_schema)


def describe_codes(df: DataFrame, code_cols: list[str], lookup: DataFrame, key_col: str,
                   desc_col: str, suffix: str = "_desc") -> DataFrame:
    """U7 re-aimed: code descriptions by join to a code table.

    Small code table (by its bytes): broadcast it and look up each column without a shuffle.
    Large code table: cut it down to the codes actually used by one semi-join, so the big
    table is shuffled once and not once per column; AQE decides how the rest is joined.
    """
    lk = lookup.select(F.col(key_col).cast("string").alias("_code"), F.col(desc_col).alias("_desc"))
    side = small_side(lk)
    if side is lk:  # not provably small
        used = (df.select(F.explode(F.array(*[F.col(c) for c in code_cols])).alias("_code"))
                .where(F.col("_code").isNotNull()).distinct())
        side = lk.join(used, "_code", "left_semi")
    out = df
    for c in code_cols:
        out = (out.join(side.withColumnRenamed("_code", f"_code_{c}"), F.col(c) == F.col(f"_code_{c}"), "left")
               .withColumnRenamed("_desc", c + suffix).drop(f"_code_{c}"))
    return out


def describe_positions(df: DataFrame, id_cols: list[str], codes: dict[str, str], lookup: DataFrame) -> DataFrame:
    """U7 for any number of codes: ``codes`` names array columns of codes by kind; ``lookup`` has kind,
    code and description.  Returns the ids with one array of (code, description) per kind, in order.

    All arrays are exploded with their positions, joined once, and regrouped: one row per code
    travels, whatever the number of columns.  The table of codes is broadcast if its bytes allow; if
    not, AQE splits the rows of a hot code.  Ids whose arrays are empty or NULL keep a row.
    """
    def placed(kind: str, column: str):
        return F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), x.alias("code")))

    rows = df.select(*id_cols, F.concat(*[placed(k, c) for k, c in codes.items()]).alias("all codes"))
    rows = rows.select(*id_cols, F.explode_outer("all codes").alias("c")).select(*id_cols, "c.*")
    side = small_side(lookup.select(F.col("kind").alias("look kind"), F.col("code").alias("look code"), "description"))
    found = rows.join(side, (F.col("kind") == F.col("look kind")) & (F.col("code") == F.col("look code")), "left")
    held = [F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("place", "code", "description")))).alias(kind)
            for kind in codes]
    grouped = found.groupBy(*id_cols).agg(*held)
    return grouped.select(*id_cols, *[
        F.transform(kind, lambda x: F.struct(x["code"].alias("code"), x["description"].alias("description"))).alias(kind)
        for kind in codes])


REQUEST_FUNCTION_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION fhir_request(method STRING, resource STRING, action STRING, data STRING)
RETURNS STRING
NOT DETERMINISTIC
COMMENT 'Request descriptor for the batched transport: method (get|post), FHIR resource, action, id or payload.'
RETURN to_json(named_struct('method', lower(method), 'resource', resource, 'action', action, 'data', data))
"""


def register_sql_functions(spark) -> None:
    """The SQL scalar function surface; the calls themselves go through ``request_batches``."""
    spark.sql(REQUEST_FUNCTION_SQL)
