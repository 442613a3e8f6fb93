"""Sharding by a Feistel permutation with cycle walking (operator 6).

Rows get a global number 0..n-1 in the order of (id, text checksum, size, position); the
numbers are permuted by an alternating Feistel network over a grid of a x b cells with
a = ceil(sqrt(n)) and b = ceil(n / a), so fewer than a cells lie outside 0..n-1.  A number
that lands outside is permuted again until it is inside (cycle walking); at most
a * b - n + 1 walks are needed, as a cycle can visit no more outside cells than exist.  Then
shard = p mod shards and slot = p div shards: counts differ by at most one and both follow
from a row's number alone.  The law is ``rows``.

The order is total up to rows that are equal in id, checksum and size, whose places are
interchangeable, so the same table gives the same shards however it is split into files.
Numbering sorts by range (narrow rows only, position as last key, so equal rows spread over
tasks) and adds per-partition offsets; no row goes through the driver or a single task.

Defined results: a null text has size 1 and checksum 0, null ids sort first, repeated rows
get places of their own, an empty table gives an empty result; extra columns are ignored.
The method has no notion of groups: rows of equal text are dealt like any others, as the law
of counts asks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# Fixed values of the round function: a Mersenne prime and an odd multiplier below 2^16.
PRIME, FACTOR = 2147483647, 40503
ROUNDS = 6
SHORT_WALK = 4


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    keys, x = [], seed % PRIME or 1
    for _ in range(rounds):
        x = (x * 48271 + 11) % PRIME
        keys.append(x)
    return keys


def mix(v: str, k: str) -> str:
    """SQL of the round function; every intermediate stays below 2^63."""
    one = f"(({v} * {FACTOR} + {k}) % {PRIME})"
    return f"((({one} * {one} + {k}) % {PRIME}) * {FACTOR} % {PRIME})"


def permute_sql(x: str, a: int, b: int, keys: list[int]) -> str:
    """SQL of one pass of the network over number ``x``."""
    steps = ", ".join(f"named_struct('left', {'true' if i % 2 == 0 else 'false'}, 'k', {k}L)"
                      for i, k in enumerate(keys))
    return (f"aggregate(array({steps}), named_struct('l', {x} div {b}L, 'r', {x} % {b}L), "
            f"(s, c) -> if(c.left, named_struct('l', (s.l + {mix('s.r', 'c.k')}) % {a}L, 'r', s.r), "
            f"named_struct('l', s.l, 'r', (s.r + {mix('s.l', 'c.k')}) % {b}L)), "
            f"s -> s.l * {b}L + s.r)")


def number_rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, size, crc, n) with n the global row number, and the row count."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"),
                         (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("crc"),
                         F.monotonically_increasing_id().alias("position"))
    # written before it is sorted: texts are read once, not also by the range sampling
    narrow = Scratch(spark, "shard").write(narrow, "narrow")
    ordered = narrow.orderBy("id", "crc", "size", "position").checkpoint()
    placed = ordered.select("id", "size", "crc", F.spark_partition_id().alias("part"),
                            F.monotonically_increasing_id().alias("at"))
    # one row per partition of the sort: the offsets of all parts
    counts = placed.groupBy("part").agg(F.count("*").alias("rows"), F.min("at").alias("low"))
    parts = sorted((r["part"], r["rows"], r["low"]) for r in counts.collect())
    if not parts:
        return placed.select("id", "size", "crc", F.col("at").alias("n")), 0
    shift, total = [], 0
    for part, rows, low in parts:
        shift += [F.lit(part), F.lit(total - low)]
        total += rows
    offset = F.element_at(F.create_map(*shift), F.col("part"))
    return placed.select("id", "size", "crc", (F.col("at") + offset).alias("n")), total


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20240607,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    numbered, n = number_rows(docs, id_col, text_col)
    a = max(1, math.isqrt(max(n - 1, 0)) + 1) if n > 1 else 1
    b = max(1, -(-n // a))
    keys = round_keys(seed)
    outside = a * b - n + 1

    def walk(x: str, times: int) -> str:
        return (f"aggregate(sequence(1, {times}), {x}, "
                f"(y, i) -> if(y < {n}L, y, {permute_sql('y', a, b, keys)}))")

    p = (numbered.withColumn("p", F.expr(permute_sql("n", a, b, keys)))
         .withColumn("p", F.expr(walk("p", SHORT_WALK)))
         .withColumn("p", F.expr(f"if(p < {n}L, p, {walk('p', max(outside, 1))})")))
    return p.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), (F.col("p") % shards).cast("int").alias("shard"),
        F.expr(f"p div {shards}L").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
