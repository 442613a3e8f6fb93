"""Benchmark decontamination by spaced seeds (operator 2).

A seed takes the words at five of the positions of a short span, given by a fixed mask, so a
substituted word at an ignored position does not hide it.  Seeds of all benchmark items are
indexed at every position; seeds of all positions of all documents are joined to them.  Each
hit names an alignment (document, item, difference of positions), which is verified around the
hit: some window of ``WINDOW`` aligned words (the whole item if it is shorter) must agree in
at least 80 % of its words.

The three masks leave no such window without a hit: for every window length from
``MIN_ITEM`` to ``WINDOW`` and every placement of its allowed substitutions at least one seed
stays whole (a test enumerates them), so the search finds all alignments that verification
would accept.

Items below ``MIN_ITEM`` words are leaked by documents that hold their whole word run: hashes of
all runs of their lengths are joined to the hashes of the items, and every word must agree.

Words are lower-cased runs of letters and digits.  Documents are identified by a hash and the
length of their text while hits are gathered, so copies are searched and verified once and
null or repeated ids do no harm.

Defined results: null or empty texts and items, and items without a word, leak nothing; very
long texts are searched whole; items with equal text or a null id are reported each; of several
alignments the one with most equal words counts; repeated rows keep their rows; an empty table
gives an empty result; extra columns are carried by ``drop_leaks`` and ignored by ``leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, broadcast_if_small

# Word offsets of the seeds, five of a span of at most eight.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
WINDOW = 13
MIN_ITEM = 8
PERCENT = 80
SEED_BYTES = 32


def words(text: str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), "")


def seeds(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(*keep, at, seed) for every mask and position of the word hashes ``h``."""
    # positions are exploded, not seeds: what reads ``h`` stays in the same generated code
    spots = rows.select(*keep, "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    each = [F.when(F.col("at") + m[-1] < F.size("h"),
                   F.xxhash64(F.lit(k), *[F.get("h", F.col("at") + o) for o in m]))
            for k, m in enumerate(MASKS)]
    return (spots.select(*keep, "at", F.explode(F.array(*each)).alias("seed"))
            .filter("seed IS NOT NULL"))


def runs(rows: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """(*keep, at, seed) for every run of ``lengths`` words of the word hashes ``h``."""
    spots = rows.select(*keep, "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    each = [F.when(F.col("at") + n <= F.size("h"),
                   F.xxhash64(F.lit(-n), *[F.get("h", F.col("at") + o) for o in range(n)])) for n in lengths]
    return spots.select(*keep, "at", F.explode(F.array(*each)).alias("seed")).filter("seed IS NOT NULL")


def hashed(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    return (df.select(*keep, F.transform(words(text), lambda w: F.xxhash64(w)).alias("h"))
            .filter(F.size("h") > 0))


def text_key(text: str) -> Column:
    """Identifies a text: its hash and its length."""
    return F.struct(F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes"))


def aligned() -> Column:
    """1 or 0 for each word of the item: the document has it at the aligned place."""
    return F.expr("transform(iw, (w, i) -> if(coalesce(get(dw, i + shift), '') = w, 1, 0))")


def holds_window() -> Column:
    """Some window of the alignment ``m`` agrees in ``PERCENT`` of its words (short items: in all)."""
    width = f"least({WINDOW}, size(m))"
    return F.expr(f"exists(sequence(0, size(m) - {width}), i -> 100 * aggregate(slice(m, i + 1, {width}), 0, "
                  f"(s, x) -> s + x) >= if(size(m) < {MIN_ITEM}, 100, {PERCENT}) * {width})")


def leaking_texts(docs: DataFrame, items: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, matched) for every text and item that share a verified passage;
    matched: equal words of the best alignment."""
    scratch = Scratch(docs.sparkSession, "leaks")
    tests = scratch.write(
        items.select(F.col(item_text).alias("text"), F.col(item_col).alias("item_id"))
        .groupBy("text").agg(F.collect_set(F.struct("item_id")).alias("ids"))  # structs: null ids count
        .filter(F.size(words("text")) > 0)
        .select(F.xxhash64("text").alias("item"), "ids", "text", words("text").alias("iw")), "items")
    short = [r.n for r in tests.filter(F.size("iw") < MIN_ITEM).select(F.size("iw").alias("n")).distinct().collect()]
    hashes = hashed(tests, ["item"])
    found = seeds(hashes.filter(F.size("h") >= MIN_ITEM), ["item"])
    for n in short:  # at most MIN_ITEM - 1 lengths
        found = found.unionByName(runs(hashes.filter(F.size("h") == n), ["item"], [n]))
    index = scratch.write(found.select("seed", "item", F.col("at").alias("item_at")).distinct(), "index")
    texts = docs.select(F.col(text_col).alias("text"))
    hashes = hashed(texts.select(text_key("text").alias("key"), "text"), ["key"])
    found = seeds(hashes, ["key"])
    if short:
        found = found.unionByName(runs(hashes, ["key"], sorted(short)))
    hits = scratch.write(
        found.join(broadcast_if_small(index, SEED_BYTES, 32 << 20), "seed")
        .select("key", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
    keys = broadcast_if_small(scratch.write(hits.select("key").distinct(), "keys"), 16)
    # words are stored as arrays: an alignment reads them by position, it never splits a text
    hit_texts = scratch.write(
        texts.select(text_key("text").alias("key"), "text").join(keys, "key", "left_semi")
        .groupBy("key").agg(F.first("text").alias("text")).select("key", words("text").alias("dw")), "texts")
    pairs = scratch.write(
        hits.join(hit_texts, "key").join(tests.select("item", "ids", "iw"), "item")
        .select("key", "ids", aligned().alias("m")), "aligned").filter(holds_window())
    return scratch.write(
        pairs.select("key", F.explode("ids.item_id").alias("item_id"),
                     F.expr("aggregate(m, 0, (s, x) -> s + x)").alias("matched"))
        .groupBy("key", "item_id").agg(F.max("matched").alias("matched")), "found")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id") -> DataFrame:
    """(id, item_id, matched) for every document row and item that share a passage."""
    found = leaking_texts(docs, items, text_col, item_col)
    few = broadcast_if_small(found, 40)
    return (docs.select(F.col(id_col), text_key(text_col).alias("key")).join(few, "key")
            .select(id_col, F.col("item_id").alias(item_col), "matched"))


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no passage with an item."""
    found = leaking_texts(docs, items, text_col).select(F.col("key.hash").alias("leak hash"),
                                                        F.col("key.bytes").alias("leak bytes")).distinct()
    few = broadcast_if_small(found, 16)
    return docs.join(few, (F.xxhash64(docs[text_col]) == few["leak hash"])
                     & (F.octet_length(docs[text_col]) == few["leak bytes"]), "left_anti")
