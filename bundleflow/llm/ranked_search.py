"""Ranked lexical search with geometric blocks in every posting list (operator 13).

Texts are read once per group of items into narrow rows: number of terms, and count of every term
that some item of the group has.  Their sums give the statistics of all documents.  Tasks then
take these rows in shards of bounded size and build, for each term, the posting list of the
shard, cut it into blocks of documents that lie close to each other (each document goes to the
nearest of the list's pivots, by a random projection of its impact vector), and store for each
block the coordinatewise maximum of its documents' impacts, over the terms that some item asks
together with the list's term.

An item reads the lists of its terms by falling possible share.  A block is skipped only if the
bound from its summary (sum of maxima, an integer) is below the score that the k-th best document
found so far has; the remaining lists are left when their maxima together stay below it.  Equal
scores are never skipped, as the smaller id wins them.  So results are those of scoring every
document.  A first pass over a sixteenth of the rows gives every item a score that its k-th best
document has at least; the pass over all rows starts from it, so tasks emit few rows.  Those are
merged by a window per item with a partial limit.

Nothing grows with the documents but the narrow rows: a task holds one shard (``CELLS`` numbers),
shards are dealt as rows lie, so no term, source or group of copies gathers anywhere, and equal
vectors of a shard are scored once.  Items are the stated query set: they are read in groups of
about ``GROUP_BYTES`` and searched in blocks of about ``BLOCK_BYTES`` of text, at any number.

Terms are runs of letters, digits and everything beyond ASCII, A-Z lower-cased.  Very long texts
are read in stretches.

Defined results: null and empty texts and items have no terms and give no rows; a null document
id sorts before all others among equal scores; repeated documents are ranked each for itself,
repeated items give their rows each for itself; with empty tables there are no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, strings, word_stretches

TOP = 20
# k1 is 1.2 (12 tenths) and b is 25 of 100.
K1_TENTHS, B_PERCENT = 12, 25
# Documents that a block of a posting list holds on average.
BLOCK_DOCS = 64
# Numbers of a shard's matrix (documents times terms).
CELLS = 1 << 23
# Directions of the random projection.
DIRECTIONS = 16
GROUP_BYTES = 4 << 20
BLOCK_BYTES = 64 << 10
# One of so many rows is searched first.
FIRST_SHARE = 16


def term_counts(text: str) -> Counter:
    found: Counter = Counter()
    for words in word_stretches(text):
        found.update(words)
    return found


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of every text with a term; terms are those of the vocabulary."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = shared.value

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            keep, sizes, ends, terms, tfs = [], [], [0], [], []
            for i, text in enumerate(strings(b.column(1))):
                found = term_counts(text)
                if found:
                    keep.append(i)
                    sizes.append(found.total())
                    held = sorted((known[w], c) for w, c in found.items() if w in known)
                    terms += [t for t, _ in held]
                    tfs += [c for _, c in held]
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            return pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                names=["id", "n", "terms", "tfs"])
        return fn

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), make,
                     f"id {kind}, n long, terms array<int>, tfs array<long>")


class Weights:
    """Statistics of all documents, and the impact of a term in a document."""

    def __init__(self, n_docs: int, n_terms: int, dfs: dict[int, int], size: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * dfs.get(t, 0) + 1)))
                           for t in range(size)], dtype=np.int64)

    def impacts(self, n: int, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        m = 100 - B_PERCENT + (B_PERCENT * n * self.n_docs) // self.n_terms
        return self.w[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + K1_TENTHS * m))


class Block:
    """Items that are searched together: their terms as columns 0, 1, 2, ..."""

    def __init__(self, items: list[tuple[int, dict[int, int]]], size: int):
        self.names = [name for name, _ in items]
        self.terms = np.array(sorted({t for _, held in items for t in held}), dtype=np.int64)
        self.column = np.full(size, -1, dtype=np.int64)
        self.column[self.terms] = np.arange(len(self.terms))
        self.items = []
        asked: list[set[int]] = [set() for _ in self.terms]
        for _, held in items:
            columns = self.column[list(held)]
            self.items.append((columns, np.array(list(held.values()), dtype=np.int64)))
            for c in columns.tolist():
                asked[c].update(columns.tolist())
        # the columns that some item asks together with a column
        self.asked = [np.array(sorted(a), dtype=np.int64) for a in asked]
        self.signs = np.random.default_rng(len(self.terms)).choice(
            np.array([-1, 1], dtype=np.float32), (len(self.terms), DIRECTIONS))


class Shard:
    """Documents of bounded number with a blocked posting list for every column."""

    def __init__(self, block: Block, impacts: np.ndarray):
        self.block, self.impacts = block, impacts
        place = impacts.astype(np.float32) @ block.signs
        place /= np.linalg.norm(place, axis=1, keepdims=True) + 1e-9
        self.lists = [self._blocked(np.flatnonzero(impacts[:, c]), c, place)
                      for c in range(impacts.shape[1])]

    def _blocked(self, held: np.ndarray, column: int, place: np.ndarray):
        """(documents by block, first document of every block, summary of every block)."""
        n_blocks = -(-len(held) // BLOCK_DOCS)
        begins = np.zeros(min(n_blocks, 1), dtype=np.int64)
        if n_blocks > 1:
            pivots = place[held[np.arange(n_blocks) * len(held) // n_blocks]]
            nearest = np.argmax(place[held] @ pivots.T, axis=1)
            order = np.argsort(nearest, kind="stable")
            held = held[order]
            begins = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        asked = self.block.asked[column]
        if not len(held):
            return held, begins, np.zeros((0, len(asked)), dtype=np.int64)
        return held, begins, np.maximum.reduceat(self.impacts[np.ix_(held, asked)], begins, axis=0)

    def search(self, item: int, k: int, floor: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with all of the k best that reach ``floor``; ``sizes`` tells how
        many rows a document stands for."""
        columns, times = self.block.items[item]
        tops = np.array([self.lists[c][2][:, np.searchsorted(self.block.asked[c], c)].max(initial=0)
                         for c in columns.tolist()], dtype=np.int64) * times
        seen = np.zeros(len(self.impacts), dtype=bool)
        best = np.zeros(0, dtype=np.int64)
        found, scores = [], []
        order = np.argsort(-tops, kind="stable")
        rest = int(tops.sum())
        for i in order.tolist():
            if rest < floor or rest == 0:
                break
            rest -= int(tops[i])
            held, begins, summary = self.lists[columns[i]]
            asked = self.block.asked[columns[i]]
            bounds = summary[:, np.searchsorted(asked, columns)] @ times
            ends = np.append(begins[1:], len(held))
            for j in np.argsort(-bounds, kind="stable").tolist():
                if bounds[j] < floor or bounds[j] == 0:
                    break
                docs = held[begins[j]:ends[j]]
                docs = docs[~seen[docs]]
                seen[docs] = True
                got = self.impacts[np.ix_(docs, columns)] @ times
                good = got >= max(floor, 1)
                if good.any():
                    found.append(docs[good])
                    scores.append(got[good])
                    best = np.sort(np.concatenate((best, np.repeat(got[good], sizes[docs[good]]))))[-k:]
                    if len(best) == k:
                        floor = max(floor, int(best[0]))
        if not found:
            return np.zeros(0, dtype=np.int64), best
        docs, got = np.concatenate(found), np.concatenate(scores)
        return docs[got >= floor], got[got >= floor]


def _key(found: tuple[int, object]):
    """Highest score first, then null ids, then the smaller id."""
    score, name = found
    return (-score, name is not None, 0 if name is None else name)


class Best:
    """The k best rows of every item that a task has met."""

    def __init__(self, block: Block, weights: Weights, k: int, floors: dict[int, int]):
        self.block, self.weights, self.k = block, weights, k
        self.floors = [floors.get(name, 0) for name in block.names]
        self.best: list[list[tuple[int, object]]] = [[] for _ in block.names]
        self.room = max(1, CELLS // max(1, len(block.terms)))
        self.held: dict[tuple, list] = {}

    def add(self, name: object, n: int, terms: np.ndarray, tfs: np.ndarray) -> None:
        columns = self.block.column[terms]
        mine = columns >= 0
        if mine.any():
            key = (n, columns[mine].tobytes(), tfs[mine].tobytes())
            self.held.setdefault(key, []).append(name)
            if len(self.held) >= self.room:
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        impacts = np.zeros((len(self.held), len(self.block.terms)), dtype=np.int64)
        names = []
        for i, ((n, columns, tfs), rows) in enumerate(self.held.items()):
            columns = np.frombuffer(columns, dtype=np.int64)
            impacts[i, columns] = self.weights.impacts(n, self.block.terms[columns], np.frombuffer(tfs, dtype=np.int64))
            # of rows with one vector only the k smallest ids can be among the k best
            names.append(sorted(rows, key=lambda r: _key((0, r)))[:self.k])
        self.held = {}
        sizes = np.array([len(r) for r in names])
        shard = Shard(self.block, impacts)
        for i in range(len(self.best)):
            docs, scores = shard.search(i, self.k, self.floors[i], sizes)
            if len(docs):
                rows = [(s, r) for d, s in zip(docs.tolist(), scores.tolist()) for r in names[d]]
                self.best[i] = sorted(self.best[i] + rows, key=_key)[:self.k]
                if len(self.best[i]) == self.k:
                    self.floors[i] = max(self.floors[i], self.best[i][-1][0])

    def rows(self) -> list[tuple[int, int, object]]:
        self.flush()
        return [(name, s, r) for name, best in zip(self.block.names, self.best) for s, r in best]


def search_block(rows: DataFrame, block: Block, weights: Weights, k: int, floors: dict[int, int]) -> DataFrame:
    """(item, score, id): the k best rows of every item, ranked."""
    field = rows.schema["id"]
    shared = rows.sparkSession.sparkContext.broadcast((block, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights, floors = shared.value
        best, kind = Best(block, weights, k, floors), None
        for b in batches:
            kind = b.column(0).type
            terms, tfs = b.column(2), b.column(3)
            ends, flat, times = (terms.offsets.to_numpy(), terms.values.to_numpy(), tfs.values.to_numpy())
            for name, n, begin, end in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), ends, ends[1:]):
                best.add(name, n, flat[begin:end], times[begin:end])
        if kind is not None:
            out = best.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], kind)], names=["item", "score", "id"])

    found = rows.select("id", "n", "terms", "tfs").mapInArrow(
        run, f"item long, score long, id {field.dataType.simpleString()}")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def _blocks(items: list[tuple[int, str]], vocabulary: dict[bytes, int]) -> Iterator[list]:
    """Items as counts of term numbers, in lists of about ``BLOCK_BYTES`` of text."""
    held, size = [], 0
    for name, text in items:
        counts = term_counts(text)
        if counts:
            held.append((name, {vocabulary.setdefault(w, len(vocabulary)): c for w, c in counts.items()}))
            size += len(text)
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", k: int = TOP) -> DataFrame:
    """item id, rank, document id, score: the k best documents of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")
    asked = scratch.write(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
                          .withColumn("item", F.monotonically_increasing_id()), "items")
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_groups = max(1, -(-total // GROUP_BYTES))
    group = F.pmod(F.xxhash64("item"), F.lit(n_groups))
    results = []
    for g in range(n_groups):
        vocabulary: dict[bytes, int] = {}
        texts = asked.filter((group == g) & F.col("text").isNotNull()).select("item", "text").collect()
        blocks = list(_blocks([(r.item, r.text) for r in sorted(texts)], vocabulary))
        if not blocks:
            continue
        rows = scratch.write(vectors(docs, vocabulary, id_col, text_col), f"vectors-{g}")
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        dfs = {r.term: r.df for r in rows.select(F.explode("terms").alias("term")).groupBy("term")
               .agg(F.count("*").alias("df")).collect()}
        if not dfs:
            continue
        weights = Weights(n_docs, n_terms, dfs, len(vocabulary))
        for i, held in enumerate(blocks):
            block = Block(held, len(vocabulary))
            first = search_block(rows.filter(F.pmod(F.xxhash64("id", "n", "terms"), F.lit(FIRST_SHARE)) == 0),
                                 block, weights, k, {})
            floors = {r.item: r.score for r in first.filter(F.col("rank") == k).collect()}
            results.append(scratch.write(search_block(rows, block, weights, k, floors), f"best-{g}-{i}"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = spark.createDataFrame([], f"item long, score long, id {kind}, rank int")
    for some in results:
        found = found.unionByName(some)
    return found.join(asked.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias(id_col), "score")
