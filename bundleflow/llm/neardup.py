"""MinHash near-duplicate detection (operator 8).

Words are runs without ASCII white space, A-Z lower-cased; a document's set holds the hashes
of its distinct 5-word shingles.  Documents of equal sets form one class.  A class gets the
minima of many universal hash functions as its signature, cut into bands; classes that share
a band are candidates.  Candidates whose signatures agree well enough are confirmed on their
full shingle sets, and confirmed links become components by alternating large-star and
small-star.

A bucket (classes that share a band) is never expanded into all its pairs:

1. every member is compared with the bucket's least member (linear in the bucket);
2. in buckets whose members are still in several components, each straggler (a member
   outside the bucket's largest component) is compared with the members of other components
   in blocks of bounded size, and its most similar partners are confirmed;
3. the same again for all remaining pairs of different components whose signatures pass.

After the third step every pair that shares a band, passes the signature test and still lies
in two components was confirmed or refuted on full sets, so components are those of all
links, but for pairs that no band or no signature shows.  With 32 bands of 6 minima a pair at
similarity 0.85 shares none with probability 3e-7; the signature test keeps four standard
deviations below the threshold.

Defined results: rows without words are linked with nothing; component_id is the least id of
the component, null ids do not count, and kept is ``id <=> component_id``; very long texts are
hashed whole; repeated rows keep their rows (``drop_near_duplicates`` keeps one row of a group even
where ids are null or shared); ties go to the smaller hash; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, broadcast_if_small, map_arrow
from .components import components

SHINGLE = 5
WORD_CACHE = 150_000
BLOCK = 1024
BEST = 3
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Setting:
    """Similarity in percent, how signatures are cut into bands, and how many further minima
    only the signature test reads (the more, the fewer pairs go on to their full sets)."""

    percent: int = 85
    bands: int = 32
    rows: int = 6
    extra: int = 128

    @property
    def hashes(self) -> int:
        return self.bands * self.rows + self.extra

    @property
    def agreeing(self) -> int:
        """Least number of equal minima: four standard deviations below the threshold."""
        t = self.percent / 100
        return math.floor(self.hashes * (t - 4 * math.sqrt(t * (1 - t) / self.hashes)))


class WordHashes(dict):
    """64-bit hashes of words; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles (fewer words: of the whole sequence)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    span = min(n, k)
    h = np.full(n - span + 1, span, dtype=np.uint64)
    for j in range(span):
        h = h * _STEP + w[j:n - span + 1 + j]
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return np.unique(h ^ (h >> np.uint64(31)))


class Signer:
    """Minima of ``count`` universal hash functions (multiply-add-shift) of a shingle set."""

    def __init__(self, count: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, count, dtype=np.uint64)

    def sign(self, shingles: np.ndarray) -> bytes:
        # 32-bit keys, for which multiply-add-shift is 2-universal
        x = (shingles >> np.uint64(32)) ^ (shingles & np.uint64(0xFFFFFFFF))
        low = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(x), 256):
            h = x[at:at + 256, None] * self.a
            h += self.b
            np.minimum(low, h.min(axis=0), out=low)
        return (low >> np.uint64(48)).astype("<u2").tobytes()


def sketch(docs: DataFrame, id_col: str, text_col: str, setting: Setting) -> DataFrame:
    """id, n_shingles, node (hash of the set; null without words), text_key, sig per row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        hashes, signer = WordHashes(), Signer(setting.hashes)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            size, node, sig = [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t or "", hashes)
                size.append(len(s))
                node.append(_node(s) if len(s) else None)
                sig.append(signer.sign(s) if len(s) else None)
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()), b.column(2),
                 pa.array(sig, pa.binary())], names=["id", "n_shingles", "node", "text_key", "sig"])
        return fn

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key"))
    return map_arrow(rows, make, f"id {kind}, n_shingles long, node long, text_key long, sig binary")


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, id_col: str, text_col: str,
              scratch: Scratch, name: str) -> DataFrame:
    """(node, shingles) of the classes ``nodes``, from the text of one document of each."""
    source = scratch.write(classes.join(nodes, "node").select(
        F.col("src.text_key").alias("key"), F.col("src.id").alias("want")), f"{name}-source")
    source = broadcast_if_small(source, 16)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("text_key"))
    texts = texts.join(source, (texts["text_key"] == source["key"])
                       & texts["id"].eqNullSafe(source["want"]), "left_semi").select("text")

    def make():
        hashes = WordHashes()

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingle_set(t, hashes) for t in b.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in found], pa.int64()),
                 pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "shingles"])
        return fn

    # written first, so that the joins know its size
    return scratch.write(map_arrow(texts, make, "node long, shingles binary"), f"{name}-sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                union = np.concatenate([s, t])
                union.sort(kind="stable")
                common = int((union[1:] == union[:-1]).sum())
                keep.append(100 * common >= percent * (len(union) - common))
            return b.select(["a", "b"]).filter(pa.array(keep))
        return fn

    return map_arrow(both.select("a", "b", "sa", "sb"), make, "a long, b long").distinct()


def passing(pairs: DataFrame, classes: DataFrame, setting: Setting) -> DataFrame:
    """Pairs (a, b) whose signatures agree in enough minima."""
    sig = classes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("ga")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("gb")), "b"))

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<u2") for k in (2, 3))
            same = (x == y).reshape(-1, setting.hashes).sum(axis=1)
            return b.select(["a", "b"]).filter(pa.array(same >= setting.agreeing))
        return fn

    return map_arrow(both.select("a", "b", "ga", "gb"), make, "a long, b long")


def _relabel(labels: DataFrame | None, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Labels after ``links`` (a, b) are added to the components of ``labels``."""
    if labels is None:
        return scratch.write(components(links, scratch, name), f"{name}-labels")
    named = links
    for end in ("a", "b"):
        named = (named.join(labels.select(F.col("node").alias(end), F.col("label").alias("l")), end, "left")
                 .withColumn(end, F.coalesce("l", end)).drop("l"))
    joined = components(named, scratch, name).select(F.col("node").alias("label"),
                                                     F.col("label").alias("to"))
    old = labels.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    new = joined.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(
        F.col("label").alias("node"), F.col("to").alias("label"))
    return scratch.write(old.union(new), f"{name}-labels")


def stragglers(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the buckets with several components, cut into blocks: (key, i, j, band, node,
    label, role, sig), where role 0 is to be compared with role 1.  Members of the largest
    component are never compared with each other."""
    rows = (members.filter("size > 2 AND node <> star").select("key", "band", "node")
            .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    per = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    buckets = (per.groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.max("n").alias("most"),
        F.sum("n").alias("all")).filter("most < all")
        .select("key", "main", F.expr(f"(all - most - 1) div {BLOCK} + 1").alias("ni"),
                F.expr(f"(all - 1) div {BLOCK} + 1").alias("nj")))
    rows = rows.join(buckets, "key").join(classes.select("node", "sig"), "node")
    base = ["key", "band", "node", "label", "sig"]
    away = F.col("label") != F.col("main")
    i, j = F.pmod(F.xxhash64("node", F.lit(1)), "ni"), F.pmod(F.xxhash64("node", F.lit(2)), "nj")
    cells = F.concat(
        F.when(away, F.transform(F.sequence(F.lit(0).cast("long"), F.col("nj") - 1), lambda x: F.struct(
            i.alias("i"), x.alias("j"), F.lit(0).alias("role")))).otherwise(F.array()),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("ni") - 1), lambda x: F.struct(
            x.alias("i"), j.alias("j"), F.when(away, 2).otherwise(1).alias("role"))))
    return rows.select(*base, F.inline(cells))


def straggler_pairs(rows: DataFrame, setting: Setting, best: int | None) -> DataFrame:
    """Pairs of different components whose signatures pass; per straggler and block only the
    ``best`` most similar ones, or all (then only in the first band that a pair shares)."""
    h = setting.hashes

    def compare(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(group["role"] == 0), np.flatnonzero(group["role"] > 0)
        sig, node, label = group["sig"], group["node"], group["label"]
        a, b = [], []
        for s in left:
            # of two stragglers the smaller one asks
            open_ = right[(label[right] != label[s]) & ((group["role"][right] == 1) | (node[right] > node[s]))]
            if not len(open_):
                continue
            same = sig[open_] == sig[s]
            count = same.sum(axis=1)
            ok = np.flatnonzero(count >= setting.agreeing)
            if best is not None:
                ok = ok[np.lexsort((node[open_[ok]], -count[ok]))[:best]]
            elif len(ok):
                shared = same[ok, :setting.bands * setting.rows].reshape(
                    len(ok), setting.bands, setting.rows).all(axis=2)
                ok = ok[shared.argmax(axis=1) == group["band"][s]]
            a.append(np.full(len(ok), node[s]))
            b.append(node[open_[ok]])
        return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2

    def run(batches):
        names = ("key", "i", "j", "band", "node", "label", "role")
        rest: dict[str, np.ndarray] | None = None

        def emit(part):
            cut = np.flatnonzero((part["key"][1:] != part["key"][:-1]) | (part["i"][1:] != part["i"][:-1])
                                 | (part["j"][1:] != part["j"][:-1])) + 1
            found = [compare({k: v[x:y] for k, v in part.items()})
                     for x, y in zip([0, *cut], [*cut, len(part["key"])])]
            x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))],
                                              names=["a", "b"])

        for batch in batches:
            now = {n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(names)}
            now["sig"] = np.frombuffer(b"".join(batch.column(7).to_pylist()), "<u2").reshape(-1, h)
            if rest is not None:
                now = {k: np.concatenate([rest[k], v]) for k, v in now.items()}
            # rows are sorted: the last group may go on in the next batch
            last = ((now["key"] == now["key"][-1]) & (now["i"] == now["i"][-1])
                    & (now["j"] == now["j"][-1]))
            if not last.all():
                yield emit({k: v[~last] for k, v in now.items()})
            rest = {k: v[last] for k, v in now.items()}
        if rest is not None:
            yield emit(rest)

    cells = (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .select("key", "i", "j", "band", "node", "label", "role", "sig"))
    return cells.mapInArrow(run, "a long, b long").distinct()


def judged_rows(docs: DataFrame, id_col: str, text_col: str, setting: Setting,
                scratch: Scratch) -> DataFrame:
    """id, n_shingles, text_key, component_id, kept, survivor for every row.

    ``survivor`` names one text of each component: the least (id, text_key), null ids last; rows
    without words are survivors each."""
    rows = scratch.write(sketch(docs, id_col, text_col, setting), "sketch")
    classes = scratch.write(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.min(F.struct("text_key", "id")).alias("src"), F.first("sig").alias("sig")), "classes")
    width = 2 * setting.rows
    entries = classes.select("node", F.explode(F.sequence(F.lit(0), F.lit(setting.bands - 1))).alias("band"), "sig")
    entries = entries.select(F.expr(f"xxhash64(substring(sig, band * {width} + 1, {width}), band)").alias("key"),
                             "band", "node")
    buckets = (entries.groupBy("key").agg(F.min("node").alias("star"), F.count("*").alias("size"))
               .filter("size > 1"))
    members = scratch.write(entries.join(buckets, "key"), "members")

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.write(pairs, f"{name}-pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = full_sets(docs, classes, nodes, id_col, text_col, scratch, name)
        # several documents can have been read for a class (repeated rows)
        links = scratch.write(confirm(pairs, sets.dropDuplicates(["node"]), setting.percent), f"{name}-links")
        scratch.drop(f"{name}-pairs", f"{name}-sets", f"{name}-source")
        return links

    stars = members.filter("node <> star").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
    labels = _relabel(None, links_of(passing(stars, classes, setting), "stars"), scratch, "stars")
    for name, best in (("best", BEST), ("rest", None)):
        found = straggler_pairs(stragglers(members, labels, classes), setting, best)
        labels = _relabel(labels, links_of(found, name), scratch, name)

    placed = rows.select("id", "n_shingles", "text_key", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    # only components of several rows need their least id looked up
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_key")
    least = placed.filter("label IS NOT NULL").groupBy("label").agg(
        F.min("id").alias("component_id"), F.min(place).alias("first"))
    out = placed.join(least, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select("id", "n_shingles", "text_key", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
                      (F.col("label").isNull() | place.eqNullSafe(F.col("first"))).alias("survivor"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    setting: Setting = Setting()) -> DataFrame:
    """id, n_shingles, component_id, kept for every row."""
    rows = judged_rows(docs, id_col, text_col, setting, Scratch(docs.sparkSession, "neardup"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         setting: Setting = Setting()) -> DataFrame:
    """One row of every component (``survivor``), repeated rows (equal id and text) once.

    Rows are told apart by id and text hash; the lists of rows to leave out are narrow and
    broadcast only when they are small.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = scratch.write(judged_rows(docs, id_col, text_col, setting, scratch), "judged")

    def listed(found: DataFrame, name: str) -> DataFrame:
        return scratch.write(found.select(F.col("id").alias("listed id"), F.col("text_key").alias("listed key")), name)

    def same(few: DataFrame):
        return (F.xxhash64(docs[text_col]).eqNullSafe(few["listed key"])
                & docs[id_col].eqNullSafe(few["listed id"]))

    gone = broadcast_if_small(listed(rows.filter("NOT survivor").distinct(), "gone"), 24)
    out = docs.join(gone, same(gone), "left_anti")
    again = listed(rows.filter("survivor").groupBy("id", "text_key").count().filter("count > 1"), "again")
    if not again.count():
        return out
    again = broadcast_if_small(again, 24)
    once = docs.join(again, same(again), "left_semi").dropDuplicates([id_col, text_col])
    return out.join(again, same(again), "left_anti").unionByName(once)
