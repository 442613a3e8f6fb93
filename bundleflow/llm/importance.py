"""Target-distribution importance resampling over hashed n-grams (operator 11).

A 256-byte table lower-cases A-Z and blanks every ASCII byte that is no letter or digit in the
UTF-8 of a text, so ``bytes.split`` yields its words.  A feature is a run of 1 to ``n`` words
joined by one space; its crc32 continues the crc32 of the run that is one word shorter, and its
bucket is that number modulo ``BUCKETS``.  Counters reduce the features of each stretch of text,
tasks add up buckets, and Spark sums at most ``BUCKETS`` rows per task.

A bucket's gain is 1000 times the logarithm of its add-one share among the target's features over
that among the source's, floored.  A document's weight is the sum of its features' gains; a Gumbel
draw from a hash of its id is added, and the highest scores are drawn without replacement.  Ranks
come from one range sort of narrow rows with offsets per partition: no text is shuffled and no
row passes through the driver or a single task.

Very long texts are taken in stretches of ``common.STRETCH`` bytes that end at blanks; runs go on from
one stretch to the next, so a task holds the words of one stretch only.

Defined results: null and empty texts have no features and weight 0; a null id is hashed as the
empty string and comes first among equal scores; repeated rows keep their rows and take ranks of
their own (which of two equal rows gets the smaller one is open); an empty target or source has
no features, so the gains follow from the added ones alone; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, number_in_order, strings, word_stretches

BUCKETS = 10_000
LONGEST_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
# Words whose buckets a task remembers.
CACHE = 1 << 18

class Features:
    """Counts the features of whole texts by bucket."""

    def __init__(self, longest: int = LONGEST_RUN, buckets: int = BUCKETS):
        self.longest, self.buckets = longest, buckets
        self.known: dict[bytes, int] = {}

    def _bucket(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[word] = zlib.crc32(word) % self.buckets
        return found

    def count(self, text: str) -> tuple[int, Counter]:
        """(number of words, features by bucket)."""
        n_words, found, ending = 0, Counter(), []
        for words in word_stretches(text):
            n_words += len(words)
            if self.longest == 1:
                for word, times in Counter(words).items():
                    found[self._bucket(word)] += times
                continue
            runs: Counter = Counter()
            for word in words:
                # crc32 of the runs of 1, 2, ... words that end here, from those that ended before
                more = b" " + word
                ending = [zlib.crc32(word), *(zlib.crc32(more, c) for c in ending[:self.longest - 1])]
                runs.update(ending)
            for crc, times in runs.items():
                found[crc % self.buckets] += times
        return n_words, found


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = LONGEST_RUN,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; buckets without features have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for text in strings(b.column(0)):
                for bucket, times in features.count(text)[1].items():
                    total[bucket] += times
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return (docs.select(text_col).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, from the (bucket, n) of both sides; ``buckets`` numbers in all."""
    all_s, all_t = (side.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for side in (source, target))
    rows = (source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
            .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
            .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0)
            .selectExpr("bucket", f"cast(floor(1000 * ln((t + 1D) * {all_s + buckets}D / "
                                  f"((s + 1D) * {all_t + buckets}D))) as long) AS gain").collect())
    found = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        found[r.bucket] = r.gain
    return found


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          longest: int = LONGEST_RUN) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def make():
        gain = shared.value
        features = Features(longest, len(gain))

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in strings(b.column(1)):
                n_words, found = features.count(text)
                out.append((n_words, found.total(), sum(int(gain[k]) * n for k, n in found.items())))
            return pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in out], pa.int64()) for i in range(3))],
                names=["id", "n_words", "n_features", "weight"])
        return fn

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), make,
                     f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: str) -> Column:
    """1000 times a Gumbel draw, floored, from the first 32 bits of a hash of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """id, n_features, weight, score, rank of every row; rank is null for rows not drawn."""
    scratch = Scratch(docs.sparkSession, "importance")
    gain = gains(scratch.write(bucket_counts(docs, text_col, longest, buckets), "source"),
                 scratch.write(bucket_counts(target, target_text, longest, buckets), "target"), buckets)
    rows = scratch.write(weigh(docs, gain, id_col, text_col, longest).select(
        "id", "n_features", "weight", (F.col("weight") + gumbel("id", seed)).alias("score"),
        (F.col("n_words") >= min_words).alias("able")), "weighed")
    drawn = rows.filter("able").count() * percent // 100
    placed = number_in_order(rows, [F.desc("able"), F.desc("score"), F.asc_nulls_first("id")])
    # rows that may not be drawn come last, so numbers below ``drawn`` are ranks
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                         F.when(F.col("n") < drawn, F.col("n") + 1).alias("rank"))
