"""Language identification (operator 5).

Sparse multinomial logistic regression on TF-IDF weights of hashed character n-grams (1 to
3 characters), trained by follow-the-regularised-leader (FTRL-proximal) with elastic-net
penalties and calibrated by a temperature.

Document frequencies are counted over every training row.  The regression itself is fitted
on a bounded sample of training rows (``SAMPLE_ROWS``, chosen by a hash of the id), a fifth
of which only sets the temperature.  Prediction reads whole texts: long ones are counted
chunk by chunk.

A text in a language outside the learned ones still gets one of them.  ``rarity`` tells it apart:
the mean inverse document frequency of its n-grams, each occurrence counted.  A learned language
spends most of its occurrences on n-grams that most training texts hold; foreign text falls on
buckets as they come.  The largest rarity of the calibration rows, and as much again as it lies
above their median, is the bound ``foreign``; it follows from shares and not from the number of
rows, so it is alike at every size.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every
text when no training row has a language.  Very long texts are read whole; of equal
probabilities the language that comes first by name is taken.  Rows with a null language train nothing; rows
with a null id are never held out.  Repeated rows keep their rows; extra columns are
ignored by ``identify`` and never reach the model.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_CHARS, holdout, map_arrow

BITS = 14
SAMPLE_ROWS = 4_000
EPOCHS = 3
# Odd multipliers of the n-gram hash.
MULTIPLIERS = (2654435761, 2246822519, 3266489917)
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def ngram_buckets(text: str) -> np.ndarray:
    """Hash buckets of all 1- to 3-grams of lower-cased letters, other runs as one space."""
    c = np.frombuffer(_NOT_LETTERS.sub(" ", text.lower()).encode("utf-32-le", "surrogatepass"),
                      dtype="<u4")
    if not len(c):
        return np.zeros(0, dtype=np.int64)
    m1, m2, m3 = (np.uint32(m) for m in MULTIPLIERS)
    one = c * m1
    two = (one[:-1] ^ (c[1:] + np.uint32(1))) * m2
    three = (two[:-1] ^ (c[2:] + np.uint32(1))) * m3
    shift = np.uint32(32 - BITS)
    return np.concatenate([one >> shift, two >> shift, three >> shift]).astype(np.int64)


def term_counts(text: str) -> np.ndarray:
    """Counts per bucket of a whole text."""
    counts = np.zeros(1 << BITS, dtype=np.int64)
    # chunks overlap by two characters; what an overlap counts twice is taken off again
    for at in range(0, max(len(text), 1), CHUNK_CHARS):
        part = text[at:at + CHUNK_CHARS + (2 if at + CHUNK_CHARS < len(text) else 0)]
        counts += np.bincount(ngram_buckets(part), minlength=1 << BITS)
        if at:
            counts -= np.bincount(ngram_buckets(text[at:at + 2]), minlength=1 << BITS)
    return counts


def weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and TF-IDF values (sublinear, unit length) of a document."""
    at = np.flatnonzero(counts)
    v = (1.0 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(v @ v)
    return at, v / norm if norm else v


def rarity(counts: np.ndarray, idf: np.ndarray) -> float:
    """Mean inverse document frequency of the n-grams of a text (0 without any)."""
    total = counts.sum()
    return float(counts @ idf) / float(total) if total else 0.0


def document_frequencies(training: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Rows that hold each bucket, and the row count, over all of ``training``."""

    def run(batches):
        held, rows = np.zeros(1 << BITS, dtype=np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                held += term_counts(t or "") > 0
                rows += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(held[at], rows), pa.int64())],
            names=["bucket", "docs"])

    found = (training.select(text_col).mapInArrow(run, "bucket long, docs long")
             .groupBy("bucket").agg(F.sum("docs").alias("docs")).toPandas())
    df = np.zeros((1 << BITS) + 1, dtype=np.float64)
    df[found["bucket"].to_numpy(dtype=np.int64)] = found["docs"].to_numpy(dtype=np.float64)
    return df[:-1], int(df[-1])


@dataclass
class Ftrl:
    """FTRL-proximal for a multinomial logit with L1 and L2 penalties."""

    classes: int
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-5

    def __post_init__(self) -> None:
        self.z = np.zeros(((1 << BITS) + 1, self.classes))
        self.n = np.zeros_like(self.z)

    def rows(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        at, v = np.append(at, 1 << BITS), np.append(v, 1.0)  # the last row is the bias
        w = self.rows(at)
        p = softmax(v @ w)
        p[label] -= 1.0
        g = v[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    matrix: np.ndarray  # the last row is the bias
    temperature: float = 1.0
    foreign: float = np.inf

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, v = weights(counts, self.idf)
        return v @ self.matrix[at] + self.matrix[-1]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its probability, and the text's rarity."""
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        counts = term_counts(text)
        p = softmax(self.logits(counts) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k]), rarity(counts, self.idf)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search in its log."""
    def loss(t: float) -> float:
        return -float(np.mean(np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12)))

    lo, hi, ratio = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train: Column | None = None, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from the rows of ``docs`` where ``train`` holds and the language is known."""
    known = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    training = docs.filter(known & (train if train is not None else F.lit(True)))
    df, total = document_frequencies(training, text_col)
    if not total:
        return Model([], df, np.zeros((1, 0)))
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    order = F.xxhash64(F.col(id_col).cast("string"), F.col(lang_col))
    picked = (training.filter(F.pmod(order, F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / total)))
              .select(order.alias("at"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            counts = [term_counts(t or "") for t in b.column(2).to_pylist()]
            found = [weights(c, idf) for c in counts]
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                 pa.array([rarity(c, idf) for c in counts], pa.float64())],
                names=["at", "lang", "buckets", "values", "rarity"])
        return fn

    sample = map_arrow(picked, make, "at long, lang string, buckets binary, values binary, rarity double")
    data = sorted(sample.collect())
    languages = sorted({r["lang"] for r in data})
    if not languages:
        return Model([], idf, np.zeros((1, 0)))
    x = [(np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["values"], "<f4"))
         for r in data]
    y = np.array([languages.index(r["lang"]) for r in data])
    holds = np.arange(len(y)) % 5 == 4  # rows are in hash order
    learner, rng = Ftrl(len(languages)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(np.flatnonzero(~holds)):
            learner.step(*x[i], y[i])
    model = Model(languages, idf, learner.rows(np.arange((1 << BITS) + 1)))
    rare = np.array([r["rarity"] for r in data])[holds if holds.any() else slice(None)]
    model.foreign = float(2 * rare.max() - np.median(rare))
    if holds.any() and len(languages) > 1:
        logits = np.array([v @ model.matrix[a] + model.matrix[-1]
                           for (a, v), h in zip(x, holds) if h])
        model.temperature = _temperature(logits, y[holds])
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
             lang_out: str = "lang_pred", score_out: str = "score", rarity_out: str | None = None) -> DataFrame:
    """The columns ``keep`` (all by default; those named like an output go), the predicted
    language and its calibrated probability; ``rarity_out``, if given, its text's rarity (0 where
    the language is unknown)."""
    kept = [c for c in keep or docs.columns if c not in (lang_out, score_out, rarity_out)]
    schema = docs.select(*kept).schema.add(lang_out, "string").add(score_out, "double")
    if rarity_out:
        schema = schema.add(rarity_out, "double")
    n = len(kept)

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.predict(t) for t in b.column(n).to_pylist()]
            more, names = [], [*b.schema.names[:n], lang_out, score_out]
            if rarity_out:
                more = [pa.array([x for _, _, x in found], pa.float64())]
                names.append(rarity_out)
            return pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([x for x, _, _ in found], pa.string()),
                 pa.array([p for _, p, _ in found], pa.float64()), *more], names=names)
        return fn

    return map_arrow(docs.select(*kept, F.col(text_col).alias("text to read")), make, schema)


def train_rows(id_col: str = "doc_id", mod: int = 4, rest: int = 2) -> Column:
    return ~holdout(id_col, mod, rest)
