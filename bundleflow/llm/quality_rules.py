"""Quality rules: a decision list learned by sequential covering (operator 9).

``text_statistics`` measures every whole text.  ``learn_rules`` covers the low-quality rows
of labelled statistics one rule after another: a rule is a conjunction of threshold
conditions grown by FOIL gain on one part of the rows and pruned on the other; rows it
covers leave the pool, and covering ends when the next rule isn't precise enough on the
pruning part.  ``verdict_column`` turns the ordered list into one Spark CASE expression.

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, chosen by a
hash of the id); the statistics and the verdict cover every row.

Defined results: a null or empty text has no words (all counts 0); repeated rows keep their
rows and weigh once each in the sample; null labels are left out; without rows of both
classes the list is empty and keeps everything; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, strings

# Labelled rows that the rules are learned from, at most.
SAMPLE_ROWS = 20_000
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_PRECISION = 0.9
THRESHOLDS = 32

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_NO_WORD = re.compile(r"[\x20\x09-\x0D]*\Z")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    w = np.fromiter((codes.setdefault(x, len(codes)) for x in words), dtype=np.int64, count=n)
    if len(codes) == n:
        return 0
    # pair codes first, so that window codes stay below n * n
    pairs = np.unique(w[:-1] * len(codes) + w[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(codes) + w[2:], return_inverse=True,
                                 return_counts=True)
    twice = times[window] > 1
    held = np.zeros(n, dtype=bool)
    for k in range(3):
        held[k:n - 2 + k] |= twice
    return int(held.sum())


def statistics(text: str) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if _NO_WORD.match(line):
            continue
        lines += 1
        if line in seen:
            dup += 1
        else:
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            dup, repeated_words(words), lines, sum(map(str.isupper, text)),
            sum(map(text.count, "0123456789")), sum(map(text.count, "!?|")))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the counts of ``COUNTS`` of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = [statistics(t) for t in strings(b.column(1))]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, *COUNTS])
        return fn

    return map_arrow(docs.select(id_col, text_col), make,
                     f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


# Ratios that conditions compare with thresholds: (numerator, denominator).
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature_column(name: str) -> Column:
    top, below = FEATURES[name]
    return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v >= self.threshold if self.at_least else v <= self.threshold

    def column(self) -> Column:
        v = feature_column(self.feature)
        return v >= self.threshold if self.at_least else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _cuts(v: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Thresholds to try: halfway between the quantiles of the positive rows and the nearest
    other value, so that a condition keeps its distance from the rows it leaves out."""
    at = np.unique(np.quantile(v[y], np.linspace(0, 1, THRESHOLDS)))
    other = np.unique(v[~y])
    below = other[np.maximum(np.searchsorted(other, at, side="left") - 1, 0)]
    above = other[np.minimum(np.searchsorted(other, at, side="right"), len(other) - 1)]
    return np.unique(np.concatenate([at, (at + below) / 2, (at + above) / 2]))


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(y), dtype=bool)
    while len(rule) < MAX_CONDITIONS:
        p, n = int(y[inside].sum()), int((~y[inside]).sum())
        if not p or not n:
            break
        base, best = np.log2(p / (p + n)), (0.0, None)
        for name, v in x.items():
            cuts = _cuts(v[inside], y[inside])
            for cut in cuts:
                for at_least in (True, False):
                    c = Condition(name, at_least, float(cut))
                    keep = inside & c.holds(x)
                    tp, fp = int((keep & y).sum()), int((keep & ~y).sum())
                    if tp and (gain := tp * (np.log2(tp / (tp + fp)) - base)) > best[0] + 1e-9:
                        best = (gain, c)
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return tuple(rule)


def _worth(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> float:
    """Laplace precision of the rule, the measure of pruning."""
    hit = _covered(rule, x, len(y))
    return (int((hit & y).sum()) + 1) / (int(hit.sum()) + 2)


def learn_rules(x: dict[str, np.ndarray], low: np.ndarray, part: np.ndarray) -> list[Rule]:
    """The ordered list; ``part`` marks the rows of the pruning part."""
    rules: list[Rule] = []
    left = np.ones(len(low), dtype=bool)
    take = lambda m: ({k: v[m] for k, v in x.items()}, low[m])
    while len(rules) < MAX_RULES:
        grow_x, grow_y = take(left & ~part)
        prune_x, prune_y = take(left & part)
        if grow_y.sum() < 5 or prune_y.sum() < 2:
            break
        rule = _grow(grow_x, grow_y)
        while len(rule) > 1 and _worth(rule[:-1], prune_x, prune_y) >= _worth(rule, prune_x, prune_y):
            rule = rule[:-1]
        if not rule or _worth(rule, prune_x, prune_y) < MIN_PRECISION:
            break
        hit = _covered(rule, x, len(low)) & left
        if not hit[low].any():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict_column(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that a row meets, null if none."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
        label_col: str = "quality", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from at most about ``rows`` labelled rows; label 0 is low quality."""
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) == 0).alias("low")).dropDuplicates(["id"])
    total = marked.count()
    bucket = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = marked.filter(bucket < int(1_000_000 * min(1.0, rows / max(total, 1))))
    found = (stats.join(F.broadcast(chosen), stats[id_col] == chosen["id"])
             .select(F.xxhash64("id").alias("at"), "low",
                     *[feature_column(f).alias(f) for f in FEATURES]).orderBy("at").toPandas())
    if not len(found) or found["low"].nunique() < 2:
        return []
    x = {f: found[f].to_numpy(dtype=float) for f in FEATURES}
    at = found["at"].to_numpy()
    return learn_rules(x, found["low"].to_numpy(dtype=bool), (at >> 20) % 3 == 0)


def judge(stats: DataFrame, rules: Sequence[Rule], min_words: int = 50) -> DataFrame:
    """``stats`` with base_failed, rule (the first learned rule that a row meets) and kept."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (stats.withColumn("base_failed", failed).withColumn("rule", verdict_column(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))
