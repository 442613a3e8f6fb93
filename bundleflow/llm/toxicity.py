"""Toxicity by Levenshtein automata over a lexicon trie (operator 1).

The lexicon is learned from labelled rows: words, and stems shared by several words, that
toxic rows hold and clean rows do not.  It is kept as a trie.  The Levenshtein automaton of
the lexicon is intersected with the trie and determinised lazily: a state is the set of
(trie node, edits so far), transitions are remembered, so that a token costs one lookup per
character until no entry can match any more.  Short entries must match exactly, longer ones
within one or two edits; tokens that clean rows hold are never taken for a misspelling.

Each hit is read in its context window: between quotation marks, or next to a word of
reporting, it counts as quoted, otherwise as abuse.  A logistic model over the counts and
their density gives the score.

Lexicon and model are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, by a hash
of the id; rows that share their least shingle hash count once); scoring reads whole texts.

Defined results: null and empty texts have no hits and get the score of a text without hits;
very long texts and tokens are read whole; of several matches of a token the one of fewest edits
counts, and equal scores stay equal;
without labels of both kinds the lexicon is empty; null labels and null ids train nothing;
repeated rows keep their rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, strings
from .neardup import WordHashes, shingle_set

SAMPLE_ROWS = 20_000
MIN_DOCS = 3  # and more where so many rows of one kind could be chance
MAX_CLEAN_SHARE = 0.01
STEM_LENGTHS = range(4, 9)
STEM_WORDS = 3
WINDOW = 8
TOKEN_CACHE = 200_000
STATES = 100_000
# Longer tokens are matched whole like all others, but not remembered.
KEPT_TOKEN = 64
PUNCTUATION = " \t.,;:!?\"'()[]{}<>|*#$%&-_=+~`/\\“”«»„‚‘’…"
QUOTES = "\"“”«»„"
# Words that report speech.
REPORTING = frozenset("said says called quote quoted wrote word words term insult slur".split())
# Prior of the logistic model (bias, abuse, misspelt, quoted, density) and its strength.
PRIOR, RIDGE = np.array([-4.0, 4.0, 2.0, 0.5, 0.5]), 0.05


def edits_allowed(length: int, stem: bool) -> int:
    if stem:
        return 1 if length >= 7 else 0
    return 0 if length < 5 else 1 if length < 9 else 2


class LexiconAutomaton:
    """Matches tokens against words and stems within their allowed edits."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_edits, self.stem_edits, self.reach = [-1], [-1], [-1]
        for w, stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            allowed, node = edits_allowed(len(w), stem), 0
            self.reach[0] = max(self.reach[0], allowed)
            for c in w:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word_edits.append(-1)
                    self.stem_edits.append(-1)
                    self.reach.append(-1)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], allowed)  # most edits of any entry below
            target = self.stem_edits if stem else self.word_edits
            target[node] = max(target[node], allowed)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.end: list[int] = []
        self.stem_hit: list[int] = []
        self.dead = self._state({})
        self.start = self._state({0: 0} if self.reach[0] >= 0 else {})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state, closed under leaving out trie characters (one edit each)."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e < self.reach[child] and nodes.get(child, 99) > e + 1:
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(nodes.items())
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.step.append({})
            self.end.append(min([e for n, e in key if e <= self.word_edits[n]], default=-1))
            self.stem_hit.append(min([e for n, e in key if e <= self.stem_edits[n]], default=-1))
        return self.known[key]

    def _next(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for node, e in self.states[state]:
            for char, child in self.children[node].items():
                cost = e + (char != c)
                if cost <= self.reach[child] and nodes.get(child, 99) > cost:
                    nodes[child] = cost
            if e < self.reach[node] and nodes.get(node, 99) > e + 1:
                nodes[node] = e + 1  # the token has a character more
        out = self.step[state][c] = self._state(nodes)
        return out

    def distance(self, token: str) -> int:
        """Fewest edits to an entry within its allowance, -1 if there is none."""
        if len(self.states) > STATES:
            self._forget()
        state, best = self.start, -1
        for c in token:
            state = self.step[state].get(c, -1) if c in self.step[state] else self._next(state, c)
            if state == self.dead:
                return best
            hit = self.stem_hit[state]
            if hit >= 0 and (best < 0 or hit < best):
                best = hit
        hit = self.end[state]
        return hit if hit >= 0 and (best < 0 or hit < best) else best


def clean_token(raw: str) -> str:
    return raw.strip(PUNCTUATION)


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    spared: frozenset[str] = frozenset()  # clean tokens close to an entry
    coef: np.ndarray = field(default_factory=lambda: PRIOR.copy())


class Scorer:
    """Features and scores of texts; remembers tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = LexiconAutomaton(model.words, model.stems)
        scorer = self

        class Tokens(dict):
            def __missing__(self, raw: str) -> int:
                code = scorer._code(raw)
                if len(raw) <= KEPT_TOKEN:
                    if len(self) >= TOKEN_CACHE:
                        self.clear()
                    self[raw] = code
                return code

        self.tokens = Tokens()

    def _code(self, raw: str) -> int:
        """0: no hit, 1: an entry itself, 2: a misspelt one."""
        token = clean_token(raw)
        d = self.automaton.distance(token)
        return 0 if d < 0 or (d and token in self.model.spared) else 1 if d == 0 else 2

    def features(self, text: str) -> np.ndarray:
        raw = text.lower().split()
        codes = np.fromiter(map(self.tokens.__getitem__, raw), dtype=np.int8, count=len(raw))
        abuse = misspelt = quoted = 0
        for i in np.flatnonzero(codes).tolist():
            if is_quoted(raw, i):
                quoted += 1
            elif codes[i] == 1:
                abuse += 1
            else:
                misspelt += 1
        return np.array([1.0, np.log1p(abuse), np.log1p(misspelt), np.log1p(quoted),
                         np.log1p(100.0 * (abuse + misspelt) / max(len(raw), 1))])

    def score(self, text: str) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.features(text) @ self.model.coef, -40, 40))))


def is_quoted(raw: list[str], i: int) -> bool:
    """The hit at ``i`` stands between quotation marks or next to a word of reporting."""
    before, after = raw[max(0, i - WINDOW):i + 1], raw[i:i + WINDOW + 1]
    opened = any(t[0] in QUOTES for t in before)
    closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in after)
    return (opened and closed) or any(clean_token(t) in REPORTING for t in raw[max(0, i - 3):i + 4])


def _terms(text: str) -> tuple[set[str], dict[str, set[str]]]:
    words = {t for t in map(clean_token, set(text.lower().split())) if len(t) > 2}
    stems: dict[str, set[str]] = defaultdict(set)
    for w in words:
        for n in STEM_LENGTHS:
            if len(w) > n:
                stems[w[:n]].add(w)
    return words, stems


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            train: Column, rows: int, scratch: Scratch) -> DataFrame:
    """(toxic, text) of at most about ``rows`` labelled training rows, near copies once."""
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(
        F.col(id_col).alias("label id")).agg((F.max(label_col) == 1).alias("toxic"))
    total = marked.count()
    bucket = F.pmod(F.xxhash64("label id"), F.lit(1_000_000))
    chosen = marked.filter(bucket < int(1_000_000 * min(1.0, rows / max(total, 1))))
    texts = (docs.join(F.broadcast(chosen), docs[id_col] == F.col("label id"))
             .select("label id", "toxic", F.coalesce(docs[text_col], F.lit("")).alias("text")))

    def make():
        hashes = WordHashes()

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            least = [int(s[0]) >> 1 if len(s := shingle_set(t, hashes)) else 0
                     for t in b.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.int64())],
                                              names=["id", "toxic", "text", "least"])
        return fn

    one = map_arrow(texts, make, f"id {labels.schema[id_col].dataType.simpleString()}, "
                                 "toxic boolean, text string, least long")
    return scratch.write(one.groupBy("toxic", "least").agg(F.min_by("text", "id").alias("text")), "sample")


def learn_lexicon(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that enough toxic and almost no clean sample rows hold.

    Enough: so many that less than half a term of all candidates would be expected to
    stand in toxic rows only by chance.
    """

    def count(wanted: frozenset[str] | None):
        def make():
            def fn(b: pa.RecordBatch) -> pa.RecordBatch:
                seen: Counter = Counter()
                types: dict[str, set[str]] = defaultdict(set)
                for t in strings(b.column(0)):
                    words, stems = _terms(t)
                    found = [f"={w}" for w in words] + [f"^{s}" for s in stems]
                    seen.update(f for f in found if wanted is None or f in wanted)
                    if wanted is None:
                        for s, ws in stems.items():
                            types[f"^{s}"].update(list(ws)[:STEM_WORDS])
                return pa.RecordBatch.from_arrays(
                    [pa.array(list(seen)), pa.array(list(seen.values()), pa.int64()),
                     pa.array([sorted(types.get(k, ()))[:STEM_WORDS] for k in seen],
                              pa.list_(pa.string()))],
                    names=["term", "docs", "types"])
            return fn
        return make

    schema = "term string, docs long, types array<string>"
    toxic = (map_arrow(sample.filter("toxic").select("text"), count(None), schema).groupBy("term")
             .agg(F.sum("docs").alias("docs"), F.size(F.array_distinct(F.flatten(F.collect_list("types")))).alias("types"))
             .filter((F.col("docs") >= MIN_DOCS)
                     & (F.col("term").startswith("=") | (F.col("types") >= STEM_WORDS))))
    held = {r["term"]: r["docs"] for r in toxic.collect()}  # bounded by the sample's size
    if not held:
        return [], []
    share = min(0.9, sample.filter("toxic").count() / max(sample.count(), 1))
    enough = max(MIN_DOCS, int(np.ceil(np.log(2 * len(held)) / -np.log(share))))
    held = {t: n for t, n in held.items() if n >= enough}
    wanted = frozenset(held)
    clean = {r["term"]: r["docs"] for r in map_arrow(
        sample.filter("NOT toxic").select("text"), count(wanted), schema)
        .groupBy("term").agg(F.sum("docs").alias("docs")).collect()}
    good = {t: n for t, n in held.items() if clean.get(t, 0) <= MAX_CLEAN_SHARE * n}
    stems = {t[1:]: n for t, n in good.items() if t[0] == "^"}
    # of nested stems the longest that holds as many rows, then none inside another
    stems = {s: n for s, n in stems.items()
             if not any(u != s and u.startswith(s) and stems[u] == n for u in stems)}
    kept: list[str] = []
    for s in sorted(stems, key=lambda s: (len(s), s)):
        if not any(s.startswith(k) for k in kept):
            kept.append(s)
    words = {t[1:]: n for t, n in good.items() if t[0] == "=" and not any(t[1:].startswith(k) for k in kept)}
    return sorted(words), sorted(kept, key=lambda s: (-stems[s], s))  # bounded by the sample


def _spared(sample: DataFrame, words: list[str], stems: list[str]) -> frozenset[str]:
    """Tokens of clean sample rows that are close to an entry."""
    def make():
        automaton, done = LexiconAutomaton(words, stems), set()

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            new = {t for x in strings(b.column(0)) for t in map(clean_token, set(x.lower().split()))} - done
            done.update(new)
            return pa.RecordBatch.from_arrays(
                [pa.array([t for t in new if automaton.distance(t) > 0], pa.string())], names=["token"])
        return fn

    found = map_arrow(sample.filter("NOT toxic").select("text"), make, "token string").distinct()
    return frozenset(r["token"] for r in found.collect())


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a Gaussian prior around ``PRIOR``, by Newton steps."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + RIDGE * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and weights from the labelled rows for which ``train`` (over the label's id) holds."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = _sample(docs, labels, id_col, text_col, label_col,
                     train if train is not None else F.lit(True), rows, scratch)
    words, stems = learn_lexicon(sample)
    model = Model(words, stems, _spared(sample, words, stems) if words or stems else frozenset())

    def make():
        scorer = Scorer(model)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [scorer.features(t).tobytes() for t in strings(b.column(1))]
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], names=["toxic", "x"])
        return fn

    found = map_arrow(sample.select("toxic", "text"), make, "toxic boolean, x binary").groupBy("toxic", "x").count().collect()
    y = np.array([r["toxic"] for r in found for _ in range(r["count"])], dtype=float)
    if len(y) and 0 < y.sum() < len(y):
        x = np.array([np.frombuffer(r["x"]) for r in found for _ in range(r["count"])])
        model.coef = _logistic(x, y)
    scratch.drop("sample")
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
          score_col: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default; one named like the score goes) and the score."""
    kept = [c for c in keep or docs.columns if c != score_col]
    n = len(kept)

    def make():
        scorer = Scorer(model)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([scorer.score(t) for t in strings(b.column(n))], pa.float64())],
                names=[*b.schema.names[:n], score_col])
        return fn

    return map_arrow(docs.select(*kept, F.col(text_col).alias("text to read")), make,
                     docs.select(*kept).schema.add(score_col, "double"))
