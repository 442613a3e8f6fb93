"""Personal data: fixed patterns plus bootstrapped contextual extraction (operator 4).

The base kinds (email, ip, card, phone) are found by their fixed patterns.  They also seed the
bootstrapping: the words and punctuation left and right of a seed, at several widths, are its
lexical patterns, and every value of an identifier's shape (a digit or ``@``, at least
``MIN_LENGTH`` characters, groups apart by one space as one value) is an instance of the patterns
around it.  Spark scores the bipartite graph of patterns and instances in rounds, until no further
instance is accepted: a pattern's confidence is the mean score of everything it extracts, each
occurrence counted, words that cannot be identifiers counting as zero; an instance's score combines
the confidences of its patterns (noisy or); seeds keep score one.  Instances that reach ``ACCEPT``
through patterns with at least ``MIN_SUPPORT`` different seeds or instances accepted before are new
spans of kind ``id``.

The graph holds identifier-shaped values only.  The other words are counted from the texts, and
only for patterns that can reach ``MIN_CONFIDENCE`` in the present round: first in a 64th of the
texts, then in an eighth, then in all.  A pattern with more words than instances cannot reach
``MIN_CONFIDENCE`` in any round (see ``able``); counts only grow, so it is left as soon as one of
the shares shows it, which common contexts do in the first.  A task gives one count per pattern, so
both the rows and the time grow with the texts.  Occurrences, not distinct words, are counted
because the share of identifiers among a context's occurrences is the same at every size, while
distinct words run out and identifiers do not.

Defined results: null and empty texts have no spans; very long texts and identifiers are read
whole (contexts lie within ``_WINDOW`` characters); offsets are code points, ends exclusive;
spans of the method never overlap each other (identifiers are read from left to right) or base
spans; equal scores are accepted alike; repeated rows keep their rows and count as often as they
occur, but support counts different values; an empty table gives an empty result; ``redact`` keeps
all columns and replaces each span (overlapping ones as one) by its kind in brackets.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, broadcast_if_small, map_arrow, strings

KINDS = ("email", "ip", "card", "phone")
METHOD_KIND = "id"
ACCEPT = 0.9
MIN_CONFIDENCE = 0.5
MIN_SUPPORT = 5
MIN_LENGTH = 6
WIDTH = 3
# Longer values stand in the graph by a digest.
NAMED = 64
# Patterns that one pass over the texts looks for, and the shares of the texts (one of so many).
PASS_PATTERNS = 200_000
SHARES = (64, 8, 1)

# The base patterns.  Each starts only where a match can start, which finds the
# same leftmost matches and stays linear on long runs.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# Scripts without spaces between words: each character is a word of its own.
_CJK = "\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af"
_CORE = re.compile(rf"[^\W{_CJK}]+(?:[-./@+][^\W{_CJK}]+)*")
# One value: groups that hold a digit may follow each other, a short group of capitals before or between.
_IDENT = re.compile(rf"(?:\b[A-Z]{{1,4}}\x20(?=[0-9]))?{_CORE.pattern}"
                    rf"(?:(?<=[0-9])\x20[A-Z]{{0,4}}[0-9][0-9A-Z-]*(?![^\W{_CJK}])|(?<=[0-9])\x20[A-Z]{{1,4}}\x20(?=[0-9]))*")
_SHAPED = re.compile(r"[\d@]")
_WORD = re.compile(rf"[{_CJK}]|[^\W{_CJK}]+")
_TOKEN = re.compile(rf"[{_CJK}]|[^\W{_CJK}]+|[^\w\x20\t\"']")
_DIGITS = re.compile(r"\d+")
_BLANK = re.compile(r"[\x20\t\"']*")
# Characters left and right of a value that its patterns may come from.  A window of them without a
# whole token holds such a run.
_WINDOW = 120
_RUN = re.compile(rf"\w{{{_WINDOW // 3}}}|[\x20\t\"']{{{_WINDOW // 3}}}")

Span = tuple[int, str, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and _LOCAL.match(text, begin - 1):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, "email", domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base kinds, by start, then kind as listed."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(p) <= 255 for p in m.group().split(".") if len(p.lstrip("0")) <= 3) and all(
                    len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
                out.append((m.start(), "ip", m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out.append((m.start(), "phone", m.end()))
    out.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return out


def _side(tokens: list[str]) -> tuple[list[str], str]:
    """Contexts of 1 to ``WIDTH`` words of one side, from the value outwards, punctuation between
    kept, and the nearest token."""
    out, held, words = [], [], 0
    for t in tokens:
        held.append(_plain(t))
        if t[0].isalnum() or t[0] == "_":
            words += 1
            out.append(" ".join(held))
            if words == WIDTH:
                break
    return out, held[0] if held else ""


def _plain(token: str) -> str:
    token = token.lower()
    return token if token.isalpha() else _DIGITS.sub("0", token)


def patterns_at(text: str, start: int, end: int) -> list[str]:
    """The patterns around a value: left and right contexts, both at once, or the marks it stands
    between.  A context is written from the value outwards; a token at the window's edge may be
    cut and is left out."""
    before = _TOKEN.findall(text, max(0, start - _WINDOW), start)[::-1]
    after = _TOKEN.findall(text, end, end + _WINDOW)
    if start > _WINDOW:
        before = before[:-1]
    if end + _WINDOW < len(text):
        after = after[:-1]
    (left, near_left), (right, near_right) = _side(before), _side(after)
    out = [f"< {c}" for c in left] + [f"> {c}" for c in right]
    if left and right:
        out.append(f"< {left[0]} > {right[0]}")
    if not any(m[:1].isalnum() or m[:1] == "_" for m in (near_left, near_right)):
        out.append(f"= {near_left} {near_right}")
    return out


def _covered(base: list[Span]):
    """A function that says whether a range meets a base span."""
    starts, ends = [], []
    for s, _, e in sorted(base):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)

    def meets(start: int, end: int) -> bool:
        k = bisect_right(starts, end - 1) - 1
        return k >= 0 and ends[k] > start
    return meets


def _shaped(value: str) -> bool:
    return len(value) >= MIN_LENGTH and _SHAPED.search(value) is not None


def identifiers(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Ranges of the values of an identifier's shape that meet no base span."""
    if not _SHAPED.search(text):
        return []
    meets, out = _covered(base), []
    for m in _IDENT.finditer(text):
        parts = [m.span()]
        if meets(*m.span()):
            parts = [c.span() for c in _CORE.finditer(text, *m.span()) if not meets(*c.span())]
        out += [(s, e) for s, e in parts if _shaped(text[s:e])]
    return out


def labelled_values(text: str, base: list[Span]) -> list[tuple[str, str, int, int, int]]:
    """(pattern, value, start, end, role) of every seed (role 2) and every value of an identifier's
    shape (role 1), once for each pattern around it."""
    found = [(s, e, 2) for s, _, e in base] + [(s, e, 1) for s, e in identifiers(text, base)]
    return [(p, _name(text[s:e]), s, e, role) for s, e, role in found for p in patterns_at(text, s, e)]


def _name(value: str) -> str:
    return value if len(value) <= NAMED else hashlib.sha256(value.encode()).hexdigest()


def _words(context: str) -> list[str]:
    return [t for t in context.split(" ") if t[0].isalnum() or t[0] == "_"]


class Others:
    """Counts the words without an identifier's shape that patterns extract.

    A place is looked at only if the words next to it can belong to a pattern: the nearest two of
    a context, or the nearest on both sides."""

    def __init__(self, patterns: list[str]):
        self.counts = dict.fromkeys(patterns, 0)
        self.left: dict[str, set[str | None]] = {}
        self.right: dict[str, set[str | None]] = {}
        marks: list[set[str]] = [set(), set()]
        for p in patterns:
            if p[0] == "<":  # a pattern of both sides is found by its left one
                near = _words(p[2:].split(" > ")[0])
                self.left.setdefault(near[0], set()).add(near[1] if len(near) > 1 else None)
            elif p[0] == ">":
                near = _words(p[2:])
                self.right.setdefault(near[0], set()).add(near[1] if len(near) > 1 else None)
            else:
                for side, mark in zip(marks, p[2:].split(" ")):
                    side.add(mark)
        self.near = self.left.keys() | self.right.keys()
        # words at an end of the text have no mark there; a mark may have another form in lower case
        self.edges = any("" in side for side in marks)
        self.between = None
        if marks[0] - {""} and marks[1] - {""}:
            first, last = ("|".join(re.escape(m) for m in sorted(side - {""})) for side in marks)
            self.between = re.compile(rf"(?:{first}){_BLANK.pattern}({_WORD.pattern})(?={_BLANK.pattern}(?:{last}))",
                                      re.IGNORECASE)

    def _places(self, words: list[str]) -> set[int]:
        """Numbers of the words that a context of one side may extract."""
        found, n = set(), len(words)
        for j in [j for j, w in enumerate(words) if w in self.near]:
            second = self.left.get(words[j])
            if second and j + 1 < n and (None in second or (j and words[j - 1] in second)):
                found.add(j + 1)
            second = self.right.get(words[j])
            if second and j and (None in second or (j + 1 < n and words[j + 1] in second)):
                found.add(j - 1)
        return found

    def _ranges(self, text: str) -> set[tuple[int, int]]:
        """Ranges of the words that some pattern may extract."""
        found: set[tuple[int, int]] = set()
        if self.near:
            places = self._places([_plain(w) for w in _WORD.findall(text)])
            if places:
                spans = [m.span() for m in _WORD.finditer(text)]
                found = {spans[i] for i in places}
        if self.between:
            found |= {m.span(1) for m in self.between.finditer(text)}
        if self.edges:
            if _RUN.search(text):  # a window may hold no whole token: any word can be at an end
                found |= {m.span() for m in _WORD.finditer(text)}
            else:
                first = _WORD.search(text)
                ends = [first.span()] if first else []
                for m in _WORD.finditer(text, max(0, len(text) - 4 * _WINDOW)):
                    ends[1:] = [m.span()]
                found |= set(ends)
                if len(text) > 4 * _WINDOW and len(ends) < 2:
                    found |= {m.span() for m in _WORD.finditer(text)}
        return found

    def add(self, text: str) -> None:
        meets = None
        for start, end in self._ranges(text):
            here = [p for p in patterns_at(text, start, end) if p in self.counts]
            if here and meets is None:
                base = base_spans(text)
                meets = _covered([*base, *((s, "", e) for s, e in identifiers(text, base))])
            if here and not meets(start, end):
                for p in here:
                    self.counts[p] += 1


def text_key(text: str) -> Column:
    return F.struct(F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes"))


_SPAN = "struct<start:int,kind:string,end:int>"
_VALUE = "struct<pattern:string,value:string,start:int,end:int,role:int>"


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, base, labelled) of every row: base spans and the values with their patterns."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    value = pa.list_(pa.struct([("pattern", pa.string()), ("value", pa.string()), ("start", pa.int32()),
                                ("end", pa.int32()), ("role", pa.int32())]))

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            bases, labelled = [], []
            for t in strings(b.column(2)):
                base = base_spans(t)
                bases.append([dict(zip(("start", "kind", "end"), s)) for s in base])
                labelled.append([dict(zip(("pattern", "value", "start", "end", "role"), v))
                                 for v in labelled_values(t, base)])
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(bases, span), pa.array(labelled, value)],
                names=["id", "key", "base", "labelled"])
        return fn

    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"),
                       F.col(text_col).alias("text"))
    return map_arrow(rows, make, f"id {kind}, key struct<hash:long,bytes:int>, base array<{_SPAN}>, "
                                 f"labelled array<{_VALUE}>")


def count_others(texts: DataFrame, patterns: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(pattern, others): how many words without an identifier's shape each of ``patterns``
    (pattern, instances) extracts from ``texts`` (one column); exact unless it exceeds the
    instances, where counting ends once that is seen."""
    column = texts.columns[0]
    texts = texts.filter(F.length(column) > 0)
    open_, done = patterns, []
    for share in SHARES:
        n_parts = -(-open_.count() // PASS_PATTERNS)
        part = F.pmod(F.xxhash64("pattern"), F.lit(max(n_parts, 1)))
        some = texts.filter(F.pmod(F.xxhash64(column), F.lit(share)) == 0) if share > 1 else texts
        counts = []
        for k in range(n_parts):
            names = [r.pattern for r in open_.filter(part == k).select("pattern").collect()]
            counts.append(_counted(some, names))
        if not counts:
            break
        counted = counts[0]
        for more in counts[1:]:
            counted = counted.unionByName(more)
        counted = scratch.write(open_.join(counted, "pattern", "left").select(
            "pattern", "instances", F.coalesce("others", F.lit(0)).cast("long").alias("others")), f"{name}-{share}")
        over = F.col("others") > F.col("instances")
        done.append(counted.filter(over) if share > 1 else counted)
        open_ = counted.filter(~over).select("pattern", "instances")
    found = texts.sparkSession.createDataFrame([], "pattern string, others long")
    for some in done:
        found = found.unionByName(some.select("pattern", "others"))
    return found


def _counted(texts: DataFrame, names: list[str]) -> DataFrame:
    """(pattern, others) of the patterns that extract some word; a task gives one row for each."""
    shared = texts.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = Others(shared.value)
        for b in batches:
            for t in strings(b.column(0)):
                others.add(t)
        rows = [(p, n) for p, n in others.counts.items() if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
            names=["pattern", "others"])

    return texts.mapInArrow(run, "pattern string, others long").groupBy("pattern").agg(
        F.sum("others").alias("others"))


def able(edges: DataFrame, scores: DataFrame | None, support: int, accept: float) -> DataFrame:
    """(pattern, instances, good, worth) of the patterns that may reach ``MIN_CONFIDENCE``.

    ``good`` sums the scores of the occurrences, ``worth`` counts them, those of an unscored value
    by half, so that a pattern's own new instances do not lower it much.  With a of n occurrences
    scored, good is at most a and worth is a + (n - a) / 2; good / (worth + others) reaches one half
    only if others is at most 2 * good - worth, which is at most n."""
    if scores is None:
        known = edges.withColumn("score", (F.col("role") == 2).cast("double"))
    else:
        known = edges.join(scores, "value", "left").withColumn(
            "score", F.when(F.col("role") == 2, 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
    worth = F.when((F.col("role") == 1) & (F.col("score") == 0), 0.5).otherwise(1.0)
    return (known.groupBy("pattern").agg(
        F.sum("times").alias("instances"), F.sum(F.col("score") * F.col("times")).alias("good"),
        F.sum(worth * F.col("times")).alias("worth"),
        F.sum((F.col("score") >= accept).cast("long")).alias("support"))
        .filter((F.col("support") >= support) & (F.col("good") >= MIN_CONFIDENCE * F.col("worth")))
        .drop("support"))


def score_instances(edges: DataFrame, texts: DataFrame, scratch: Scratch,
                    support: int = MIN_SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """(value, score) of the identifier-shaped instances that reach ``accept``; ``edges`` are
    distinct (pattern, value) with their role and how often they occur."""
    scores, accepted, k = None, 0, 0
    counted = edges.sparkSession.createDataFrame([], "pattern string, others long")
    while True:
        patterns = scratch.write(able(edges, scores, support, accept), f"patterns-{k}")
        fresh = patterns.join(counted, "pattern", "left_anti").select("pattern", "instances")
        counted = scratch.write(counted.unionByName(count_others(texts, fresh, scratch, f"others-{k}")), f"counted-{k}")
        sure = (patterns.join(counted, "pattern")
                .withColumn("confidence", F.col("good") / (F.col("worth") + F.col("others")))
                .filter(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", "confidence"))
        found = (edges.filter("role = 1").join(sure, "pattern").groupBy("value").agg(
            (F.lit(1.0) - F.exp(F.sum(F.log(F.greatest(F.lit(1.0) - F.col("confidence"), F.lit(1e-9))))))
            .alias("score")))
        scores = scratch.write(found, f"scores-{k}")
        now = scores.filter(F.col("score") >= accept).count()
        if now <= accepted:
            return scores.filter(F.col("score") >= accept)
        accepted, k = now, k + 1


def contextual_spans(scanned: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, more) with the spans that the method adds, for texts that get any; ``texts`` are the
    texts that were scanned."""
    values = scanned.filter(F.size("labelled") > 0).select("key", F.explode("labelled").alias("v")).select("key", "v.*")
    edges = scratch.write(values.groupBy("pattern", "value").agg(
        F.max("role").alias("role"), F.count(F.lit(1)).alias("times")), "edges")
    viable = scratch.write(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
                           .filter(F.col("n") >= MIN_SUPPORT).select("pattern"), "viable")
    edges = scratch.write(edges.join(broadcast_if_small(viable, 100), "pattern", "left_semi"), "graph")
    accepted = broadcast_if_small(scratch.write(score_instances(edges, texts, scratch).select("value"), "accepted"), 100)
    spans = values.filter("role = 1").join(accepted, "value", "left_semi").select(
        "key", F.struct("start", F.lit(METHOD_KIND).alias("kind"), "end").alias("span"))
    return scratch.write(spans.groupBy("key").agg(F.sort_array(F.collect_set("span")).alias("more")), "more")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, more): arrays of (start, kind, end) of every row."""
    scratch = Scratch(docs.sparkSession, "pii")
    scanned = scratch.write(scan(docs, id_col, text_col), "scanned")
    more = broadcast_if_small(contextual_spans(scanned, docs.select(text_col), scratch), 200)
    return scanned.join(more, "key", "left").select(
        F.col("id").alias(id_col), "base",
        F.coalesce("more", F.expr(f"cast(array() as array<{_SPAN}>)")).alias("more"))


def _joined(spans: str) -> Column:
    order = ", ".join(f"'{k}'" for k in (*KINDS, METHOD_KIND))
    return F.expr(
        f"array_join(transform(array_sort(transform({spans}, s -> struct(s.start, "
        f"array_position(array({order}), s.kind) as o, s.kind, s.end))), "
        f"s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, counts per base kind, base_sha256, spans, and the count of all spans."""
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
              for k in KINDS]
    return found.select(id_col, *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("concat(base, more)").alias("spans"),
                        F.expr("cast(size(base) + size(more) as long)").alias("n_all"))


def mask(text: str, spans: list[Span]) -> str:
    out, at, until = [], 0, -1
    for start, kind, end in sorted(spans):
        if start >= until:
            if until > at:
                at = until
            out += [text[at:start], f"[{kind.upper()}]"]
            at = until = end
        else:
            at = until = max(until, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of every text replaced; ``length_col``, if there, follows."""
    scratch = Scratch(docs.sparkSession, "pii")
    scanned = scratch.write(scan(docs.select(F.lit(0).alias("row"), text_col), "row", text_col), "scanned")
    more = contextual_spans(scanned, docs.select(text_col), scratch).select(
        F.col("key.hash").alias("more hash"), F.col("key.bytes").alias("more bytes"), "more")
    few = broadcast_if_small(more.withColumnRenamed("more", "more spans"), 200)
    joined = docs.join(few, (F.xxhash64(docs[text_col]) == few["more hash"])
                       & (F.octet_length(docs[text_col]) == few["more bytes"]), "left").drop("more hash", "more bytes")
    schema, names = docs.schema, docs.columns
    at = names.index(text_col)
    length = names.index(length_col) if length_col in names else None

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(at).to_pylist()
            new = []
            for t, extra in zip(texts, b.column(len(names)).to_pylist()):
                spans = base_spans(t) if t else []
                spans += [(s["start"], s["kind"], s["end"]) for s in extra or ()]
                new.append(mask(t, spans) if spans else t)
            cols = list(b.columns[:len(names)])
            cols[at] = pa.array(new, cols[at].type)
            if length is not None:
                sizes = [n if x is y else len(y) for x, y, n in zip(texts, new, cols[length].to_pylist())]
                cols[length] = pa.array(sizes, cols[length].type)
            return pa.RecordBatch.from_arrays(cols, names=names)
        return fn

    return map_arrow(joined, make, schema)
