"""Byte-level BPE in length-bucketed padded numpy matrices (operator 3).

A text is split by the tokenizer's pattern.  Pieces not met before in this worker are
grouped by byte length into padded id matrices; each round looks up the rank of every
adjacent pair of every row in a hash table, merges each row's leftmost pair of minimum
rank, and drops finished rows and spent columns (compaction).  Pieces that are a token as a
whole need no round.  Encoded pieces are kept in a bounded cache of the Python worker.

Ranks decide as in the tiktoken library: a pair merges if its joined bytes are a token, and
the joined token's rank orders the merges.  Pieces above ``LONG_PIECE`` bytes (a run without
a split point) would cost a quadratic number of matrix steps; they are merged in the same
order with a heap instead.

Defined results: null texts count as empty (no ids, hash of no bytes); very long texts are
split and hashed piece by piece; repeated rows and null ids keep their rows; extra columns
are ignored by the digest and kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import CHUNK_CHARS, map_arrow, strings, text_groups

LONG_PIECE = 1024
CACHE_PIECES = 250_000
NONE = np.int32(2**31 - 1)
MATRIX_CELLS = 1 << 20
# Fixed value: odd multiplier of the multiplicative hash (2^64 over the golden ratio).
GOLDEN = np.uint64(11400714819323198485)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def _latin_pattern(pattern: str) -> re.Pattern | None:
    """``pattern`` with explicit character classes, the same for texts below U+0250, where the
    standard engine is faster; None if it holds other properties."""
    def members(cls: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(0x250) if regex.match(cls, chr(c)))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for name, text in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"),
                       (r"\s", f"[{spaces}]"), (r"\S", f"[^{spaces}]")):
        out = out.replace(name, text)
    return None if re.search(r"\\[pPdDwW]", out) else re.compile(out)


class PairTable:
    """Open-addressing table of (left id, right id) -> rank of the joined token."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        keys = np.array([k for k, _ in found], dtype=np.uint64)
        vals = np.array([v for _, v in found], dtype=np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4 + 1))))
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.vals = np.full(1 << self.bits, NONE, dtype=np.int32)  # NONE: free slot
        at = self._slot(keys)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):
            # of the keys that meet at a free slot one moves in, the others go a slot further
            free = todo[self.vals[at[todo]] == NONE]
            slots, first = np.unique(at[free], return_index=True)
            self.keys[slots], self.vals[slots] = keys[free[first]], vals[free[first]]
            todo = np.setdiff1d(todo, free[first], assume_unique=True)
            at[todo] = (at[todo] + np.uint64(1)) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * GOLDEN) >> np.uint64(64 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it is no token."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.vals[at], NONE)
        todo = np.flatnonzero((self.keys[at] != keys) & (self.vals[at] != NONE))
        for _ in range(self.probes):
            if not len(todo):
                break
            at[todo] = (at[todo] + np.uint64(1)) & self.mask
            slot = at[todo]
            hit = self.keys[slot] == keys[todo]
            out[todo[hit]] = self.vals[slot[hit]]
            todo = todo[~hit & (self.vals[slot] != NONE)]
        return out


class BytePairTokenizer:
    """Encodes and decodes by a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.whole = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.pattern = regex.compile(pattern)
        self.latin_pattern = _latin_pattern(pattern)
        self.cache: dict[str, bytes] = {}

    # -- encoding ---------------------------------------------------------------------

    def pieces(self, text: str) -> Iterator[list[str]]:
        pattern = self.pattern
        if self.latin_pattern and not BEYOND_LATIN.search(text):
            pattern = self.latin_pattern
        if len(text) <= CHUNK_CHARS:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while part := [m.group() for m in islice(found, 1 << 16)]:
            yield part

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of ``pieces`` into the cache."""
        if len(self.cache) + len(pieces) > CACHE_PIECES:
            self.cache.clear()
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode("utf-8", "surrogatepass")
            if (whole := self.whole.get(raw)) is not None:
                self.cache[p] = whole.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                self.cache[p] = self._merge_long(raw)
            else:
                by_length.setdefault((len(raw) + 3) // 4 * 4, []).append((p, raw))
        for width, rows in by_length.items():
            step = max(1, MATRIX_CELLS // width)
            for k in range(0, len(rows), step):
                self._merge_matrix(rows[k:k + step], width)

    def _merge_matrix(self, rows: list[tuple[str, bytes]], width: int) -> None:
        lengths = np.fromiter((len(raw) for _, raw in rows), dtype=np.int64, count=len(rows))
        ids = np.zeros((len(rows), width), dtype=np.int32)
        flat = self.byte_ids[np.frombuffer(b"".join(raw for _, raw in rows), dtype=np.uint8)]
        ids[np.arange(width) < lengths[:, None]] = flat
        # rank[r, c]: of the pair (c, c + 1); the last column is never a pair
        rank = np.full((len(rows), width), NONE, dtype=np.int32)
        pair = np.arange(width) < lengths[:, None] - 1
        rank[pair] = self.pairs.ranks(ids[pair], ids[:, 1:][pair[:, :-1]])
        names = np.arange(len(rows))
        while len(names):
            at = rank.argmin(axis=1)  # the leftmost of equal ranks
            best = rank[np.arange(len(names)), at]
            done = best == NONE
            if done.any():
                self._keep(rows, names[done], ids[done], lengths[done])
                live = ~done
                ids, rank, names = ids[live], rank[live], names[live]
                lengths, at, best = lengths[live], at[live], best[live]
                if not len(names):
                    break
            line = np.arange(len(names))
            ids[line, at] = best
            # the right half of the merged pair goes from every row, so rows stay aligned
            stay = np.ones(ids.shape, dtype=bool)
            stay[line, at + 1] = False
            width -= 1
            ids, rank = ids[stay].reshape(-1, width), rank[stay].reshape(-1, width)
            lengths = lengths - 1
            rank[line, at] = NONE
            right = at < lengths - 1
            rank[line[right], at[right]] = self.pairs.ranks(best[right], ids[line[right], at[right] + 1])
            left = at > 0
            rank[line[left], at[left] - 1] = self.pairs.ranks(ids[line[left], at[left] - 1], best[left])

    def _keep(self, rows: list[tuple[str, bytes]], names: np.ndarray, ids: np.ndarray,
              lengths: np.ndarray) -> None:
        flat = ids[np.arange(ids.shape[1]) < lengths[:, None]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(lengths)).tolist()
        begin = 0
        for name, end in zip(names.tolist(), ends):
            self.cache[rows[name][0]] = flat[begin:end]
            begin = end

    def _merge_long(self, raw: bytes) -> bytes:
        ids = [int(x) for x in self.byte_ids[np.frombuffer(raw, dtype=np.uint8)]]
        n = len(ids)
        after, before, dead = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
        all_ids = np.array(ids, dtype=np.int32)
        first = self.pairs.ranks(all_ids[:-1], all_ids[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                r = self.whole.get(self.tokens[ids[i]] + self.tokens[ids[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j >= n or ids[i] != x or ids[j] != y:
                continue
            ids[i], dead[j], after[i] = r, 1, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return np.array([ids[i] for i in range(n) if not dead[i]], dtype="<u4").tobytes()

    def _ids(self, part: list[str]) -> bytes:
        try:
            return b"".join(map(self.cache.__getitem__, part))
        except KeyError:
            self.learn(set(part) - self.cache.keys())
        if any(p not in self.cache for p in part):  # the cache was emptied on the way
            self.learn(set(part))
        return b"".join(map(self.cache.__getitem__, part))

    def encode_parts(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, part by part."""
        for part in self.pieces(text):
            yield self._ids(part)

    def encode_group(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """``encode_parts`` of each text; new pieces of the group share their matrices."""
        split = [next(self.pieces(t)) if len(t) <= CHUNK_CHARS else None for t in texts]
        new: set[str] = set()
        for part in split:
            if part:
                new.update(part)
        new -= self.cache.keys()
        if new:
            self.learn(new)
        for text, part in zip(texts, split):
            yield self.encode_parts(text) if part is None else iter((self._ids(part),))

    # -- decoding ---------------------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[tuple[str, str], BytePairTokenizer] = {}


def tokenizer(name: str, pattern: str | None) -> BytePairTokenizer:
    """The worker's tokenizer for a rank file (a path, or a name among the public ones)."""
    import public_tokenizers
    path = name if "/" in name else public_tokenizers.path(name)
    pattern = pattern or public_tokenizers.PATTERN
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairTokenizer(read_ranks(path), pattern)
    return _LOADED[path, pattern]


RANKS = "byte_bpe_50k.tiktoken"


def _grouped(tok: BytePairTokenizer, texts: list[str]) -> Iterator[Iterator[bytes]]:
    for a, b in text_groups(texts):
        yield from tok.encode_group(texts[a:b])


def round_trip_digest(docs: DataFrame, ranks: str = RANKS, pattern: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every whole text."""

    def make():
        tok = tokenizer(ranks, pattern)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            count, ids_hash, text_hash = [], [], []
            for parts in _grouped(tok, strings(b.column(1))):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for part in parts:
                    n += len(part) // 4
                    of_ids.update(part)
                    of_text.update(tok.decode(part))
                count.append(n)
                ids_hash.append(of_ids.hexdigest())
                text_hash.append(of_text.hexdigest())
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(count, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make,
                     f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str | None = None,
           text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col`` (binary: little-endian unsigned 32-bit ids) after its columns;
    a column of that name is replaced."""
    kept = [c for c in docs.columns if c != ids_col]
    at = kept.index(text_col)

    def make():
        tok = tokenizer(ranks, pattern)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = [b"".join(parts) for parts in _grouped(tok, strings(b.column(at)))]
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())],
                                              names=[*b.schema.names, ids_col])
        return fn

    schema = docs.select(*kept).schema.add(ids_col, "binary")
    return map_arrow(docs.select(*kept), make, schema)


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str | None = None,
           ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``bytes_col`` (the bytes its ids stand for; null ids: no bytes)."""
    kept = [c for c in encoded.columns if c != bytes_col]
    at = kept.index(ids_col)

    def make():
        tok = tokenizer(ranks, pattern)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            out = [tok.decode(x or b"") for x in b.column(at).to_pylist()]
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                              names=[*b.schema.names, bytes_col])
        return fn

    schema = encoded.select(*kept).schema.add(bytes_col, "binary")
    return map_arrow(encoded.select(*kept), make, schema)
