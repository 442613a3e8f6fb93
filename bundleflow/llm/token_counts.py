"""Token counts with overlap resynchronisation for huge documents (operator 12).

Texts up to ``CHUNK`` characters are encoded whole, in batches.  A longer text is cut into chunks
that overlap; chunks become rows of their own, are spread over the cluster and encoded with
offsets; the encodings of neighbours are spliced at a boundary inside their overlap, and the
tokens between a chunk's two splices are summed.

A splice is proven, not guessed.  Byte pair merging of the model only ever makes pieces of its
vocabulary, so a place that no vocabulary piece spans (looked up in the characters around it) is
crossed by no merge, in any chunk that holds these characters: what lies before and after is
merged independently, and the tokens between two such places are those of the whole text.  The
first such place of an overlap depends on the overlap's characters alone, so both neighbours
find the same one; that their token boundaries meet there is checked, and a miss is an error.
An overlap without such a place is doubled until it has one or reaches the end of the text, so
a run without any (one character repeated, say) stays in one chunk.

The proof needs a BPE model that takes texts as they are (no normalisation but spaces written as
U+2581); other models are refused.  Special strings inside texts are ordinary text, as the
library's default is.

Defined results: null counts as the empty text, which has no tokens; repeated rows, null and
repeated ids keep rows of their own (chunks are told apart by a random name given when they are
written); ties play no part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import Scratch, map_arrow, strings

CHUNK = 16_384
OVERLAP = 256
LIMIT = 4096
# The model type of BPE, and the character that stands for a space.
BPE = 2
SPACE = "▁"
# Characters of chunks that are passed on at a time.
PASS_CHARS = 1 << 20


class Model:
    """A sentencepiece BPE model with the lookups that splicing needs."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.library.serialized_model_proto())
        rules = spec.normalizer_spec
        if spec.trainer_spec.model_type != BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError(f"{path}: only BPE models that take texts as they are can be spliced")
        self.prefix = len(SPACE.encode()) if rules.add_dummy_prefix else 0
        ids = range(self.library.get_piece_size())
        names = [self.library.id_to_piece(i) for i in ids]
        whole = [not (self.library.is_control(i) or self.library.is_byte(i) or self.library.is_unknown(i))
                 for i in ids]
        self.pieces = {p for p, w in zip(names, whole) if w and len(p) > 1}
        self.longest = max(map(len, self.pieces), default=1)
        # bytes of text that a token stands for; an unknown token has no known length
        self.width = np.array([len(p.encode()) if w else int(self.library.is_byte(i))
                               for i, p, w in zip(ids, names, whole)], dtype=np.int64)
        self.exact = spec.trainer_spec.byte_fallback

    def spans(self, text: str, place: int) -> bool:
        """Some piece of the vocabulary lies in ``text`` across ``place``."""
        for begin in range(place - 1, max(place - self.longest, -1), -1):
            for end in range(place + 1, min(begin + self.longest, len(text)) + 1):
                if text[begin:end] in self.pieces:
                    return True
        return False

    def splice(self, text: str, begin: int, end: int) -> int | None:
        """The first place of ``begin`` to ``end`` that no piece spans, seen from within alone."""
        for place in range(begin + self.longest, end - self.longest + 1):
            if not self.spans(text, place):
                return place
        return None

    def seam(self, text: str, at: int, overlap: int) -> int | None:
        """End of the overlap that begins at ``at``: doubled until it holds a splice."""
        tested = at
        while at + overlap < len(text):
            if self.splice(text, tested, at + overlap) is not None:
                return at + overlap
            tested, overlap = max(at, at + overlap - 2 * self.longest), 2 * overlap
        return None

    def chunks(self, text: str, chunk: int, overlap: int) -> Iterator[tuple[str, int, int]]:
        """(characters, left overlap, right overlap) of the chunks of a text."""
        text, begin, left = text.replace(" ", SPACE), 0, 0
        while True:
            at = begin + max(chunk, left)
            end = self.seam(text, at, overlap) if at < len(text) else None
            if end is None:
                yield text[begin:], left, 0
                return
            yield text[begin:end], left, end - at
            begin, left = at, end - at

    def count_between(self, text: str, left: int, right: int) -> int:
        """Tokens of a chunk between the splices of its two overlaps."""
        ids = np.asarray(self.library.encode(text), dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(self.width[ids]) - self.prefix))
        marks = [0, len(ids)]
        for k, (size, begin) in enumerate(((left, 0), (right, len(text) - right))):
            if size:
                place = self.splice(text, begin, begin + size)
                at = len(text[:place].encode()) if place is not None else -1
                marks[k] = int(np.searchsorted(ends, at))
                if marks[k] >= len(ends) or ends[marks[k]] != at:
                    raise RuntimeError("encodings of overlapping chunks do not meet")
        return marks[1] - marks[0]


@lru_cache(maxsize=1)
def load(path: str) -> Model:
    return Model(path)


def split(docs: DataFrame, path: str, id_col: str, text_col: str, chunk: int, overlap: int) -> DataFrame:
    """(id, n_bytes, n_tokens, name, text, left, right): one row for a short text with its tokens,
    one row for each chunk of a long one, without."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    names = ["id", "n_bytes", "n_tokens", "name", "text", "left", "right"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)

        def batch(ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[i] for r in found], k) for i, k in enumerate(kinds))], names=names)

        for b in batches:
            ids, sizes = b.column(0), b.column(2).to_pylist()
            texts = strings(b.column(1))
            # without byte fallback an unknown token has no length, so texts stay whole
            short = [i for i, t in enumerate(texts) if len(t) <= chunk + overlap or not model.exact]
            counts = model.library.encode([texts[i] for i in short], num_threads=1)
            yield batch(ids.take(pa.array(short, pa.int64())),
                        [(sizes[i], len(c), None, None, None, None) for i, c in zip(short, counts)])
            held, chars = [], 0
            for i in sorted(set(range(len(texts))) - set(short)):
                name = uuid.uuid4().hex
                for part, left, right in model.chunks(texts[i], chunk, overlap):
                    held.append((i, (sizes[i], None, name, part, left, right)))
                    chars += len(part)
                    if chars >= PASS_CHARS:
                        yield batch(ids.take(pa.array([k for k, _ in held])), [r for _, r in held])
                        held, chars = [], 0
            if held:
                yield batch(ids.take(pa.array([k for k, _ in held])), [r for _, r in held])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, name string, text string, "
                                "left int, right int")


def count_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """(id, n_bytes, n_tokens) of the long texts, from their chunks."""
    kind = chunks.schema["id"].dataType.simpleString()

    def make():
        model = load(path)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.count_between(*r) for r in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))]
            return pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, pa.int64())],
                                              names=["id", "n_bytes", "name", "n"])
        return fn

    spread = chunks.repartition("name", F.xxhash64("text")).select(
        "id", "n_bytes", "name", "text", "left", "right")
    return (map_arrow(spread, make, f"id {kind}, n_bytes long, name string, n long")
            .groupBy("name").agg(F.first("id").alias("id"), F.first("n_bytes").alias("n_bytes"),
                                 F.sum("n").alias("n_tokens")).drop("name"))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row, by the model at ``path``."""
    rows = Scratch(docs.sparkSession, "tokens").write(
        split(docs, path, id_col, text_col, chunk, overlap), "split")
    short = rows.filter("name IS NULL").select("id", "n_bytes", "n_tokens")
    return short.unionByName(count_chunks(rows.filter("name IS NOT NULL"), path)).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
