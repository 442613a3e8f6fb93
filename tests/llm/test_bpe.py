"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from bundleflow.llm import bpe


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(tok, text):
    return np.frombuffer(b"".join(tok.encode_parts(text)), "<u4").tolist()


def test_random_texts_as_the_library(library):
    tok, rng = bpe.tokenizer(bpe.RANKS, None), random.Random(5)
    alphabet = "abcdefghinorstABC \n\t'0123éñß漢字🙂!#…ǅʰ\u00a0\u2028"
    for size in (0, 1, 3, 17, 90, 700):
        for _ in range(60):
            text = "".join(rng.choice(alphabet) for _ in range(size))
            assert ids_of(tok, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "abab" * 900, "é" * 2000, "\n" * 1500, "it's we'll I'd"])
def test_long_runs_as_the_library(library, text):
    assert ids_of(bpe.tokenizer(bpe.RANKS, None), text) == library.encode_ordinary(text)


def test_heap_and_matrix_agree(library):
    tok, rng = bpe.tokenizer(bpe.RANKS, None), random.Random(9)
    for _ in range(50):
        raw = "".join(rng.choice("abcdetz") for _ in range(200)).encode()
        tok.cache.clear()
        tok._merge_matrix([("x", raw)], 200)
        assert tok.cache.pop("x") == tok._merge_long(raw)


def test_latin_pattern_splits_alike():
    tok, rng = bpe.tokenizer(bpe.RANKS, None), random.Random(3)
    for _ in range(300):
        text = "".join(chr(rng.randrange(0x250)) for _ in range(80))
        assert tok.latin_pattern.findall(text) == tok.pattern.findall(text)


def test_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    tok = bpe.BytePairTokenizer(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)), public_tokenizers.PATTERN)
    texts = ["several words are more than the cache holds", "other words again", "", "several words"]
    got = [np.frombuffer(b"".join(p), "<u4").tolist() for p in tok.encode_group(texts)]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_digest(odd_docs, library):
    rows = bpe.round_trip_digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    want = sorted((str(r.doc_id), hashlib.sha256(np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (2, 3))


def test_encode_decode_keep_columns(odd_docs, no_docs):
    encoded = bpe.encode(odd_docs.withColumn("token_ids", odd_docs.source))
    assert encoded.columns == [*odd_docs.columns, "token_ids"]
    for r in bpe.decode(encoded).collect():
        assert bytes(r.decoded).decode() == (r.text or "")
    assert bpe.decode(bpe.encode(no_docs)).count() == 0


def test_ids_beyond_16_bits():
    """A vocabulary whose ids need more than 16 bits, against the public library."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    wide = {t: r * 41 + 70_000 for t, r in ranks.items()}
    mine = bpe.BytePairTokenizer(wide, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("wide", pat_str=public_tokenizers.PATTERN, mergeable_ranks=wide, special_tokens={})
    for text in ("The quick brown fox's naïve 12345 jumps...   over", "漢字 und Straße\n\n  x" * 40, "a" * 500):
        want = theirs.encode_ordinary(text)
        got = ids_of(mine, text)
        assert got == want and max(got) > 1 << 16 and mine.decode(np.array(got, "<u4").tobytes()) == text.encode()
