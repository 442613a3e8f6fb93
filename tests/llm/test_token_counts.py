"""Token counts against the public library on whole texts, with chunks of every size."""

import random

import pytest
import sentencepiece

from bundleflow.llm import token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def long_texts():
    r = random.Random(5)
    marks = ["the", "of", " ", "  ", "   ", "\n", "\t", "in", "ation", "é", "漢字", "🙂", "▁", "<s>", "a", "b", "1", "23", "--", "ß"]
    return [
        "a" * 3000,
        " " * 3000,
        "▁ " * 700 + "x" * 900,
        "".join(r.choice(marks) for _ in range(2500)),
        "".join(r.choice("abcdefgh") for _ in range(3000)),
        "漢字" * 900 + "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(900)),
        " ".join(r.choice(marks) for _ in range(1200)),
        "\x00</s><unk>" * 200,
    ]


@pytest.mark.parametrize("chunk,overlap", [(64, 40), (100, 33), (500, 256), (1000, 64)])
def test_chunks_count_like_the_whole_text(library, chunk, overlap):
    model = token_counts.load(PATH)
    for text in long_texts():
        parts = list(model.chunks(text, chunk, overlap))
        assert sum(model.count_between(*p) for p in parts) == len(library.encode(text))
        # the chunks hold the text: overlaps repeat, nothing is left out
        assert parts[0][0] + "".join(p[left:] for p, left, _ in parts[1:]) == text.replace(" ", "▁")


def test_a_run_without_a_splice_stays_whole():
    model = token_counts.load(PATH)
    assert [len(p) for p, _, _ in model.chunks("a" * 5000, 64, 40)] == [5000]
    parts = list(model.chunks("some words " * 40 + "a" * 3000 + " some words" * 40, 64, 40))
    assert len(parts) > 5 and max(len(p) for p, _, _ in parts) > 3000


def test_proof_of_a_splice(library):
    """Both sides of every place that no piece spans are encoded on their own."""
    model = token_counts.load(PATH)
    for text in long_texts():
        text = text[:400].replace(" ", "▁")
        whole = library.encode(text)
        for place in range(20, len(text) - 20, 7):
            if not model.spans(text, place):
                front = library.encode(text[:place])
                assert whole[:len(front)] == front


def test_all_documents(llm, library):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect())
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (700, 64)):
        got = token_counts.count_tokens(docs, PATH, chunk=chunk, overlap=overlap).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_odd_rows(llm, library, odd_docs, no_docs):
    more = llm.createDataFrame([(i, t) for i, t in enumerate(long_texts())] + [(None, "word " * 900)] * 3,
                               "doc_id long, text string")
    rows = odd_docs.unionByName(more, allowMissingColumns=True)
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(library.encode(r.text or "")))
                  for r in rows.collect())
    got = token_counts.count_tokens(rows, PATH, chunk=300, overlap=64).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(no_docs, PATH).collect() == []
