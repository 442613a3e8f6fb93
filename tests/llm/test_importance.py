"""Importance resampling against a plain loop; runs of several words; odd rows."""

import hashlib
import math
import re
import zlib

import pytest

from bundleflow.llm import common, importance

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = SPLIT.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(docs, target, longest, min_words=20, percent=10):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for b in features(text, longest)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + 10_000) / ((a + 1.0) * (sum(t) + 10_000))))
            for a, b in zip(s, t)]
    rows, able = [], []
    for name, text in docs:
        n_words, found = features(text, longest)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((name, len(found), weight, score))
        if n_words >= min_words:
            able.append((-score, name is not None, name or 0))
    ranked = sorted(able)[:len(able) * percent // 100]
    return sorted(map(repr, rows)), ranked


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_equals_a_plain_loop(llm, longest):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want, ranked = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest)
    got = importance.resample(docs, target, longest=longest).collect()
    assert sorted(repr(tuple(r)[:4]) for r in got) == want
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(ranked) + 1))
    assert [(-r.score, r.doc_id) for r in drawn] == [(a, c) for a, _, c in ranked]


def test_long_texts_go_in_stretches(monkeypatch):
    text = " ".join(f"Wörd{i % 37}-{i}é漢 x" for i in range(3000)) + "y" * 5000 + " tail"
    whole = [importance.Features(n).count(text) for n in (1, 2, 3)]
    monkeypatch.setattr(common, "STRETCH", 64)
    assert [importance.Features(n).count(text) for n in (1, 2, 3)] == whole
    for n, (words, found) in zip((1, 2, 3), whole):
        n_words, plain = features(text, n)
        assert (words, sum(found.values())) == (n_words, len(plain))
        assert found == {b: plain.count(b) for b in set(plain)}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for target in (odd_docs, no_docs):
        texts = [r.text for r in target.collect()]
        want, ranked = brute(rows, texts, 1, min_words=2, percent=50)
        got = importance.resample(odd_docs, target, min_words=2, percent=50).collect()
        assert sorted(repr(tuple(r)[:4]) for r in got) == want
        drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
        assert [(-r.score, r.doc_id or 0) for r in drawn] == [(a, c) for a, _, c in ranked]
    assert importance.resample(no_docs, odd_docs).collect() == []


def test_equal_rows_take_places_of_their_own(llm):
    docs = llm.createDataFrame([(7, "a b c")] * 9 + [(i, "a b c") for i in range(11)], "doc_id long, text string")
    got = importance.resample(docs, docs, min_words=3, percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 21))
    assert [r.score for r in sorted(got, key=lambda r: r["rank"])] == sorted((r.score for r in got), reverse=True)
