"""Ranked search against scoring every document, at every size of blocks and shards."""

import math
import random
import re
from collections import Counter

import pytest

from bundleflow.llm import common, ranked_search

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOWER) for w in SPLIT.findall(text or "")]


def brute(docs, items, k=20):
    held = [(name, terms(t)) for name, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for name, t in held:
            m = 75 + (25 * len(t) * n_docs) // n_terms
            tf = Counter(t)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in terms(text) if w in tf)
            if score > 0:
                scored.append((-score, name is not None, name or 0))
        out += [(item, i + 1, n if there else None, -s) for i, (s, there, n) in enumerate(sorted(scored)[:k])]
    return sorted(map(repr, out))


def pairs(df):
    return [tuple(r) for r in df.collect()]


def found(*args, **kw):
    return sorted(repr(tuple(r)) for r in ranked_search.rank(*args, **kw).collect())


@pytest.mark.parametrize("block_docs,cells,k", [(64, 1 << 23, 20), (3, 1 << 16, 20), (5, 1 << 14, 3), (1, 1, 2)])
def test_equals_scoring_all(llm, monkeypatch, block_docs, cells, k):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    if cells == 1:
        docs, items = docs.limit(30), items.limit(5)
        docs, items = llm.createDataFrame(docs.collect()), llm.createDataFrame(items.collect())
    assert found(docs, items, k=k) == brute(pairs(docs), pairs(items), k)


def test_blocks_and_groups_of_items(llm, monkeypatch):
    monkeypatch.setattr(ranked_search, "GROUP_BYTES", 4000)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 700)
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    assert found(docs, items) == brute(pairs(docs), pairs(items))


def test_ties_copies_and_common_terms(llm):
    r = random.Random(3)
    words = ["the"] * 40 + ["of"] * 20 + [f"w{i}" for i in range(30)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 30))) for _ in range(120)]
    docs = [(r.randrange(400), r.choice(texts)) for _ in range(500)] + [(1000 - i, texts[0]) for i in range(90)]
    items = [(i, r.choice(texts) + " the the THE") for i in range(15)] + [(3, "w1 w1 w2"), (3, "w1 w1 w2")]
    got = found(llm.createDataFrame(docs, "doc_id long, text string").repartition(5),
                llm.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)


def test_blocks_are_skipped(llm):
    """Documents of another block than the best ones are never scored."""
    import numpy as np
    items = [(0, {t: 1 for t in range(8)})]
    block = ranked_search.Block(items, 8)
    rng = np.random.default_rng(1)
    impacts = np.concatenate((rng.integers(900, 1000, (64, 8)), rng.integers(1, 10, (640, 8))))
    shard = ranked_search.Shard(block, impacts)
    assert max(len(begins) for _, begins, _ in shard.lists) > 3
    read = []
    shard.impacts = type("Spy", (), {"__len__": lambda s: len(impacts),
                                     "__getitem__": lambda s, at: (read.append(len(at[0])), impacts[at])[1]})()
    docs, scores = shard.search(0, 20, 0, np.ones(len(impacts), dtype=np.int64))
    assert sorted(scores)[-20:] == sorted((impacts.sum(axis=1)))[-20:]
    assert sum(read) < len(impacts) // 2


def test_odd_rows(llm, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(common, "STRETCH", 1000)
    items = llm.createDataFrame([(1, "quick fox tail7"), (None, "NAÏVE café 漢字"), (2, None), (3, ""), (4, "nowhere")],
                                "item_id long, text string")
    assert found(odd_docs, items) == brute([(r.doc_id, r.text) for r in odd_docs.collect()], pairs(items))
    assert found(no_docs, items) == [] and found(odd_docs, items.limit(0)) == []
