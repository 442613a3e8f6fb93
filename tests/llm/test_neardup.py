"""Near-duplicates against brute force on full shingle sets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from bundleflow.llm import neardup
from bundleflow.llm.common import Scratch
from bundleflow.llm.components import components

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(texts):
    out = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        out[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k:k + 5]) for k in range(len(w) - 4)))
    return out


def brute(texts, percent=85):
    sets = sets_of(texts)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_real_documents(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(neardup.near_duplicates(docs)) == brute({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("percent,rows", [(85, 6), (80, 5)])
def test_large_group_with_gray_zone(llm, percent, rows):
    """A group whose members' similarities lie around the threshold, next to exact copies and a
    passage that many texts share: no link is lost though no bucket is expanded into pairs."""
    rng = random.Random(percent)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    passage = [f"p{k}" for k in range(60)]
    texts, n = {}, 0
    for _ in range(220):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 4, 6))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts[n] = " ".join(w)
        n += 1
    for _ in range(80):
        texts[n] = " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.choice((10, 30, 60)))])
        n += 1
    for _ in range(40):
        texts[n] = "An exact copy of one short text that stands here often enough"
        n += 1
    order = list(texts)
    rng.shuffle(order)
    docs = llm.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").repartition(6)
    setting = neardup.Setting(percent=percent, bands=32, rows=rows)
    assert got(neardup.near_duplicates(docs, setting=setting)) == brute(texts, percent)


def test_blocks_cover_all_pairs(llm, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for n in range(60):
        w = list(base)
        for _ in range(rng.choice((0, 2, 3, 4))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts[n] = " ".join(w)
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got(neardup.near_duplicates(docs)) == brute(texts)


def test_odd_rows(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(9, 1, True)] * 2
    assert by[None] == [(9, 1, False)]
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert by[6] == [(1, 6, True)] and by[7] == [(1, 6, False)]
    assert neardup.near_duplicates(no_docs).count() == 0


def test_drop_keeps_one_of_each_group(odd_docs, no_docs):
    out = neardup.drop_near_duplicates(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 4, 5, 6, 8]
    assert neardup.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("edges,want", [
    ([], {}),
    ([(k, k + 1) for k in range(40)], {k: 0 for k in range(41)}),
    ([(9, k) for k in range(9)] + [(20, 21), (21, 20), (30, 30)], {**{k: 0 for k in range(10)}, 20: 20, 21: 20}),
])
def test_components(llm, edges, want):
    df = llm.createDataFrame(edges, "a long, b long")
    found = components(df, Scratch(llm, "test"), "c").collect()
    assert {r.node: r.label for r in found} == want


def test_signature_estimates_similarity(llm):
    hashes, signer = neardup.WordHashes(), neardup.Signer(192)
    a = neardup.shingle_set(" ".join(f"w{k}" for k in range(1000)), hashes)
    b = neardup.shingle_set(" ".join(f"w{k}" for k in range(100, 1000)), hashes)
    import numpy as np
    x, y = (np.frombuffer(signer.sign(s), "<u2") for s in (a, b))
    assert abs((x == y).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.1


def test_plan_has_no_cross_join(llm):
    docs = llm.range(3).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    plan = neardup.near_duplicates(docs)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
