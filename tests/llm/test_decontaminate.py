"""Spaced seeds: full sensitivity of the masks, and results against brute force."""

import random
import re
from itertools import combinations

from bundleflow.llm import decontaminate as d


def test_masks_miss_no_window():
    for length in range(d.MIN_ITEM, d.WINDOW + 1):
        allowed = length * (100 - d.PERCENT) // 100
        for gone in combinations(range(length), allowed):
            assert any(not any(at + o in gone for o in m) for m in d.MASKS for at in range(length - m[-1]))


def brute(docs, items):
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for i, t in items:
        iw = split(t)
        width = min(d.WINDOW, len(iw))
        percent = d.PERCENT if len(iw) >= d.MIN_ITEM else 100
        for doc, text in docs:
            dw = split(text)
            for shift in range(-len(iw) + 1, len(dw)):
                m = [int(0 <= k + shift < len(dw) and dw[k + shift] == w) for k, w in enumerate(iw)]
                if any(100 * sum(m[k:k + width]) >= percent * width for k in range(len(m) - width + 1) if iw):
                    out[doc, i] = max(out.get((doc, i), 0), sum(m))
    return out


def test_against_brute_force(llm):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(60)] + ["the", "of"] * 10
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice((7, 8, 10, 15, 40))))) for k in range(12)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "too short an item")]
    docs = []
    for k in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice((5, 30, 80)))]
        if k % 2:
            passage = items[rng.randrange(12)][1].split()
            passage = passage[rng.randrange(3):]
            for _ in range(rng.choice((0, 1, 2, 4))):
                passage[rng.randrange(len(passage))] = "CHANGED"
            at = rng.randrange(len(w))
            w[at:at] = passage
        docs.append((k, ", ".join(w) if k % 3 else " ".join(w).upper()))
    docs += [(90, None), (91, ""), (1, docs[1][1])]
    got = d.leaks(llm.createDataFrame(docs, "doc_id long, text string").repartition(3),
                  llm.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): r.matched for r in got} == want and len(want) > 10
    assert sum(r.doc_id == 1 for r in got) == 2 * sum(k[0] == 1 for k in want)


def test_drop(odd_docs, no_docs, llm):
    items = llm.createDataFrame([(1, "quick brown fox leaps over the lazy dog near the river")], "item_id long, text string")
    out = d.drop_leaks(odd_docs, items)
    assert out.columns == odd_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 4, 5, 6, 7, 8]
    assert d.drop_leaks(no_docs, items).count() == 0
    assert d.drop_leaks(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_native(odd_docs, llm):
    items = llm.createDataFrame([(1, "quick brown fox leaps over the lazy dog")], "item_id long, text string")
    plan = d.leaks(odd_docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_items_and_null_ids(llm):
    """Items below the seeds' length leak by their whole word run; null ids are reported."""
    docs = llm.createDataFrame([(1, "well, To be or not to be it is"), (2, "to be or not be"), (3, "Yes"), (4, None),
                                (5, "a b c d e f g h i j k l m n o p")], "doc_id long, text string")
    items = llm.createDataFrame([(1, "to be, or NOT to be"), (2, "yes"), (None, "d e f g h i j k l m"), (3, ""), (None, "yes")],
                                "item_id long, text string")
    got = sorted((r.doc_id, str(r.item_id), r.matched) for r in d.leaks(docs, items).collect())
    assert got == [(1, "1", 6), (3, "2", 1), (3, "None", 1), (5, "None", 10)]
    assert sorted(r.doc_id for r in d.drop_leaks(docs, items).collect()) == [2, 4]
