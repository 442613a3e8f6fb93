"""Quality rules: statistics against brute force, learned lists on held-out rows."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from bundleflow.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    held = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(held))


def test_statistics():
    rng = random.Random(6)
    for _ in range(800):
        text = "".join(rng.choice(["a", "b", "cé ", " ", "\n", "\r", "#", "a b c ", "🙂"]) for _ in range(rng.choice((0, 3, 30, 80))))
        assert q.statistics(text)[:5] == brute(text), repr(text)


def test_rules_on_held_out_rows():
    rng = np.random.default_rng(3)
    x = {f: rng.random(4000) for f in q.FEATURES}
    low = (x["repeats"] > 0.8) | ((x["symbols_per_word"] > 0.7) & (x["upper"] > 0.5))
    rules = q.learn_rules({k: v[:2000] for k, v in x.items()}, low[:2000], np.arange(2000) % 3 == 0)
    hit = np.zeros(4000, dtype=bool)
    for r in rules:
        hit |= q._covered(r, x, 4000)
    assert (hit[2000:] == low[2000:]).mean() > 0.97
    assert 2 <= len(rules) <= q.MAX_RULES


def test_documents(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = q.text_statistics(docs).cache()
    rules = q.fit(stats, labels)
    rows = q.judge(stats, rules).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert np.mean([r.kept for r in clean]) > 0.97


def test_odd_rows(odd_docs, no_docs, llm):
    stats = q.text_statistics(odd_docs)
    rows = q.judge(stats, []).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    nothing = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.fit(stats, nothing) == []
    assert q.fit(stats, llm.createDataFrame([(1, 0, None), (1, 0, 1), (None, 1, 0), (5, None, 0)], nothing.schema)) == []
    assert q.text_statistics(no_docs).count() == 0


def test_verdict_is_one_case_expression(llm):
    rule = (q.Condition("repeats", True, 0.5), q.Condition("upper", False, 0.1))
    other = (q.Condition("symbols_per_word", True, 1.0),)
    stats = llm.createDataFrame([(10, 40, 0, 0, 6, 1, 2, 0, 0), (10, 40, 10, 0, 0, 1, 9, 0, 0), (0, 0, 0, 0, 0, 0, 0, 0, 0)],
                                ", ".join(f"{c} long" for c in q.COUNTS))
    got = [r.v for r in stats.select(q.verdict_column([rule, other]).alias("v")).collect()]
    assert got == ["repeats >= 0.5 and upper <= 0.1", "symbols_per_word >= 1", None]
    assert F.col("x") is not None
