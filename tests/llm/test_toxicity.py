"""Toxicity: the automaton against plain edit distance, context windows, held-out labels."""

import random

import numpy as np
from pyspark.sql import functions as F

from bundleflow.llm import toxicity as t
from bundleflow.llm.common import holdout


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(4)
    word = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randint(lo, hi)))
    for _ in range(30):
        words, stems = [word(3, 11) for _ in range(6)], [word(4, 8) for _ in range(2)]
        automaton = t.LexiconAutomaton(words, stems)
        for _ in range(200):
            token = word(1, 13)
            near = [d for w in words if (d := edit_distance(token, w)) <= t.edits_allowed(len(w), False)]
            for s in stems:
                near += [d for k in range(len(token) + 1)
                         if (d := edit_distance(token[:k], s)) <= t.edits_allowed(len(s), True)]
            assert automaton.distance(token) == min(near, default=-1), (words, stems, token)


def test_states_are_bounded(monkeypatch):
    monkeypatch.setattr(t, "STATES", 20)
    automaton = t.LexiconAutomaton(["worthless", "idiot"], [])
    assert [automaton.distance(w) for w in ("worthless", "w0rthles", "idiot", "idjot", "clean") * 5] == [0, 2, 0, 1, -1] * 5


def test_empty_lexicon():
    assert t.LexiconAutomaton([], []).distance("any") == -1
    assert 0 <= t.Scorer(t.Model()).score("any text") < 0.5


def test_context_windows():
    s = t.Scorer(t.Model(["idiot"], [], frozenset({"idiom"})))
    kinds = lambda text: [round(float(np.expm1(v))) for v in s.features(text)[1:4]]
    assert kinds("you idiot !") == [1, 0, 0]
    assert kinds("you 1diot and IDI0T, idiom") == [0, 2, 0]
    assert kinds('someone "that idiot there" left') == [0, 0, 1]
    assert kinds("the word idiot is old") == [0, 0, 1]
    assert s.score("you idiot") > 0.5 > s.score("the word idiot is old and so on") and s.score("") < 0.5


def test_held_out_labels(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = holdout("doc_id", 3, 1)
    model = t.fit(docs, labels, train=~out)
    rows = t.score(docs.filter(out).join(labels, "doc_id"), model).collect()
    toxic, clean = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([s >= 0.7 for s in toxic]) > 0.7 and np.mean([s >= 0.7 for s in clean]) < 0.02


def test_odd_rows(odd_docs, no_docs, llm):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = t.fit(odd_docs, none)
    assert model.words == [] and t.score(no_docs, model).count() == 0
    some = llm.createDataFrame([(1, 1, 1), (1, 1, None), (None, 1, 1), (6, 1, 0), (9, 1, 0)], none.schema)
    model = t.fit(odd_docs, some)
    got = t.score(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert got.filter(F.col("doc_id").isin(2, 3)).select("score").distinct().count() == 1


def test_long_tokens_and_large_lexicons(llm):
    """Tokens that share 64 characters stay apart, and every entry of a lexicon is used."""
    long = "x" * 80
    automaton = t.LexiconAutomaton([long + "bad", *(f"entry{i}" for i in range(5000))], [])
    scorer = t.Scorer(t.Model([long + "bad"], []))
    assert scorer._code(long + "bad") == 1 and scorer._code(long + "completely") == 0
    assert scorer.features(f"{long}bad {long}completely")[1] > 0
    assert all(automaton.distance(f"entry{i}") == 0 for i in range(5000))
    rows = [(i, " ".join(f"foul{chr(97 + i % 26)}{k}z" for k in range(i % 7 * 400, i % 7 * 400 + 400)) + " text", 1) for i in range(84)]
    rows += [(1000 + i, f"clean words of row {i} and more text", 0) for i in range(200)]
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = t.fit(docs, labels)
    assert len(model.words) + len(model.stems) > 0
    found = t.score(docs, model, keep=["doc_id"]).collect()
    assert all((r.score > 0.5) == (r.doc_id < 1000) for r in found)


def test_scores_equal_plain_counting(llm):
    """Features and score of whole documents, counted token by token in their windows."""
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = t.fit(docs, llm.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    model = t.Model(model.words + ["worthless"], model.stems, model.spared, model.coef)
    automaton = t.LexiconAutomaton(model.words, model.stems)
    texts = [r.text or "" for r in docs.limit(60).collect()]
    texts += ['He said "you are worthles, friend" and left', "worthless worthless2 the word worthless", "", "worthless"]

    def plain(text):
        raw, counts = text.lower().split(), {"abuse": 0, "misspelt": 0, "quoted": 0}
        for i, token in enumerate(raw):
            core = token.strip(t.PUNCTUATION)
            d = automaton.distance(core)
            if d < 0 or (d > 0 and core in model.spared):
                continue
            opened = any(w[:1] in t.QUOTES for w in raw[max(0, i - t.WINDOW):i + 1])
            ends = [w.rstrip(".,;:!?") for w in raw[i:i + t.WINDOW + 1]]
            closed = any(w and w[-1] in t.QUOTES for w in ends)
            told = any(w.strip(t.PUNCTUATION) in t.REPORTING for w in raw[max(0, i - 3):i + 4])
            counts["quoted" if (opened and closed) or told else "abuse" if d == 0 else "misspelt"] += 1
        share = 100 * (counts["abuse"] + counts["misspelt"]) / max(len(raw), 1)
        x = [1, *(np.log(1 + counts[k]) for k in ("abuse", "misspelt", "quoted")), np.log(1 + share)]
        return 1 / (1 + np.exp(-max(-40, min(40, sum(a * b for a, b in zip(x, model.coef))))))

    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in t.score(rows, model, keep=["doc_id"]).collect()}
    assert len(got) == len(texts) and all(np.isclose(got[i], plain(x)) for i, x in enumerate(texts))
    assert got[len(texts) - 1] > 0.5 > got[len(texts) - 2]
