"""Language identification: held-out accuracy and defined results."""

import numpy as np
from pyspark.sql import functions as F

from bundleflow.llm import langid
from bundleflow.llm.common import holdout


def test_held_out_accuracy(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, train=langid.train_rows())
    rows = docs.filter(holdout("doc_id", 4, 2) & F.col("lang").isNotNull())
    got = langid.identify(rows, model).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert 0.2 < (model.matrix == 0).mean() < 1  # the L1 penalty leaves most weights at zero


def test_odd_rows(odd_docs, no_docs, llm):
    model = langid.fit(odd_docs)
    got = langid.identify(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert all(r.lang_pred in ("en", "de", "fr") for r in rows if r.doc_id in (1, 5, 6, 7, 8))
    empty = langid.fit(no_docs)
    assert empty.languages == [] and langid.identify(no_docs, empty).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs, empty).collect()} == {"und"}


def test_letters():
    assert langid.has_letter("12 漢") and langid.has_letter("é") and not langid.has_letter("12 _!² 🙂")


def test_chunks_count_once(monkeypatch):
    text = "Ein längerer Text, der über mehrere Stücke geht, und noch etwas mehr davon."
    whole = langid.term_counts(text)
    assert whole.sum() > 0
    monkeypatch.setattr(langid, "CHUNK_CHARS", 10)
    parts = langid.term_counts(text)
    # runs of other characters at a cut may count apart; letters do not
    assert np.abs(whole - parts).sum() <= 0.1 * whole.sum()


def test_temperature_is_calibrated():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3)) * 2
    p = langid.softmax(logits)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert 3.0 < langid._temperature(logits * 4, y) < 5.3


def test_rarity_and_prediction_equal_plain_sums(llm):
    """Document frequencies, TF-IDF, rarity and the logit by plain loops over n-grams."""
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs)
    texts = [r.text for r in docs.filter("text IS NOT NULL AND lang IS NOT NULL").collect()]

    def grams(text):
        found = {}
        for b in langid.ngram_buckets(text).tolist():
            found[b] = found.get(b, 0) + 1
        return found

    df = {}
    for t in texts:
        for b in grams(t):
            df[b] = df.get(b, 0) + 1
    idf = {b: float(np.log((1 + len(texts)) / (1 + df.get(b, 0))) + 1) for b in range(1 << langid.BITS)}
    assert np.allclose(model.idf, [idf[b] for b in range(1 << langid.BITS)])
    rows = langid.identify(docs.filter("text IS NOT NULL"), model, rarity_out="rarity").limit(25).collect()
    for r in rows:
        if not langid.has_letter(r.text):
            continue
        found = grams(r.text)
        assert np.isclose(r.rarity, sum(c * idf[b] for b, c in found.items()) / sum(found.values()))
        v = {b: (1 + np.log(c)) * idf[b] for b, c in found.items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        logits = [sum(x / norm * model.matrix[b, k] for b, x in v.items()) + model.matrix[-1, k]
                  for k in range(len(model.languages))]
        e = np.exp((np.array(logits) - max(logits)) / model.temperature)
        assert r.lang_pred == model.languages[int(np.argmax(e))] and np.isclose(r.score, (e / e.sum()).max(), atol=1e-6)


def test_learner_step_by_hand():
    """Two steps of FTRL-proximal, weight by weight."""
    learner = langid.Ftrl(3, alpha=0.3, beta=1.0, l1=1e-3, l2=1e-2)
    z, n = {}, {}

    def weight(i, k):
        a, b = z.get((i, k), 0.0), n.get((i, k), 0.0)
        return 0.0 if abs(a) <= 1e-3 else -(a - np.sign(a) * 1e-3) / ((1.0 + b ** 0.5) / 0.3 + 1e-2)

    for at, v, y in (([3, 9], [0.6, 0.8], 1), ([3, 4], [1.0, 0.2], 2), ([3, 9], [0.5, 0.5], 1)):
        learner.step(np.array(at), np.array(v), y)
        full = list(zip(at + [1 << langid.BITS], v + [1.0]))
        w = {(i, k): weight(i, k) for i, _ in full for k in range(3)}
        p = langid.softmax(np.array([sum(x * w[i, k] for i, x in full) for k in range(3)]))
        for i, x in full:
            for k in range(3):
                g = x * (p[k] - (k == y))
                old = n.get((i, k), 0.0)
                z[i, k] = z.get((i, k), 0.0) + g - ((old + g * g) ** 0.5 - old ** 0.5) / 0.3 * w[i, k]
                n[i, k] = old + g * g
    for (i, k), value in z.items():
        assert np.isclose(learner.z[i, k], value) and np.isclose(learner.n[i, k], n[i, k])
