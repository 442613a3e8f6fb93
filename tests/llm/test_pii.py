"""Personal data: base kinds against the plain patterns, and the bootstrapped kind."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from bundleflow.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    double = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(digits[::-1])]
    return sum(v - 9 if v > 9 else v for v in double) % 10 == 0


def brute(text):
    out = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [(s, k, e) for s, _, k, e in sorted(out)]


def test_random_texts():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1.2@0-+ ()5%_:é") for _ in range(rng.choice((5, 25, 70))))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_fast():
    for text in ("a" * 200_000, "1" * 200_000, "+1" * 100_000, "1." * 100_000, "a=" * 50_000, "@" * 100_000):
        pii.labelled_values(text, pii.base_spans(text))


def test_digest(odd_docs, no_docs, llm):
    extra = llm.createDataFrame([(20, "🙂 mail a.b@c.example.org, card 4111 1111 1111 1111 +1 (555) 010-9999; 10.0.0.1")],
                                "doc_id long, text string")
    docs = odd_docs.unionByName(extra, allowMissingColumns=True)
    rows = pii.digest(pii.find(docs)).collect()
    want = sorted((str(r.doc_id), ",".join(f"{k}:{s}:{e}" for s, k, e in brute(r.text or ""))) for r in docs.collect())
    assert sorted((str(r.doc_id), r.spans) for r in rows) == want
    assert all(r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() for r in rows)
    one = next(r for r in rows if r.doc_id == 20)
    assert (one.n_email, one.n_card, one.n_phone, one.n_ip) == (1, 1, 1, 1)
    assert pii.digest(pii.find(no_docs)).count() == 0


def bootstrapped(llm):
    """A label learned from seeds finds other identifiers; they in turn teach a second label."""
    rows = [(k, f"Please write to contact: user{k}@mail.example.com today") for k in range(12)]
    rows += [(20 + k, f"Please write to contact: ID-77{k}0-99 today") for k in range(6)]
    rows += [(40 + k, f"and member no: ID-77{k % 6}0-99 as before") for k in range(6)]
    rows += [(60, "and member no: ZZ-123456 is new"), (61, "version: 1.2.3456 of it"), (62, "contact: nobody here")]
    return llm.createDataFrame(rows, "doc_id long, text string")


def test_bootstrapping_reaches_unseen_identifiers(llm):
    docs = bootstrapped(llm)
    text = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: [text[r.doc_id][s["start"]:s["end"]] for s in r.more] for r in pii.find(docs).collect()}
    assert found[20] == ["ID-7700-99"] and found[40] == ["ID-7700-99"]
    assert found[61] == [] and found[62] == [] and found[0] == []


def test_redact(llm, odd_docs, no_docs):
    docs = bootstrapped(llm).withColumns({"n_chars": F.length("text").cast("long"), "more": F.lit("clash")})
    rows = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert rows[0].text == "Please write to contact: [EMAIL] today" and rows[0].n_chars == len(rows[0].text)
    assert rows[20].text == "Please write to contact: [ID] today" and rows[20].more == "clash"
    same = pii.redact(odd_docs)
    assert same.columns == odd_docs.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.redact(no_docs).count() == 0


def test_mask_overlaps():
    assert pii.mask("abcdefgh", [(0, "x", 3), (2, "y", 5), (6, "z", 7)]) == "[X]f[Z]h"
    assert pii.mask("abc", [(0, "x", 3)]) == "[X]"


def found_values(docs):
    text = {r.doc_id: r.text for r in docs.collect()}
    return {r.doc_id: [text[r.doc_id][s["start"]:s["end"]] for s in r.more] for r in pii.find(docs).collect()}


def test_patterns_from_prose_cells_and_other_scripts(llm):
    """Contexts without a label and mark, read from the seeds; values are whole."""
    rows = [(k, f"you can call me on user{k}@mail.example.com after lunch") for k in range(12)]
    rows += [(20, "you can call me on AB-123456 after lunch"), (21, "you can call me on AB 12 34 56 after lunch")]
    rows += [(100 + k, f"| name | 10.0.{k}.1 | paid") for k in range(12)] + [(120, "| name | QX/778899 | paid")]
    rows += [(200 + k, f"会员号：user{k}@mail.example.org") for k in range(12)] + [(220, "会员号：ZZ-445566")]
    rows += [(300, "the year 2024-25 was long"), (301, "you can walk on paths-2024 there")]
    rows += [(400 + k, f"they walk on {'abcdefghijklmnopqrstuvwxyz'[k]}oads again") for k in range(26)]
    found = found_values(llm.createDataFrame(rows, "doc_id long, text string"))
    assert found[20] == ["AB-123456"] and found[21] == ["AB 12 34 56"]
    assert found[120] == ["QX/778899"] and found[220] == ["ZZ-445566"]
    assert found[0] == found[100] == found[200] == found[300] == found[301] == []


def test_words_rule_out_a_pattern(llm):
    """A context that mostly holds plain words teaches nothing, however many seeds it holds."""
    rows = [(k, f"we saw user{k}@mail.example.com there") for k in range(8)]
    rows += [(100 + k, f"we saw {'abcdefghijklmnopqrstuvwxyz'[k]}ord there") for k in range(26)]
    rows += [(200, "we saw AB-123456 there")]
    assert found_values(llm.createDataFrame(rows, "doc_id long, text string"))[200] == []


def plain_bootstrap(texts, rounds=20):
    """The scoring as plain loops over all words, all patterns and all values."""
    edges, others = {}, {}
    for text in texts:
        base = pii.base_spans(text)
        for p, v, _, _, role in pii.labelled_values(text, base):
            old = edges.get((p, v), (0, 0))
            edges[p, v] = (max(old[0], role), old[1] + 1)
        taken = [(s, e) for s, _, e in base] + pii.identifiers(text, base)
        for m in pii._WORD.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                for p in pii.patterns_at(text, *m.span()):
                    others[p] = others.get(p, 0) + 1
    width = {}
    for p, _ in edges:
        width[p] = width.get(p, 0) + 1
    edges = {k: v for k, v in edges.items() if width[k[0]] >= pii.MIN_SUPPORT}
    scores, accepted = {}, -1
    for _ in range(rounds):
        sums = {}
        for (p, v), (role, times) in edges.items():
            score = 1.0 if role == 2 else scores.get(v, 0.0)
            good, worth, support = sums.get(p, (0, 0, 0))
            sums[p] = (good + score * times, worth + times * (0.5 if role == 1 and not score else 1.0),
                       support + (score >= pii.ACCEPT))
        sure = {p: g / (w + others.get(p, 0)) for p, (g, w, s) in sums.items() if s >= pii.MIN_SUPPORT}
        left = {}
        for (p, v), (role, _) in edges.items():
            if role == 1 and sure.get(p, 0) >= pii.MIN_CONFIDENCE:
                left[v] = left.get(v, 1.0) * max(1 - sure[p], 1e-9)
        scores = {v: 1 - x for v, x in left.items()}
        now = sum(s >= pii.ACCEPT for s in scores.values())
        if now <= max(accepted, 0):
            break
        accepted = now
    return {v for v, s in scores.items() if s >= pii.ACCEPT}


def test_spans_equal_plain_loops(llm):
    """Several rounds, common contexts, copies, contexts of marks and of both sides."""
    rng = random.Random(11)
    words = ["the", "of", "member", "no", "card", "on", "call", "|", "-", ":", "x1", "ΟΔΟΣ", "会", "12", '"']
    texts = []
    for k in range(500):
        parts = []
        for _ in range(rng.randint(1, 14)):
            parts.append(rng.choice(words))
            kind = rng.random()
            if parts[-1] in ("no", ":", "|") and kind < 0.7:
                parts.append(rng.choice([f"u{rng.randrange(40)}@m.example.org", f"ID-{rng.randrange(30):05}",
                                         f"10.1.2.{rng.randrange(99)}", "9" * 90 + str(rng.randrange(3))]))
            elif kind < 0.02:
                parts.append(f"REF-{rng.randrange(9):06}")
        texts.append(" ".join(parts))
    texts += texts[:120] + ["member no ID-00001 " * 200]
    want = plain_bootstrap(texts)
    assert 5 < len(want)
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = found_values(docs)
    for k, text in enumerate(texts):
        all_ = [text[s:e] for s, e in pii.identifiers(text, pii.base_spans(text))
                if pii._name(text[s:e]) in want and pii.patterns_at(text, s, e)]
        assert got[k] == all_, text


def test_growth_of_counted_rows(llm):
    """A task gives one row for each pattern, however many words follow it."""
    texts = llm.createDataFrame([(f"call the w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} now",) for i in range(600)],
                                "text string")
    rows = pii._counted(texts.coalesce(1), ["< the", "< the call", "> now", "< never"]).collect()
    assert sorted(map(tuple, rows)) == [("< the", 600), ("< the call", 600), ("> now", 600)]
