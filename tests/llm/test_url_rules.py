"""URL rules against a brute-force reading of every rule."""

import re

from bundleflow.llm import url_rules as u


def brute(url, hosts=u.BASE_RULES, globs=u.PATTERN_RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(str.maketrans(u.UPPER, u.LOWER))
    fit = [r for r in hosts if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        best = max(fit, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    hit = [r for r in globs if re.search(r.pattern.removeprefix("(?s)"), host + path, re.S)]
    return host, path, None, max(hit, key=lambda r: len(r.text)).verdict if hit else "allow"


URLS = ["http://EXAMPLE.net/en/x", "https://a.b.example.net/en", "http://notexample.net/en/", "http://example.com/de/1?q#f",
        "http://example.com/DE/1", "http://x.org/fr/", "ftp://org/fr/a://b", "http://spam-farm.example.org/en/1",
        "http://my-spam-farm.example.org/", "http://aspam-farm.example.org/", "http://cheap-pills.example.com/en/450?page=2",
        "http://x.casino/", "http://x.casinos/", "http://a.com/login", "http://a.com/loginx", "http://a.com/tag/x/page/2",
        "http://a.com/tag/page/2", "no url", "", None, "http://", "http://net", "http://net/", "http://a.net:80/", "://net/?x",
        "http://h/a\nb?c", "http://ads.example.com/x", "http://roads.example.com/x"]


def test_against_brute_force(llm):
    rows = [(k, x, "h") for k, x in enumerate(URLS)] + [(0, URLS[0], "h"), (None, URLS[1], None)]
    df = llm.createDataFrame(rows, "page_id long, url string, html string").withColumnsRenamed({"html": "host"})
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in u.judge_urls(df).collect()]
    want = [(k, *brute(x)) for k, x, _ in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert u.judge_urls(df.limit(0)).count() == 0


def test_rules_without_tokens_and_shuffled_index(llm, monkeypatch):
    monkeypatch.setattr(u, "BROADCAST_BYTES", 0)
    globs = (u.PatternRule("*xy*", "block"), u.PatternRule("/a^", "block"))
    df = llm.createDataFrame([(1, "http://axyb/"), (2, "http://h/a"), (3, "http://h/ab")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.pattern) for r in u.judge_urls(df, (), globs).collect()}
    assert got == {1: ("block", "*xy*"), 2: ("block", "/a^"), 3: ("allow", None)}
    assert {r.verdict for r in u.judge_urls(df, (), ()).collect()} == {"allow"}


def test_index_takes_the_rarest_token(llm):
    df = llm.createDataFrame([(k, f"http://common.host/rare{k}") for k in range(5)], "page_id long, url string")
    urls = df.selectExpr("split('common.host.rare1', '[.]') AS tokens").limit(4).unionAll(
        df.selectExpr("array('common') AS tokens"))
    rules = u._rule_table(llm, [u.PatternRule("^common.rare1^", "block")], "pattern")
    assert [r.token for r in u.rarest_token_index(urls, rules, True).collect()] == ["rare1"]


def test_native(llm):
    df = llm.createDataFrame([(1, "http://h/")], "page_id long, url string")
    plan = u.judge_urls(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_rules_and_very_long_urls(llm, monkeypatch):
    """Hundreds of rules of both kinds over urls of a hundred thousand characters, broadcast and shuffled alike."""
    rng = __import__("random").Random(6)
    words = [f"w{i}" for i in range(12)]
    hosts = tuple(u.HostRule(f"{rng.choice(words)}.{rng.choice(words)}", f"/{rng.choice(words)}" * rng.randint(0, 2) or "/",
                             rng.choice(("block", "allow"))) for _ in range(50))
    globs = tuple(u.PatternRule(f"^{rng.choice(words)}*{rng.choice('/.-')}{rng.choice(words)}^", rng.choice(("block", "allow")))
                  for _ in range(60))
    hosts = tuple({r.text: r for r in hosts}.values())
    globs = tuple({r.text: r for r in globs}.values())
    urls = ["http://" + ".".join(rng.choice(words) for _ in range(3)) + "".join(
        f"{rng.choice('/-.')}{rng.choice(words)}" for _ in range(rng.randint(0, 6))) + rng.choice(("", "?q=w1", "#w2")) for _ in range(150)]
    urls += ["http://w1.w2/" + "x" * 100_000, "http://" + "w3." * 5_000 + "w4/w5"]
    df = llm.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def verdicts():
        return sorted((r.page_id, r.rule, r.verdict) for r in u.judge_urls(df, hosts, globs).collect())

    got = verdicts()
    for (k, rule, verdict), url in zip(got, urls):
        host, path, want_rule, want = brute(url, hosts, globs)
        assert rule == want_rule and (rule is not None or not any(  # ties of one length go to block
            re.search(r.pattern.removeprefix("(?s)"), host + path, re.S) for r in globs) or verdict in ("block", "allow"))
        if rule is not None:
            assert verdict == want
    assert any(v == "block" for _, _, v in got) and any(r for _, r, _ in got)
    assert u.rule_bytes(hosts + globs) > 100 * len(hosts + globs)
    monkeypatch.setattr(u, "BROADCAST_BYTES", 0)
    assert verdicts() == got
