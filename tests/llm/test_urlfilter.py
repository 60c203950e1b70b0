from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from causeway.llm import urlfilter
from causeway.llm.queries import QUERIES, URL_RULES
from tests.llm.data import lowered, table


def parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = lowered(rest[:n]), rest[n:]
    m = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:m]


def rule_of(host, path, rules=URL_RULES):
    fits = []
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def ratios(urls, order=urlfilter.ORDER):
    """Per label the interpolated probability of a symbol in a context, from (url, label) pairs."""
    counts = {label: [defaultdict(Counter) for _ in range(order + 1)] for label in (0, 1)}
    for url, label in urls:
        text = urlfilter.PAD * order + url.lower() + urlfilter.END
        for i in range(order, len(text)):
            for k in range(order + 1):
                counts[label][k][text[i - k:i]][text[i]] += 1

    def p(label, context, symbol):
        out = urlfilter.UNIFORM
        for k in range(order + 1):
            own = counts[label][k].get(context[len(context) - k:] if k else "")
            if own:
                out = (own[symbol] + len(own) * out) / (sum(own.values()) + len(own))
        return out

    def score(url):
        text = urlfilter.PAD * order + url.lower() + urlfilter.END
        logs = [math.log(p(1, text[i - order:i], text[i])) - math.log(p(0, text[i - order:i], text[i])) for i in range(order, len(text))]
        return sum(logs) / len(logs)

    return score


@pytest.mark.parametrize("hot", [50_000, 20, 0])
def test_scores(spark, sf, monkeypatch, hot):
    """The tables and joins give the recursion's values, whichever n-grams are broadcast."""
    monkeypatch.setattr(urlfilter, "HOT_GRAMS", hot)
    urls = sorted({u or "" for (u,) in table(sf, "pages", "url")})[:120] + ["", "é://日本/x", "http://a" + "b" * 3000]
    rows = [(u, None if i % 3 == 0 else i % 3 - 1) for i, u in enumerate(urls)]
    frame = urlfilter.with_grams(spark.createDataFrame(rows, "url string, label int"))
    found = {r.url: r.score for r in urlfilter.url_scores(frame, urlfilter.gram_ratios(frame)).collect()}
    score = ratios([r for r in rows if r[1] is not None])
    assert set(found) == set(urls)
    for url in urls:
        assert found[url] == pytest.approx(score(url), abs=1e-9)


def test_query(spark, sf):
    found = QUERIES["op7_url_filter"](spark, sf).collect()
    pages = dict(table(sf, "pages", "page_id, url"))
    assert len(found) == len(pages) == len({r.page_id for r in found})
    least = [r.score for r in found if r.rule is None and r.verdict == "allow"]
    most = [r.score for r in found if r.rule is None and r.verdict == "block"]
    assert not least or not most or min(least) >= max(most)
    for r in found:
        host, path = parts(pages[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None or r.verdict == verdict


def test_labelled_urls_are_told_apart(spark, sf):
    """Held-out labels: URLs that rules judge, scored as if they had no rule."""
    pages = [u for (u,) in table(sf, "pages", "url")]
    known = [(u, 1 if rule_of(*parts(u))[1] == "allow" else 0) for u in sorted(set(pages)) if rule_of(*parts(u))[1]]
    score = ratios(known[::2])
    right = sum((score(u) > 0) == (label == 1) for u, label in known[1::2])
    assert right >= 0.75 * len(known[1::2])


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG/x", "ftp://b.org", "http://x.example.org/es/1", "http://example.org/en/1", "http://é.com/fr/",
            "://com/de/?q://z", "http://a.net/" + "p" * 5000, "http://a.net?x", "http://a.net#y", "http://a.net/\n/z?k", "http://forg/x"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, "http://")] * 2 + [(None, "http://q.org/")]
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "page_id bigint, url string, host int, score string, gram string")
    found = urlfilter.judge(frame, URL_RULES).collect()
    want = Counter((i, *parts(u), rule_of(*parts(u))[0]) for i, u in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in found) == want
    assert {r.verdict for r in found} <= {"allow", "block"}
    assert urlfilter.judge(frame.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in urlfilter.judge(frame, ()).collect()} == {"allow"}
    assert {r.verdict for r in urlfilter.judge(frame, (("block", "nowhere.test/"),)).collect()} == {"allow"}
