from __future__ import annotations

import math
import re

import numpy as np
import pytest

from basketry.llm.queries import URL_RULES
from basketry.llm.url_filter import url_filter


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for h, p, says in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, says)
    return best or (None, None)


def strength(groups):
    n, bad, k = sum(a for a, _ in groups), sum(b for _, b in groups), len(groups)
    if not n:
        return 99.0
    mu = bad / n
    below = mu * (1 - mu) * (n - sum(a * a for a, _ in groups) / n - (k - 1))
    rho = 0.01
    if below > 0:
        spread = sum(a * (b / a - mu) ** 2 for a, b in groups)
        rho = min(0.5, max(0.001, (spread - mu * (1 - mu) * (k - 1)) / below))
    return (1 - rho) / rho


def brute(pages, outcomes, max_bad=0.5):
    host, domain, suffix = {}, {}, {}
    for url, bad in outcomes:
        if bad is None:
            continue
        h = split(url)[0]
        for table, key in ((host, h), (domain, ".".join(h.split(".")[-2:])), (suffix, h.split(".")[-1])):
            n, b = table.get(key, (0, 0))
            table[key] = (n + 1, b + bad)
    n = sum(a for a, _ in host.values())
    overall = sum(b for _, b in host.values()) / n if n else 0
    k1, k2, k3 = (strength(list(t.values())) for t in (suffix, domain, host))
    out = []
    for page, url in pages:
        h, p = split(url)
        sn, sb = suffix.get(h.split(".")[-1], (0, 0))
        dn, db = domain.get(".".join(h.split(".")[-2:]), (0, 0))
        hn, hb = host.get(h, (0, 0))
        rate = (k1 * overall + sb) / (k1 + sn)
        rate = (k2 * rate + db) / (k2 + dn)
        rate = (k3 * rate + hb) / (k3 + hn)
        bound = rate - 1.6449 * math.sqrt(rate * (1 - rate) / (k3 + hn + 1))
        rule, says = rule_of(h, p)
        out.append((page, h, p, rule, says or ("block" if bound > max_bad else "allow"),
                    pytest.approx(rate), pytest.approx(bound)))
    return out


URLS = [None, "", "no scheme.com/x", "http://", "http://A.Example.NET", "http://a.example.net/en/x?q=/de/#f",
        "http://example.net?x", "https://x.org/fr/#t", "https://xorg/fr/", "ftp://notexample.com/de/",
        "http://example.com/de/://b.net/", "://net/", "http://B.Good.com:80/é#", "http://u@h/", "http://É.COM/Fr",
        "http://s.x.co.uk/", "http://a\nb.com/x\ny", "http://h.com#/en/", "http://h.com/a?://z"]


def run(spark, pages, outcomes, **options):
    p = spark.createDataFrame([(i, u, "r", 1.0) for i, u in pages],
                              "page_id bigint, url string, rule string, bound double")
    o = spark.createDataFrame([(u, b, "h") for u, b in outcomes], "url string, bad int, host string")
    return [tuple(r) for r in url_filter(p, o, URL_RULES, **options).orderBy("page_id").collect()]


def test_parts_rules_and_reputation(spark):
    rng = np.random.default_rng(4)
    pages = list(enumerate([u for u in URLS if u != "http://s.x.co.uk/"]))
    hosts = [f"h{i}.d{i % 7}.com" for i in range(40)] + [f"h{i}.bad.info" for i in range(6)]
    pages += [(100 + i, f"http://{h}/p") for i, h in enumerate(hosts)]
    outcomes = [(f"http://{h}/x{j}", int(rng.random() < (0.95 if "bad" in h else 0.1)))
                for h in hosts[:43] for j in range(int(rng.integers(0, 60)))]
    outcomes += [("http://h1.d1.com/", None), (None, 1)]
    got = run(spark, pages, outcomes)
    assert got == brute(pages, outcomes)
    verdicts = {h: r[4] for r in got for h in [r[1]]}
    assert verdicts["h0.bad.info"] == "block" and verdicts["h0.d0.com"] == "allow"
    assert verdicts["h5.bad.info"] == "block"      # no outcomes of its own: its domain's


def test_two_label_suffixes(spark):
    outcomes = [("http://a.x.co.uk/", 1)] * 60 + [("http://b.y.co.uk/", 0)] * 60
    got = run(spark, [(1, "http://new.x.co.uk/"), (2, "http://new.y.co.uk/")], outcomes)
    assert [r[4] for r in got] == ["block", "allow"]


def test_suffixes_are_a_parameter(spark):
    outcomes = [("http://a.x.com.tr/", 1)] * 60 + [("http://b.y.com.tr/", 0)] * 60
    pages = [(1, "http://new.x.com.tr/"), (2, "http://new.y.com.tr/")]
    assert [r[4] for r in run(spark, pages, outcomes)] == ["allow", "allow"]      # one domain, com.tr
    assert [r[4] for r in run(spark, pages, outcomes, suffixes=("com.tr",))] == ["block", "allow"]


def test_repeated_pages(spark):
    pages = [(1, "http://a.com/"), (1, "http://a.com/"), (2, "http://x.net/"), (None, "http://a.com/")]
    got = [(r[0], r[4]) for r in run(spark, pages, [("http://a.com/", 1)] * 90 + [("http://b.org/", 0)] * 90)]
    assert got == [(None, "block"), (1, "block"), (1, "block"), (2, "block")]


def test_without_outcomes_and_without_pages(spark):
    pages = list(enumerate(URLS))
    assert {r[4] for r in run(spark, pages, []) if r[3] is None} == {"allow"}
    assert run(spark, [], [("http://a.com/", 1)]) == []
