"""Parsing and rules in plain Python, ranks against a dense solution, and edge cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradescope.llm import url_filter as W


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, h, p in W.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best or (None, None)


def dense(rows):
    """(trust, distrust) in pages by host, from the linear equations."""
    judged = [(*plain_parts(u), h) for _, u, h in rows]
    pages = Counter(x[0] for x in judged)
    seeds = {k: Counter() for k in ("allow", "block")}
    weight = defaultdict(float)
    for host, path, html in judged:
        if (v := plain_rule(host, path)[1]) is not None:
            seeds[v][host] += 1
        for target in {m.lower() for m in re.findall(W.LINK, html or "")}:
            if host and target != host:
                weight[host, target] += 1
    for host in pages:
        parent = host.partition(".")[2]
        if host and parent in pages and parent:
            weight[host, parent] += W.PARENT_WEIGHT
            weight[parent, host] += W.PARENT_WEIGHT
    names = sorted({*pages, *(x for e in weight for x in e)})
    at = {x: k for k, x in enumerate(names)}
    out = []
    for kind, flip in (("allow", False), ("block", True)):
        m = np.zeros((len(names), len(names)))
        for (a, b), w in weight.items():
            m[(at[a], at[b]) if flip else (at[b], at[a])] += w
        m = m / np.where(m.sum(axis=0) > 0, m.sum(axis=0), 1)
        total = sum(seeds[kind].values())
        s = np.array([seeds[kind][x] / total if total else 0.0 for x in names])
        r = np.linalg.solve(np.eye(len(names)) - W.DAMPING * m, (1 - W.DAMPING) * s)
        out.append(r / r.sum() * total if total else r)
    return {x: (out[0][at[x]], out[1][at[x]]) for x in pages}, pages


def check(got, rows):
    ranks, pages = dense(rows)
    want = Counter()
    for page_id, url, _ in rows:
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        trust, distrust = ranks[host]
        if verdict is None:
            verdict = "block" if distrust > trust and distrust >= pages[host] * W.THRESHOLD else "allow"
        want[page_id, host, path, rule, verdict] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want
    for r in got:
        assert (r.trust, r.distrust) == pytest.approx(ranks[r.host], abs=1e-3)


def link(*targets):
    return "".join(f'<a HREF="{t}">x</a>' for t in targets)


ROWS = [
    (1, "http://bad.net/x", link("https://FRIEND.example.com/a", "//other.example.org/b?c", "/own", "rel.html")),
    (2, "http://Friend.Example.COM/en/1?x=/de/", link("http://bad.net/", "http://bad.net/2", "mailto:a@b.co")),
    (3, "https://friend.example.com", link("http://bad.net")),
    (4, "https://other.example.org/fr/1", link("https://nice.example.org/")),
    (5, "https://nice.example.org/de/1#/fr/", None),
    (6, "https://m.example.net/en/1", link("http://nice.example.org/a")),
    (7, "https://m.example.net", ""),
    (8, "https://m.example.net/EN/1", ""),
    (9, "https://www.friend.example.com/de/1", ""),
    (10, "https://example.com/de/", ""),
    (11, "https://example.com/fr/", ""),
    (12, "https://spam.example.io/a", link("http://bad.net/", "https://www.friend.example.com/de/")),
    (12, "https://spam.example.io/a", link("http://bad.net/", "https://www.friend.example.com/de/")),
    (13, None, None),
    (14, "no scheme/net/", link("http://bad.net/")),
    (None, "ftp://user@host.org:21/fr/x", ""),
    (15, "x://?q://y.net/", ""),
    (16, "http://notnet/a", ""),
    (17, "http://net/a", "<p>" + "word " * 50_000 + link("http://a.example.org/x")),
]


def test_rules_and_ranks(spark):
    df = spark.createDataFrame([(*r, "v", 1.0) for r in ROWS], "page_id long, url string, html string, verdict string, trust double")
    out = W.judge_urls(df)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    rows = out.collect()
    check(rows, ROWS)
    assert {(r.rule, r.verdict) for r in rows if r.host == "friend.example.com"} == {(None, "block")}


def test_nothing_decided_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", link("http://d.e/"))], "page_id long, url string, html string")
    assert [(r.rule, r.verdict) for r in W.judge_urls(df).collect()] == [(None, "allow")]
    assert W.judge_urls(df.limit(0)).count() == 0


def test_query_against_plain_python(spark):
    from tradescope.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    check(QUERIES["op3_url_filter"](spark, sf).collect(), rows)
