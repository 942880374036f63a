"""Rules and reputations against plain Python."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tagloom.llm import host_reputation as hr

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    "http://a.Example.NET/en/x", "http://a.example.net/de/", "http://example.net", "http://badexample.net/en/", "http://x.example.com/de/1?x#y",
    "http://example.com/en/", "http://x.org/fr/", "HTTPS://x.org/de/", None, "", "no host/de/", "x://", "a://b?c=/d", "http://n.net?/x", "http://www.shop.co.uk/a",
    "http://q#frag/en/", "http://one.net/en/://two.org/fr/", "http://e.co.uk\n/x", "http://u@h.shop.co.uk:80/",
]


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")


def rule(host, path, rules=RULES):
    fit = [(len(h + p), len(h), v == "allow", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, None)


def judged(spark, urls, labels, **options):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    marks = spark.createDataFrame(labels, "page_id bigint, bad int")
    out = hr.judge(pages, marks, hr.rules_table(spark, RULES), **options)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(spark, URLS, [])
    for i, url in enumerate(URLS):
        host, path = parse(url)
        name, verdict = rule(host, path)
        assert got[i] == (host, path, name, verdict or "allow"), url


def test_domains(spark):
    names = {"a.b.example.com": "example.com", "x.shop.co.uk": "shop.co.uk", "co.uk": "co.uk", "com": "com", "": "", "u@a.b.c:80": "b.c"}
    df = spark.createDataFrame([(k,) for k in names], "h string")
    rows = df.select("h", hr.domain_of(F.col("h")).alias("d"), hr.suffix_of(hr.domain_of(F.col("h"))).alias("s")).collect()
    assert {r["h"]: r["d"] for r in rows} == names
    assert {r["h"]: r["s"] for r in rows}["x.shop.co.uk"] == "co.uk"


def plain_bounds(hosts, z=hr.Z):
    """Bounds by the same priors, level by level."""
    domain = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    suffix = {d: d.split(".", 1)[-1] for d in domain.values()}
    sums = lambda of: {g: (sum(hosts[h][0] for h in hosts if of(h) == g), sum(hosts[h][1] for h in hosts if of(h) == g)) for g in {of(h) for h in hosts}}
    n, k = sum(v[0] for v in hosts.values()), sum(v[1] for v in hosts.values())

    def level(groups, parent):
        over = sum((b - m * parent[g]) ** 2 - m * parent[g] * (1 - parent[g]) for g, (m, b) in groups.items())
        pairs = sum(m * (m - 1) * parent[g] * (1 - parent[g]) for g, (m, b) in groups.items())
        most = min(1000.0, max(1.0, n))
        s = most if not pairs or over <= 0 else min(most, max(1.0, pairs / over - 1))
        return s, {g: (s * parent[g] + b) / (s + m) for g, (m, b) in groups.items()}

    top = (k + 0.5) / (n + 1)
    suffixes = sums(lambda h: suffix[domain[h]])
    _, by_suffix = level(suffixes, dict.fromkeys(suffixes, top))
    domains = sums(lambda h: domain[h])
    _, by_domain = level(domains, {d: by_suffix[suffix[d]] for d in domains})
    s, _ = level(hosts, {h: by_domain[domain[h]] for h in hosts})
    out = {}
    for h, (m, b) in hosts.items():
        alpha, beta = s * by_domain[domain[h]] + b, s * (1 - by_domain[domain[h]]) + m - b
        out[h] = 1 / (1 + math.exp(-(math.log(alpha / beta) - z * math.sqrt(1 / alpha + 1 / beta))))
    return out


HOSTS = {"a.x.com": (40, 38), "b.x.com": (3, 0), "y.com": (100, 2), "z.org": (0, 0), "q.x.com": (0, 0), "w.org": (1, 1), "bad.net": (30, 30)}


def test_bounds(spark):
    df = spark.createDataFrame([(h, n, b) for h, (n, b) in HOSTS.items()], "host string, n bigint, bad bigint")
    got = {r["host"]: r["bound"] for r in hr.reputations(df).collect()}
    want = plain_bounds(HOSTS)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[h], want[h], rel_tol=1e-9) for h in want)
    assert got["a.x.com"] > got["q.x.com"] > got["y.com"]


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_hosts_decide_without_rules_on_both_joins(spark, monkeypatch, limit):
    monkeypatch.setattr(hr, "MAX_BROADCAST_BYTES", limit)
    urls = ["http://bad.com/p"] * 30 + ["http://good.com/p"] * 30 + ["http://new.com/"] + ["http://a.example.net/en/"] * 20
    labels = [(i, int(i < 30 or i > 60)) for i in range(len(urls))] + [(0, None), (1, 0), (5000, 1), (None, 1)]
    got = judged(spark, urls, labels)
    assert {v[3] for i, v in got.items() if i < 30} == {"block"}
    assert {v[3] for i, v in got.items() if 30 <= i < 61} == {"allow"}
    assert {v[2:] for i, v in got.items() if i > 60} == {("example.net/en/", "allow")}


def test_empty_tables_clashes_and_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "x"), (1, "http://a.net/", "y"), (None, None, None)], "page_id bigint, url string, HOST string")
    marks = spark.createDataFrame([], "page_id bigint, bad int")
    rules = hr.rules_table(spark, RULES)
    out = hr.judge(pages, marks, rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"] and out.count() == 3
    assert hr.judge(pages.limit(0), marks, rules).count() == 0
    assert {r["rule"] for r in hr.judge(pages, marks, rules.limit(0)).collect()} == {None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
