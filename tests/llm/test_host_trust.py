import re
from collections import Counter, defaultdict

import pytest

from tillmart.llm.host_trust import RULES, judge_urls


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(pages, rounds=10, d=0.85):
    rows = [(i, *split(u), h or "") for i, u, h in pages]
    edges, seeds = Counter(), {"trust": Counter(), "distrust": Counter()}
    for _, host, path, html in rows:
        if not host:
            continue
        for to in set(re.findall(r"(?i)href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)", html)):
            if to.lower() != host:
                edges[host, to.lower()] += 1
        verdict = rule_of(host, path)[1]
        if verdict:
            seeds["trust" if verdict == "allow" else "distrust"][host] += 1
    tree = set()
    for host in {r[1] for r in rows if r[1]}:
        labels = host.split(".")
        while len(labels) >= 3:
            tree.add((".".join(labels), ".".join(labels[1:])))
            labels = labels[1:]
    for a, b in tree:
        edges[a, b] += 1
        edges[b, a] += 1
    ranks = {}
    for kind, turned in (("trust", False), ("distrust", True)):
        out = defaultdict(dict)
        for (a, b), n in edges.items():
            out[b if turned else a][a if turned else b] = n
        total = sum(seeds[kind].values())
        seed = {h: n / total for h, n in seeds[kind].items()}
        rank = dict(seed)
        for _ in range(rounds):
            new, ended = defaultdict(float), 0.0
            for h, r in rank.items():
                if h not in out:
                    ended += r
                for to, n in out.get(h, {}).items():
                    new[to] += d * r * n / sum(out[h].values())
            for h, s in seed.items():
                new[h] += (1 - d + d * ended) * s
            rank = new
        ranks[kind] = rank
    result = []
    for i, host, path, _ in rows:
        rule, verdict = rule_of(host, path)
        t, b = ranks["trust"].get(host, 0), ranks["distrust"].get(host, 0)
        result.append((i, host, path, rule, verdict or ("block" if b > 1.5 * t + 1e-12 else "allow"), round(t, 9), round(b, 9)))
    return sorted(result, key=repr)


PAGES = [
    (1, None, None), (2, "", ""), (3, "no scheme/x", "<a href='//x.net/'>"), (4, "http://A.Example.ORG/es/1?q#f", None),
    (5, "https://b.example.org/en/12", "<a href=http://s.net/a>x</a> <a HREF = \"https://S.net\">"), (6, "http://b.example.org/en/2", ""),
    (7, "ftp://x.com?y/fr/", ""), (8, "http://x.com/fr/", "<a href='//q.x.net/p'>"), (9, "http://y.com/de/a", "<a href='http://x.com/'>"),
    (10, "http://s.net/", "<a href='http://y.com/de/'> <a href='http://b.example.org/'>"), (11, "http://q.x.net/z", ""), (12, "http://xorg/es/", ""),
    (13, "http://org", ""), (13, "http://org/", ""), (None, "http://far.net#a/b", ""), (10, "http://s.net/", "<a href='http://y.com/de/'>"),
    (14, "http://a.b.c.example.com/it/", "x" * 50000 + "<a href='http://y.com'>"), (15, "a://b://c/d", ""), (16, "http://É.example.ORG/en/\n1", ""),
]


@pytest.mark.parametrize("pages", [PAGES, PAGES[:3]])
def test_against_brute_force(spark, pages):
    rows = [(*p, "mine", 0.5) for p in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rank double").repartition(2)
    got = sorted([(*tuple(r)[:5], round(r["trust"], 9), round(r["distrust"], 9)) for r in judge_urls(df).collect()], key=repr)
    assert got == brute(pages)


def test_empty(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
