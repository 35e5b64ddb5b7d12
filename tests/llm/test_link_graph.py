import pytest

from tillwise.llm import link_graph as G

SCHEMA = "page_id long, url string, html string"


def link(*urls):
    return " ".join(f'<a class="x" href="{u}">t</a>' for u in urls)


def brute(pages):
    """Rules by hand, propagation with dictionaries."""
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

    def parts(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]

    def rule(host, path):
        fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        return max(fit, key=lambda r: len(r[0] + r[1])) if fit else None

    judged = [(*p, *parts(p[1]), rule(*parts(p[1]))) for p in pages]
    edges, said = {}, {}
    for _, _, html, host, _, r in judged:
        said.setdefault(host, []).append(r[2] if r else None)
        for url in (html or "").split('href="')[1:]:
            target = parts("x:" + url.split('"')[0].removeprefix("http:").removeprefix("https:"))[0]
            if target and host and target != host:
                edges[host, target] = edges.get((host, target), 0) + 1
    hosts = ({h for h in said if h}) | {h for e in edges for h in e}

    def spread(seed, pairs):
        total = {}
        for (a, _), w in pairs.items():
            total[a] = total.get(a, 0) + w
        score = {h: 0.15 * seed[h] for h in hosts}
        for _ in range(200):
            flow = dict.fromkeys(hosts, 0.0)
            for (a, b), w in pairs.items():
                flow[b] += score[a] * w / total[a]
            score = {h: 0.15 * seed[h] + 0.85 * flow[h] for h in hosts}
        return score

    share = lambda h, v: said.get(h, []).count(v) / max(sum(x is not None for x in said.get(h, [])), 1)
    trust = spread({h: share(h, "allow") for h in hosts}, edges)
    distrust = spread({h: share(h, "block") for h in hosts}, {(b, a): w for (a, b), w in edges.items()})
    out = []
    for page_id, _, _, host, path, r in judged:
        bad = distrust.get(host, 0) > 2 * trust.get(host, 0) and distrust.get(host, 0) >= 0.01
        out.append((page_id, host, path, r[0] + r[1] if r else None, r[2] if r else ("block" if bad else "allow")))
    return out, trust, distrust


PAGES = [
    (1, "http://A.example.org/en/2", link("http://good.net/x", "/local", "//Good.net")),
    (2, "https://bad.com/de/1?q", None),
    (3, "http://spam.net/x", link("http://bad.com/", "https://bad.com/y", "http://far.net")),
    (4, "http://good.net/page#f", link("http://far.net/")),
    (5, "http://far.net", link("http://spam.net/")),
    (6, None, link("http://bad.com/")),
    (7, "no scheme", ""),
    (8, "http://x.example.org/es/1", link("http://x.example.org/self")),
    (9, "http://example.org/en/12", None),
    (10, "http://shop.com/fr/", link("http://bad.com/")),
    (11, "http://notorg/", None),
    (12, "http://org?x://y/", None),
    (13, "http://deepspam.net/", link("http://spam.net/")),
    (13, "http://deepspam.net/", link("http://spam.net/")),
    (None, "http://İA.com/en/", None),
]


def test_equals_brute_force(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'clash' AS host", "'clash' AS rule", "0 AS trust")
    want, trust, distrust = brute(PAGES)
    found = G.judge_urls(pages).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(want, key=key)
    for r in found:
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=2e-3)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=2e-3)
    verdicts = {r.page_id: r.verdict for r in found}
    assert verdicts[3] == "allow" and verdicts[4] == "allow" and verdicts[13] == "block"


def test_empty_table(spark):
    assert G.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = G.judge_urls(spark.createDataFrame(PAGES, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
