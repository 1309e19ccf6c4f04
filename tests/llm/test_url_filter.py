import math
import re
from collections import defaultdict

import pytest

from stormlens.llm import queries
from stormlens.llm import url_filter as uf

PAGES = "page_id long, url string, host string, verdict string, id long"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], PAGES)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def by_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def models(lines, order):
    """P(c | before) of one sample by the recursion."""
    counts = defaultdict(lambda: defaultdict(int))
    for line in lines:
        s = "^" * order + line
        for k in range(order, len(s)):
            for n in range(order + 1):
                counts[s[k - n:k]][s[k]] += 1

    def p(before, c):
        less = p(before[1:], c) if before else 1 / uf.SYMBOLS
        found = counts.get(before)
        return (found.get(c, 0) + len(found) * less) / (sum(found.values()) + len(found)) if found else less

    return counts, p


URLS = ["http://a.com/x/1", "https://WWW.Example.COM/en/2?q=1#t", "http://b.example.com/en/77", "http://m.example.com/fr/3", "ftp://x.net/es/5", "http://y.net/fr/9/",
        "http://net/es/", "http://q.org/en/1", "http://zz.org/es/55?x", None, "", "no scheme", "http://", "http://com", "http://com/", "http://notcom/", "http://excom/a",
        "http://É.com/é?ü", "http://a.net/de/://x", "x://h#f/p", "http://a.net/en\n/1", "http://y.net/fr/9/"]


def test_verdicts_and_scores_equal_the_definitions(spark, pages):
    rows = list(enumerate(URLS)) + [(None, "http://null.org/1")]
    out = uf.url_filter(pages(rows)).collect()
    assert len(out) == len(rows)
    line = lambda u: re.sub(r"\d", "0", "".join(split(u)) + "$")
    sides = defaultdict(list)
    for _, u in rows:
        v = by_rule(*split(u))[1]
        if v:
            sides[v].append(line(u))
    (ca, pa), (cr, pr) = (models(sides[v], uf.ORDER) for v in ("allow", "block"))

    def score(u):
        s, total = "^" * uf.ORDER + line(u), 0
        for k in range(uf.ORDER, len(s)):
            for n in range(uf.ORDER, -1, -1):
                before = s[k - n:k]
                if ca.get(before, {}).get(s[k]) or cr.get(before, {}).get(s[k]):
                    total += round(math.log(pa(before, s[k]) / pr(before, s[k])) * 1e6)
                    break
        return total / len(line(u)) / 1e6

    found = {v: [score(u) for _, u in rows if by_rule(*split(u))[1] == v] for v in ("allow", "block")}
    mean = {v: sum(x) / len(x) for v, x in found.items()}
    spread = {v: (sum((y - mean[v]) ** 2 for y in x) / len(x)) ** 0.5 for v, x in found.items()}
    threshold = (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / sum(spread.values())
    urls = dict(rows)
    for r in out:
        u = urls[r.page_id]
        assert (r.host, r.path) == split(u)
        name, verdict = by_rule(r.host, r.path)
        assert r.rule == name and r.score == pytest.approx(score(u), abs=2e-6)
        assert r.verdict == (verdict or ("allow" if score(u) >= threshold else "block"))


def test_one_side_or_none(spark, pages):
    assert {r.verdict for r in uf.url_filter(pages([(1, "http://a.org/"), (2, None)])).collect()} == {"allow"}
    assert {r.verdict for r in uf.url_filter(pages([(1, "http://a.org/"), (2, "http://b.net/es/1")])).collect()} == {"allow", "block"}
    assert uf.url_filter(pages([])).count() == 0


def test_every_run_is_kept(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [letters[k % 26] + letters[k // 26 % 26] + letters[k // 676 % 26] + letters[k * 7 % 26] + letters[k * 11 // 26 % 26] for k in range(17_000)]
    samples = spark.createDataFrame([(n, k % 2 == 0) for k, n in enumerate(names)], "__line string, accepted boolean")
    runs = {("^" * uf.ORDER + n)[k:k + uf.ORDER + 1] for n in names for k in range(len(n))}
    assert len(runs) > 20_000 and uf.train(samples)[-1].count() == len(runs)


def test_query_on_all_pages(spark, sf):
    got = queries.QUERIES["op10_url_filter"](spark, sf)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in got.collect():
        host, path = split(urls[r.page_id])
        name, verdict = by_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name) and r.verdict in ([verdict] if verdict else ["allow", "block"])
