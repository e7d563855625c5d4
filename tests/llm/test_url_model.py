import math
import re
from collections import Counter, defaultdict

import xxhash

from matchlake.llm import queries
from matchlake.llm import url_model as U


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = [r for r in U.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def classes(url):
    def one(c):
        c = c.lower() if c.isascii() else c
        if "a" <= c <= "z":
            return ord(c) - 97
        return 26 if c in "0123456789" else 27 if c == "." else 28 if c == "/" else 29 if c in "-_" else 30 if c in "?=&#%:;,+" else 31
    return [31] * U.ORDER + [one(c) for c in url]


def brute(rows):
    counts = {s: [defaultdict(Counter) for _ in range(U.ORDER + 1)] for s in ("allow", "block")}
    held = lambda u: ((xxhash.xxh64_intdigest(u.encode(), 42) + 2**63) % 2**64 - 2**63) % U.HELD == 0
    for _, u in rows:
        r = rule(*parts(u))
        if r and not held(u or ""):
            c = classes(u or "")
            for i in range(U.ORDER, len(c)):
                for k in range(U.ORDER + 1):
                    counts[r[2]][k][tuple(c[i - k:i])][c[i]] += 1

    def log_p(side, c, i):
        p = 1 / U.CLASSES
        for k in range(U.ORDER + 1):
            seen = counts[side][k].get(tuple(c[i - k:i]), Counter())
            n, kinds = sum(seen.values()), len(seen)
            p = (seen[c[i]] + kinds * p) / (n + kinds) if n else p
        return math.log(p)

    def score(u):
        c = classes(u or "")
        at = range(U.ORDER, len(c))
        total = sum(log_p("allow", c, i) - log_p("block", c, i) for i in at)
        return total / max(1, len(at))

    return score, held


def test_pages(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()]
    got = {r.page_id: r for r in queries.QUERIES["op8_url_model"](spark, sf).collect()}
    score, held = brute(rows)
    scored = {i: score(u) for i, u in rows}
    labelled = [(math.floor(got[i].score / U.STEP), rule(*parts(u))[2]) for i, u in rows if rule(*parts(u)) and held(u)]
    sides = Counter(s for _, s in labelled)
    cut = min({b for b, _ in labelled}, key=lambda b: (
        sum(s == "allow" and x < b for x, s in labelled) / sides["allow"] + 1 - sum(s == "block" and x < b for x, s in labelled) / sides["block"], abs(b), b
    )) * U.STEP
    for i, u in rows:
        host, path = parts(u)
        r = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, r and r[0] + r[1])
        assert abs(got[i].score - scored[i]) < 1e-4
        assert got[i].verdict == (r[2] if r else "allow" if got[i].score >= cut else "block")


def test_odd_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/fr/"), (4, "HTTP://Sub.Example.ORG/en/1?x=/es/"), (5, "http://example.org/es/a"), (6, "http://x.com"),
            (7, "http://notexample.org/es/"), (8, "http://a.com/fr/#t"), (8, "http://a.com/fr/#t"), (None, "ftp://b.com/de/é😀"), (10, "http://a.org/" + "y" * 50_000), (11, "://org/")]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "page_id long, url string, rule string, host string, score string")
    got = U.report(df).collect()
    assert len(got) == len(rows)
    rules = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert rules[1][:3] == rules[2][:3] == rules[3][:3] == ("", "", None)
    assert rules[4] == ("sub.example.org", "/en/1", "example.org/en/1", "block")
    assert rules[5][2:] == ("example.org/es/", "block") and rules[6][:3] == ("x.com", "", None)
    assert rules[7][2:] == ("org/", "allow") and rules[8][2:] == ("com/fr/", "allow") and rules[11][2:] == ("org/", "allow")
    assert rules[None][2:] == ("com/de/", "block")


def test_nothing_labelled(spark):
    got = U.report(spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")).collect()
    assert {(r.verdict, r.score) for r in got} == {("allow", 0.0)}
    assert U.report(spark.createDataFrame([], "page_id long, url string")).collect() == []
