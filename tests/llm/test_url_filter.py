import random

import pytest

from tidemark.llm import url_filter as uf

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.b.net", "", "block"), ("b.net", "/long/path/x", "allow"),
         ("b.net", "/long", "block"), ("same.io", "/x", "allow"), ("same.io", "/x", "block"), ("", "/", "block"), (None, "/", "block"), ("io", None, "allow"), ("x.y", "/aa", "allow"), ("y", "/aa/b", "block")]
URLS = [None, "", "no scheme", "http://", "://", "HTTP://EXAMPLE.org/es/A", "http://example.org/es", "http://www.Example.ORG/en/1234?x=/es/#y", "http://badexample.org/es/", "ftp://x://y.org/", "http://com/fr/", "http://a.com/de/x", "http://a.com/De/x",
        "http://example.org?/es/", "http://example.org", "http://example.org./", "http://example.org:80/es/", "http://c.a.b.net", "http://b.net/long/path/xyz", "http://b.net/long/path", "http://q.same.io/x/y", "http://same.io", "http://x.y/aa/b", "http://é.org/\n/x",
        "http://" + "s." * 3000 + "org/es", "http://example.org/" + "es/" * 400_000]


def expected(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h + (p or "")), len(h), a, h + (p or "")) for h, p, a in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    return (host, path, max(fit)[3], max(fit)[2]) if fit else (host, path, None, "allow")


@pytest.mark.parametrize("most", [500_000, 0])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(uf, "BROADCAST_RULES", most)
    rng = random.Random(3)
    made = ["http://" + ".".join(rng.choice(["a", "b", "c", "example", "www"]) for _ in range(rng.randrange(4))) + rng.choice([".org", ".net", ".com", ".io", ".y"]) + "/" + "/".join(rng.choice(["es", "en", "1", "12", "fr", "long", "path", "x", "aa", "", "b"]) for _ in range(rng.randrange(5)))
            for _ in range(300)]
    rows = [(i, u, "r", 1) for i, u in enumerate(URLS + made)] + [(None, URLS[5], "r", 1)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, _sizes string, parent int").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = sorted((tuple(r) for r in uf.judge(pages, rules, ["page_id"]).collect()), key=repr)
    assert got == sorted(((i, *expected(u)) for i, u, *_ in rows), key=repr)
    assert uf.judge(pages.limit(0), rules, ["page_id"]).collect() == []
    assert {r.rule for r in uf.judge(pages, rules.limit(0), ["page_id"], default="block").collect()} == {None}


def test_odd_actions_and_clashing_names_are_refused(spark):
    pages = spark.createDataFrame([(1, "http://a", "x")], "page_id long, url string, rule string")
    with pytest.raises(Exception, match="not an action"):
        uf.judge(pages, spark.createDataFrame([("a", "/", "perhaps")], "host string, path string, action string"), ["page_id"]).collect()
    with pytest.raises(ValueError):
        uf.judge(pages, spark.createDataFrame([], "host string, path string, action string"), ["page_id", "rule"])
