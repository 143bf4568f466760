"""URL rules against a brute force over all rules."""
import random

import pytest

from tidemark.llm import url_rules


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r[2])):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = (h + p, v)
            break
    return (host, path, *(best or (None, default)))


def test_cases(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    urls = [None, "", "no scheme", "http://", "http://A.EXAMPLE.net/en/x?y#z", "x://net",
            "x://net/", "x://b.net?/en/", "http://example.netx/en/", "ftp://xexample.com/de/",
            "http://example.com/de", "http://example.com/de/", "http://a.b.example.com/de/q#/",
            "http://org/fr/", "http://\u00c4.org/fr/x", "http://a.org/de/://net/", "://net/q",
            "http://" + "a." * 60 + "net/" + "p" * 5000, "http://example.net/en/"]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(3, "x://net/", "repeated")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(tuple, url_rules.apply_rules(spark, df, frame).collect()), key=repr)
    assert got == sorted([(i, *brute(u, rules)) for i, u, _ in rows], key=repr)


@pytest.mark.parametrize("seed, pieces", [(1, 1), (2, 8), (3, 40)])
def test_random_rules_and_hot_hosts(spark, seed, pieces):
    rng = random.Random(seed)
    labels, parts = ["a", "b", "ab", "c-d", "x"], ["", "/", "/a", "/a/", "/a/b", "/b/", "/ab"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    rules = [(host(), rng.choice(parts), rng.choice(["block", "allow"])) for _ in range(60)]
    urls = [f"http://{host()}{rng.choice(parts)}{rng.choice(['', '/b', '?q', 'b/c'])}"
            for _ in range(600)] + ["http://a.b.ab/a/b"] * 400
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r[0]: tuple(r)[1:] for r in
           url_rules.apply_rules(spark, df, frame, pieces=pieces, default="?").collect()}
    assert got == {i: brute(u, rules, "?") for i, u in enumerate(urls)}


def test_empty_tables(spark):
    urls = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_rules.apply_rules(spark, urls, rules).collect() == []
    one = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    assert [tuple(r) for r in url_rules.apply_rules(spark, one, rules).collect()] == [
        (1, "a", "/", None, "allow")]


def test_a_pivot_listed_often_gets_several_pieces():
    names, spans = url_rules._axis(["b", "b", "b", "d"])
    assert names == ["b", "d"]
    assert spans == [(0, 1), (1, 3), (4, 1), (5, 1), (6, 1)]
    assert [url_rules._slot(names, k) for k in "abcde"] == [0, 1, 2, 3, 4]
