import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelens.llm import urls

PAGES = "page_id bigint, url string"
RULES = "host string, path string, verdict string"


def ascii_lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    rest = rest[:end]
    host, slash, path = rest.partition("/")
    return ascii_lower(host), slash + path


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if None not in (h, p, v)
            for h in [ascii_lower(h)]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, default)


def check(spark, pages, rules):
    got = urls.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, RULES))
    want = [(i, u, *brute(u, rules)) for i, u in pages]
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


CASES = [
    None, "", "no scheme", "http://", "://", "http://a.com", "http://a.com/", "HTTP://WWW.A.COM/EN/x?y=/z#t",
    "http://a.com?x=/en/", "http://a.com#/en/", "http://xa.com/en/", "http://user@a.com:80/en/", "http://a.com./en/",
    "http://.com/en/", "http://..com/", "http://com/en/x://b.net/fr/", "x\n://a.com/\nen", "http://É.com/en/É",
    "http://a.com/" + "x/" * 5000, "http://" + "s." * 300 + "a.com/en/1",
]


def test_edge_cases_match_brute_force(spark):
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("www.a.com", "/en/", "allow"), ("a.com", "", "block"),
             ("A.com", "/en/", "allow"), ("", "", "block"), (None, "/", "block"), ("a.com", None, "block"),
             ("com", "/en/", None), ("é.com", "/", "block"), ("É.com", "/en/", "block"), ("s.a.com", "/e", "block")]
    check(spark, [(i, u) for i, u in enumerate(CASES)] + [(None, CASES[5]), (3, CASES[5]), (3, CASES[6])], rules)


@pytest.mark.parametrize("block", [1, 3, 512])
def test_many_nested_rules_in_small_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(urls, "BLOCK", block)
    rng = random.Random(block)

    def host():
        return ".".join(rng.choice(["a", "b", "www", "x-y"]) for _ in range(rng.randint(1, 4)))

    def path():
        return "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 6)))

    rules = [(host(), path()[:rng.randint(0, 7)], rng.choice(["allow", "block"])) for _ in range(300)]
    pages = [(i, f"http://{host()}{path()}") for i in range(400)]
    check(spark, pages + pages[:1] * 300, rules)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a.b", max_size=6), st.text(alphabet="a.b", max_size=6))
def test_host_keys_turn_subdomains_into_prefixes(host, rule):
    def key(h):
        return ".".join(reversed(h.split("."))) + "."
    assert (host == rule or host.endswith("." + rule)) == key(host).startswith(key(rule))


def test_empty_tables_and_clashing_columns(spark):
    rules = spark.createDataFrame([("com", "/", "block")], RULES)
    empty = spark.createDataFrame([], PAGES)
    assert urls.judge(empty, rules).collect() == []
    pages = spark.createDataFrame([(1, "http://a.com/", 5, 6, "x", "key", 7)],
                                  PAGES + ", host int, `rule` int, verdict string, `key` string, at int")
    row = urls.judge(pages, rules).first()
    assert (row.host, row.path, row["rule"], row.verdict, row.key, row.at) == ("a.com", "/", "com/", "block", "key", 7)
    none = urls.judge(pages, rules.limit(0)).first()
    assert (none["rule"], none.verdict) == (None, "allow")


def test_no_python_on_the_main_path(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], PAGES)
    rules = spark.createDataFrame([("com", "/", "block")], RULES)
    plan = urls.judge(pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
