from __future__ import annotations

import itertools
import random

import pytest

from scanyard.llm import url_rules

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.example.org", "/", "block"),
         ("example.org", "", "allow"), ("org", "/es/long/path", "allow"), ("com", "/de/", "allow")]


def az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    return az(rest[:end]), path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]


def brute(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules):
    schema = "page_id long, url string, host string, path string, key string, verdict string"
    pages = spark.createDataFrame(
        [(i, u, "h", "p", "k", "v") for i, u in enumerate(urls)], schema).repartition(5)
    got = url_rules.judge(pages, url_rules.rule_table(spark, rules))
    return {r.id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}


@pytest.fixture
def many_ranges(spark):
    """Ranges of a few rows, so that rules open in one and fit in others."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_equals_brute_force(many_ranges):
    hosts = ["example.org", "a.example.org", "b.a.example.org", "notexample.org", "org", "xorg",
             "example.com", "EXAMPLE.Org", "com", "a-b.com", "net", "", "org.com", "example.org.",
             "a..org", "exämple.org"]
    paths = ["", "/", "/es/", "/es/long/path/x", "/en/12", "/en/2", "/fr/x?y=/de/", "/de/#a", "?q",
             "#f", "//x"]
    urls = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)]
    urls += [None, "", "no scheme", "://", "a://b://c/d", "http:///path", "x\n://example.org/es/\n"]
    got = judged(many_ranges, urls, RULES)
    # Of rules with one host and path the blocking verdict counts.
    rules = [r for r in RULES if r != ("com", "/de/", "allow")]
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_random_rules(many_ranges):
    rng = random.Random(4)
    labels = ["a", "b", "c-d", "e"]

    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 4)))

    def path():
        return "/" + "".join(rng.choices("xy/", k=rng.randint(0, 5)))

    rules = list({(host(), path()): None for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"https://{host()}{path()}" for _ in range(400)]
    assert judged(many_ranges, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_no_pages_null_rules(spark):
    assert judged(spark, ["http://a/b"], []) == {0: ("a", "/b", None, "allow")}
    assert judged(spark, ["http://a/b"], [("", "/", "block"), (None, "/", "block"),
                                          ("a", None, "block")])[0][3] == "allow"
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(empty, url_rules.rule_table(spark, RULES)).count() == 0


def test_repeated_rows_and_null_ids_each_get_a_row(spark):
    pages = spark.createDataFrame([(None, "http://a.org/"), (1, "http://a.org/"),
                                   (1, "http://a.org/")], "page_id long, url string")
    got = url_rules.judge(pages, url_rules.rule_table(spark, RULES)).collect()
    assert sorted((r.id or 0, r.rule) for r in got) == [(0, "org/"), (1, "org/"), (1, "org/")]


def test_the_plan_has_no_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_rules.judge(pages, url_rules.rule_table(spark, RULES))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
