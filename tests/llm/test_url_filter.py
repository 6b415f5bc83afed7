"""URL rules against a plain look at every rule."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kindred.llm import url_filter

PAGES = "page_id long, url string, html string, rule int, host string, place int, keys string"
ODD = [
    None, "", "no scheme", "http://", "://", "http:///en/", "http://net", "http://NET/", "http://.net/x",
    "http://a.net./en/", "HTTP://Shop.Example.NET/en/1?q=http://b.org/fr/", "http://x.org?u=http://y.net/",
    "http://notexample.net/en/", "http://example.net/En/", "http://example.net/en", "http://a.com/de/",
    "http://a.example.com/de/x#y", "http://org/fr/", "http://a.org/fr", "x://q.net/a\nb", "http://ex.net\\a/",
    "http://É.net/", "http://a.org:80/fr/", "http://" + "a." * 3000 + "net/" + "p" * 50_000,
]


def plain(url, rules, default="allow"):
    text = url or ""
    rest = text.split("://", 1)[1] if "://" in text else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    return host, path, max(fits)[3], max(fits)[4]


def table(spark, urls):
    rows = [(i if i % 9 else None, u, "<p>", 1, "h", 2, "k") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, PAGES)


def judged(pages, **options):
    found = url_filter.judged(pages, **options)
    assert found.columns == ["page_id", "url", "html", "place", "keys", "host", "path", "rule", "verdict"]
    return found.collect()


def test_contract_rules_on_odd_urls(spark):
    rows = judged(table(spark, ODD * 3))
    assert len(rows) == 3 * len(ODD)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, url_filter.RULES), r.url


@pytest.mark.parametrize("shard_keys", [url_filter.SHARD_KEYS, 150])
def test_long_lists_equal_a_plain_look(spark, shard_keys):
    draw = random.Random(5)
    label = ["a", "b", "c", "d"]
    rules = [
        (
            ".".join(draw.choices(label, k=draw.randint(1, 3))),
            draw.choice(["", "/", "/x", "/x/y", "/é"]),
            draw.choice(["allow", "block"]),
        )
        for _ in range(500)
    ]
    rules += [rules[0][:2] + ("allow",), rules[0][:2] + ("block",)]
    urls = [
        "http://" + ".".join(draw.choices(label, k=draw.randint(1, 6)))
        + draw.choice(["", "/", "/x", "/x/y/z", "/xx", "/é/1", "?x/"])
        for _ in range(1500)
    ]
    listed = spark.createDataFrame(rules + [(None, "/", "block"), ("a", "/q", None)], "host string, path string, verdict string")
    # Of one key under two verdicts, block counts.
    for r in judged(table(spark, urls), rules=listed, shard_keys=shard_keys, default="block"):
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, rules, "block"), r.url


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 9000).alias("key"))
    listed = keys.where("substr(key, 2) % 7 = 0")
    cascade = url_filter.build_cascade(listed, keys)
    assert len(cascade.levels) > 2
    found = keys.select("key", (cascade.first_listed(F.array("key")) > 0).alias("in")).distinct()
    assert {r.key for r in found.collect() if r["in"]} == {f"k{i}" for i in range(0, 9000, 7)}
    # 1,286 keys of 9,000 in fewer bits than the keys' 64-bit hashes would take.
    assert cascade.n_bytes < 1286 * 4


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(r.rule, r.verdict) for r in judged(table(spark, ODD), rules=none)} == {(None, "allow")}
    assert judged(table(spark, ODD).limit(0)) == []
