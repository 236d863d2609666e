import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tidelake.llm import url_filter
from tidelake.operators.inspect import plan_summary

WORDS = {"pills", "x--", "", "ünter"}


def brute(url, rules, words):
    host = path = ""
    if url is not None and "://" in url:
        after = url.split("://", 1)[1]
        host = re.match("[^/?#]*", after)[0]
        path = re.match("[^?#]*", after[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for verdict, h, p in rules
        if None not in (verdict, h, p) and h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        top = max(fits)
        return host, path, top[2], top[3]
    return host, path, None, "block" if words & set(re.split(r"[.\-]", host)) - {""} else "allow"


def judged(spark, urls, rules, words, **more):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, keys int")
    known = spark.createDataFrame(rules, "verdict string, host string, path string")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages, known, listed, **more).collect()}


ODD = [
    None, "", "no scheme", "http://", "://", "https://ORG/", "https://a.org", "https://a.org?x=/", "http://org/p://q/fr/", "http://xorg/", "http://a.xorg/",
    "HTTP://Sub.Example.ORG/en/12#f", "http://example.org/EN/1", "http://example.org/en/", "http://b.example.org:80/es/", "http://u@pills.com/fr/x", "http://cheap-pills.com/de/",
    "http://cheap-pills.net/", "http://pills", "http://pillsx.net/", "http://..com/fr/", "http://com/fr/", "http://a\nb.com/fr/\n?", "http://x.ünter.net/é", "http://İ.com/de/日",
    "http://" + ".".join(["a"] * 30_000) + ".org/" + "p" * 50_000, "http://" + "pills." * 2000 + "net", "file:///org/", "http://-x---/", "  http://a.org/",
]


def test_odd_urls(spark):
    got = judged(spark, ODD * 2, url_filter.RULES, WORDS)
    assert got == {i: brute(u, url_filter.RULES, WORDS) for i, u in enumerate(ODD * 2)}
    assert {v[3] for v in got.values()} == {"allow", "block"}


def test_rules_of_any_length_and_both_sides(spark):
    rules = [("allow", "a.b", ""), ("block", "b", "/xy"), ("allow", "b", "/xyz"), ("block", "a.b", "/"), ("block", "q", "/"), ("block", "q", "/"), ("allow", None, "/"), (None, "b", "/"), ("allow", "", "/")]
    urls = [f"s://{h}{p}" for h in ("b", "a.b", "z.a.b", "q", "b.q", "a.c", "") for p in ("", "/", "/x", "/xy", "/xyz/1", "x")]
    want = {i: brute(u, rules, set()) for i, u in enumerate(urls)}
    assert judged(spark, urls, rules, []) == want
    # A rule on both sides blocks; no rules and no words allow everything.
    assert judged(spark, ["s://q/1"], [("block", "q", "/"), ("allow", "q", "/")], []) == {0: ("q", "/1", "q/", "block")}
    assert judged(spark, ["s://q/1", None], [], []) == {0: ("q", "/1", None, "allow"), 1: ("", "", None, "allow")}


def test_no_pages(spark):
    assert judged(spark, [], url_filter.RULES, WORDS) == {}


def test_lists_beyond_the_bound_go_in_rounds(spark):
    draw = random.Random(4)
    listed = {f"w{draw.randrange(4000)}" for _ in range(1200)}
    urls = [f"http://w{draw.randrange(4000)}.w{draw.randrange(4000)}-w{draw.randrange(4000)}.{draw.choice(['org', 'com', 'net'])}/{draw.choice(['fr', 'de', 'en'])}/{i}" for i in range(1500)]
    want = {i: brute(u, url_filter.RULES, listed) for i, u in enumerate(urls)}
    assert judged(spark, urls, url_filter.RULES, listed) == want
    assert judged(spark, urls, url_filter.RULES, listed, most=1000) == want


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3, 0.97, 1.0])
def test_cascades_are_exact(spark, share):
    """Every key of the universe is told right, with fewer bits than a table of hashes would take."""
    keys = spark.range(20_000).select(url_filter.hashes(F.concat(F.lit("k"), "id")).alias("h"), (F.rand(7) < share).alias("listed")).select("h.*", "listed").cache()
    filters = url_filter.build_cascade(keys)
    rows = keys.toPandas()
    got = url_filter.member(filters, rows.h0.to_numpy().view(np.uint64), rows.h1.to_numpy().view(np.uint64))
    assert (got == rows.listed.to_numpy()).all()
    n = int(rows.listed.sum())
    assert (len(filters) > 1) == (0 < share < 1) and sum(f.bits for f in filters) // 8 <= max(64, 2 * url_filter.cascade_bytes(n, 20_000 - n))
    keys.unpersist()


def test_no_join_over_the_pages(spark):
    judged_pages = url_filter.query(spark, "/root/testdata/sf0.001")
    plan = plan_summary(judged_pages)
    assert plan["joins"] == [] and plan["shuffles"] == 0 and plan["read_schema"] == ["struct<page_id:bigint,url:string>"]
    assert {r[0] for r in rows_of(judged_pages.select("verdict").distinct())} == {"allow", "block"}
