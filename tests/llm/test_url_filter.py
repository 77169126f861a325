from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hrflow.llm.url_filter import bloom_cascade, url_verdicts

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "Example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("block", "com", "")]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r", "k") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string, hit string")


def slow(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path.split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h.lower() + p, v) for v, h, p in RULES if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_equals_brute_force(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.ORG", "http://a.ORG/", "x://org/?://com/", "http://example.org/es/1", "http://m.Example.org/es?x#y"]
    urls += [f"http://{h}{p}" for h in ("example.org", "b.example.org", "bexample.org", "com", "a.com", "acom", "net") for p in ("", "/", "/en/1", "/en/12", "/en/2", "/es/", "/fr/x", "/de/?q", "#/de/")]
    urls += ["http://a.com/" + "y" * 100_000, urls[-1], "ftp://x://a.org/"]
    got = sorted(url_verdicts(pages(spark, urls), RULES).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [slow(u) for u in urls]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key")).cache()
    listed = universe.filter("key rlike '7$'")
    cascade = bloom_cascade(listed, universe)
    assert len(cascade.levels) > 2
    wrong = universe.filter(cascade.contains(F.col("key")) != F.col("key").rlike("7$"))
    assert wrong.count() == 0
    assert sum(len(x.bits) for x in cascade.levels) * 64 < 20 * 2000  # far less than the keys
    with pytest.raises(ValueError, match="max_bits"):
        bloom_cascade(listed, universe, max_bits=1000)


def test_empty_and_no_rules(spark):
    assert url_verdicts(pages(spark, []), RULES).count() == 0
    assert [(r.rule, r.verdict) for r in url_verdicts(pages(spark, ["http://a.com/"]), []).collect()] == [(None, "allow")]


def test_no_python_and_no_join_in_the_plan(spark):
    plan = url_verdicts(pages(spark, ["http://a.com/"]), RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Join"))
