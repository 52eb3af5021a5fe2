"""URL filters against brute force over rule lists."""

import re

import pytest
from pyspark.sql import functions as F

from skyfold.llm import url_filters as U


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = m.groups() if m else ("", "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.fixture
def pages(spark):
    return lambda urls: spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, html string")


URLS = ["http://Example.COM/en/a?b#c", "https://www.example.com/en/", "x://a.b.www.example.com/en/x", "http://com/", "http://com",
        "http://com?x=/en/", "net/es/x", None, "", "://", "http://blog.net/es/1#t", "http://xnet/es/", "http://notexample.com/en/",
        "http://example.com/EN/", "http://example.com:80/en/", "http://u@example.com/en/", "a://b://net/fr/", "http://.com/", "http://com./",
        "http://É.net/fr/ü", "http://net/fr/\nx?", "http://" + "a." * 3000 + "net/es/" + "b" * 10_000]


def check(spark, pages, urls, rules):
    rows = {r.page_id: r for r in U.judge(pages(urls), U.rule_table(spark, rules)).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        r = rows[i]
        assert (r.host, r.path, r.rule, r.verdict) == brute(u, rules), u


def test_contract_rules(spark, pages):
    check(spark, pages, URLS + URLS[:5], U.RULES)


def test_random_nested_rules(spark, pages, rng):
    labels, parts = ["a", "b", "c-d", "ab", "z"], ["", "x", "x/", "y/z", "/"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    rules = list({(h, p): (h, p, v) for h, p, v in (
        (host(), "/" + rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(80))}.values())
    urls = [f"http://{host()}/{rng.choice(parts)}{rng.choice(parts)}" for _ in range(300)]
    check(spark, pages, urls, rules + [(None, "/", "block"), ("a", None, "block")])


def test_one_hot_host_is_spread_over_shards(spark, pages):
    urls = [f"http://hot.example.com/en/{i}" for i in range(2000)] + ["http://net/es/"]
    check(spark, pages, urls, U.RULES)


def test_empty_tables_and_keep(spark, pages):
    none = U.rule_table(spark, [])
    assert U.judge(pages([]), none).count() == 0
    assert U.judge(pages([]), U.rule_table(spark, U.RULES)).count() == 0
    rows = U.judge(pages(["http://net/es/"]), none, default="block").collect()
    assert [(r.rule, r.verdict) for r in rows] == [(None, "block")]
    clash = pages(URLS).withColumn("host", F.lit(1)).withColumn("key", F.lit(2)).withColumn("rule", F.lit("x"))
    kept = U.keep_allowed(clash, U.rule_table(spark, U.RULES))
    assert kept.columns == clash.columns
    assert {r.page_id for r in kept.collect()} == {i for i, u in enumerate(URLS) if brute(u, U.RULES)[3] == "allow"}


def test_native(spark, pages):
    plan = U.judge(pages(URLS), U.rule_table(spark, U.RULES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
