import re

import pytest

from tickwatch.llm import queries, url_filters

RULES = [*queries.URL_RULES, ("a.example.org", "/", "block"), ("org", "/es", "allow"), ("example.org", "/en/10", "allow")]


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, otherwise="allow"):
    host, path = parts(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else otherwise


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "http://organic/", "http://example.org", "http://example.org?x=/es/",
    "HTTP://Blog.Example.ORG/es/1?q#f", "http://example.org/en/1", "http://example.org/en/100", "http://x.a.example.org/es/5",
    "http://a.example.org", "http://b.com/fr/", "http://b.com/de/x#/fr/", "http://com/de/", "http://xcom/de/", "http://example.org./es/",
    "http://..org/es", "://org/es/", "http://é.org/é/ü", "http://example.org:80/es/", "a://b://c.org/",
]


def check(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id BIGINT, url STRING").repartition(4)
    frame = spark.createDataFrame(rules, "host STRING, path STRING, verdict STRING")
    rows = url_filters.judge_urls(df, frame).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.host, row.path, row.rule, row.verdict) == brute(urls[row.page_id], rules), urls[row.page_id]


def test_verdicts_equal_brute_force(spark):
    check(spark, URLS * 3, RULES)


def test_many_nested_rules_over_many_blocks(spark):
    rules = [("org", "/" + "a/" * n, "allow" if n % 2 else "block") for n in range(20)]
    rules += [(f"h{n}.org", "/a/", "block") for n in range(30)]
    urls = [f"http://x.h{n % 40}.org/" + "a/" * (n % 25) + str(n) for n in range(300)]
    check(spark, urls, rules)


def test_a_rule_of_an_earlier_block_is_carried(spark):
    # Range bounds cut between the rule and its probes when there are far more probes than rules.
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, [f"http://s.org/p{n:04d}" for n in range(500)], [("s.org", "/", "block")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_rules_odd_rules_and_clashing_columns(spark):
    df = spark.createDataFrame([("http://a.org/x", "h", 1)], "url STRING, HOST STRING, rule INT")
    none = spark.createDataFrame([], "host STRING, path STRING, verdict STRING")
    made = url_filters.judge_urls(df, none, otherwise="block")
    assert made.columns == ["url", "host", "path", "rule", "verdict"]
    assert tuple(made.first())[1:] == ("a.org", "/x", None, "block")
    odd = spark.createDataFrame(
        [(None, "/", "block"), ("ORG", None, "block"), ("org", "/", None), ("a.org", "/", "allow"), ("a.org", "/", "block")],
        "host STRING, path STRING, verdict STRING",
    )
    assert tuple(url_filters.judge_urls(df, odd).first())[3:] == ("a.org/", "block")
    assert url_filters.judge_urls(df.limit(0), odd).count() == 0


@pytest.mark.parametrize("value", [None, "x"])
def test_only_urls_without_scheme(spark, value):
    df = spark.createDataFrame([(value,)], "url STRING")
    rules = spark.createDataFrame([("org", "/", "block")], "host STRING, path STRING, verdict STRING")
    assert tuple(url_filters.judge_urls(df, rules).first())[1:] == ("", "", None, "allow")
