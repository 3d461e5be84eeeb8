"""URL rules against their SQL and a direct reading."""

from __future__ import annotations

import check_oracles
from conftest import SMALL

from ledgerloom.llm import url_filter
from ledgerloom.llm.url_filter import host_rule, pattern_rule


def verdicts(spark, urls, rules=None):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.pattern) for r in url_filter.judge(df, rules).collect()}


def test_query_equals_sql(spark):
    assert check_oracles.compare(spark, check_oracles.connect(SMALL), "op8_url_rules", SMALL)[0] == "ok"


def test_hosts_paths_and_longest_rules(spark):
    urls = [
        "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "https://badexample.net/en/1", "https://sub.example.com/de/", "https://example.com/de",
        "ftp://x.org/fr/a://b", "https://net", "https://net/", "https://x.net?/en/", "no scheme", None, "", "://", "https://org/fr/", "https://org.evil.com/fr/",
        "https://a.spam-farm.example.org/en/", "https://notcasino.example.com/", "https://x.casino-win.example.com/", "https://xx.adult-video.example.com/",
    ]
    got = verdicts(spark, urls)
    assert [got[k][2:4] for k in range(len(urls))] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), ("example.com/de/", "block"), (None, "allow"),
        ("org/fr/", "allow"), (None, "allow"), ("net/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("org/fr/", "allow"), (None, "allow"), (None, "block"), (None, "allow"), (None, "block"), (None, "block"),
    ]
    assert got[0][:2] == ("a.example.net", "/en/x") and got[5][:2] == ("x.org", "/fr/a://b") and got[8][:2] == ("x.net", "")
    assert got[9][:2] == got[10][:2] == got[12][:2] == ("", "")


def test_only_rules_of_a_urls_tokens_are_fetched(spark):
    rules = [host_rule("example.com/docs", "block"), host_rule("example.com/", "allow"), pattern_rule("any ads", "block", "[.]ads[.]", ()), host_rule("ä.org/", "block")]
    assert rules[0].tokens == ("example", "com")  # "docs" may go on as a longer word
    df = spark.createDataFrame([("example.com/a",), ("b.com/c",)], "place string").selectExpr("split(place, '[./]') tokens")
    filed = {r.name: r.token for r in url_filter.rule_index(df, url_filter.rule_table(spark, rules)).collect()}
    assert filed == {"example.com/docs": "example", "example.com/": "example", "any ads": "", "ä.org/": "org"}
    got = verdicts(spark, ["https://example.com/docsets", "https://x.ads.net/", "https://Ä.org/", "https://ä.org/"], rules)
    assert [got[k][2:] for k in range(4)] == [("example.com/docs", "block", None), (None, "block", "any ads"), (None, "allow", None), ("ä.org/", "block", None)]


def test_repeats_clashing_columns_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "https://x.net/", "h")] * 3 + [(None, "https://x.net/", "h")], "page_id bigint, url string, host string")
    assert [(r.page_id, r.rule) for r in url_filter.judge(df).orderBy("page_id").collect()] == [(None, "net/"), (1, "net/"), (1, "net/"), (1, "net/")]
    assert url_filter.judge(df.limit(0)).count() == 0


def test_every_rule_of_the_own_list_has_a_literal_token():
    assert all(r.tokens for r in url_filter.LISTED + url_filter.PATTERNS)


def test_ten_thousand_rules_run_few_expressions(spark):
    """Rules come as a table; each url runs the rules of its rare tokens, not all of them."""
    names = [f"site{k}.example{k % 7}.com/path{k}/" for k in range(10_000)]
    rules = url_filter.rule_table(spark, [host_rule(n, "block" if k % 2 else "allow") for k, n in enumerate(names)])
    urls = [f"https://www.site{k}.example{k % 7}.com/path{k}/page" for k in range(0, 10_000, 25)] + ["https://other.example3.com/x"] * 50
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    assert [got[k] for k in range(400)] == [(names[k], "block" if k % 2 else "allow") for k in range(0, 10_000, 25)]
    assert all(got[k] == (None, "allow") for k in range(400, 450))
    places = df.select(url_filter.host_of(df.url).alias("host"), url_filter.path_of(df.url).alias("path")).distinct()
    places = url_filter.with_tokens(places.selectExpr("*", "host || path as place")).cache()
    assert url_filter.fetched(places, url_filter.rule_index(places, rules)).count() <= 2 * places.count()
    places.unpersist()


def test_a_very_long_url(spark):
    got = verdicts(spark, ["https://a.spam-farm.net/" + "x/" * 50_000, "https://x.org/" + "sid/" * 20_000 + "0123456789abcdef0"])
    assert got[0][2:4] == ("net/", "block") and got[1][3:] == ("block", "session path")
