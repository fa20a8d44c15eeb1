"""URL rules against a plain parser, and the posterior's behaviour."""

import re

from pyspark.sql import functions as F

from rentlens.llm.queries import ORACLE, QUERIES, URL_RULES
from rentlens.llm.url_reputation import ADDRESS, host_levels, judge_urls
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

URLS = [None, "", "no scheme/x", "HTTP://A.Example.ORG/es/1", "https://example.org/en/1?x", "https://example.org/en/2#f",
        "http://org", "http://org/", "http://notorg/x", "http://x.com:80/fr/", "http://x.com/FR/", "ftp://sub.example.org/es/", "://h/p",
        "a://b://c/d", "http://x.com?/fr/", "http://x.com/de/\nq", "http://ÄB.com/de/", "http://user@x.com/de/1"]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2]


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def check(rows, urls):
    for r in rows:
        host, path = parse(urls[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == rule.action if rule else r.verdict in ("allow", "block")


def test_rules_equal_a_plain_parser(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    none = spark.createDataFrame([], "host string, bad int")
    rows = judge_urls(df, none, URL_RULES).collect()
    assert len(rows) == len(URLS) and all(r.verdict == "allow" for r in rows if r.rule is None)
    check(rows, URLS)


def test_query_judges_every_page(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = QUERIES["op9_url_reputation"](spark, SF_SMALL).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    check(rows, pages)


def test_query_matches_its_sql(spark):
    r = compare(spark, "op9", QUERIES["op9_url_reputation"], ORACLE["op9_url_reputation"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "match", r


def test_evidence_blocks_and_little_evidence_does_not(spark):
    out = [("bad.site.net", 1)] * 60 + [("bad.site.net", 0)] * 2 + [("new.fresh.net", 1)] + [("good.net", 0)] * 200 + [
        ("other.net", i % 10 == 0) for i in range(100)] + [("unseen.net", None)]
    outcomes = spark.createDataFrame([(h, None if b is None else int(b)) for h, b in out], "host string, bad int")
    urls = ["http://bad.site.net/x", "http://new.fresh.net/x", "http://good.net/", "http://unseen.net/", "http://bad.site.net/x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r.page_id: r for r in judge_urls(df, outcomes, []).collect()}
    assert [rows[i].verdict for i in range(5)] == ["block", "allow", "allow", "allow", "block"]
    assert rows[3].bad_lower is not None and rows[2].bad_lower < rows[1].bad_lower < rows[0].bad_lower
    assert judge_urls(df.limit(0), outcomes, URL_RULES).count() == 0


def test_domains_and_suffixes_of_hosts(spark):
    want = {"a.b.com": ("b.com", "com"), "b.com": ("b.com", "com"), "com": ("com", "com"), "": ("", ""),
            "x.a.com.mx": ("a.com.mx", "com.mx"), "a.co.uk": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
            "w.gov.au": ("w.gov.au", "gov.au"), "a.com.info": ("com.info", "info"), "u@w.b.net:80": ("b.net", "net"),
            "b.net.": ("b.net", "net"), "10.1.2.3": ("10.1.2.3", ADDRESS), "99.8.2.3:8080": ("99.8.2.3", ADDRESS),
            "1.2.3": ("2.3", "3"), "[2001:db8::1]": ("[2001:db8::1]", ADDRESS), "[::1]:443": ("[::1]", ADDRESS)}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = host_levels(F.col("host"))
    assert {r.host: (r.d, r.s) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == want


def test_addresses_share_no_reputation(spark):
    out = [("10.1.2.3", 1)] * 80 + [("b.net", 0)] * 80
    outcomes = spark.createDataFrame(out, "host string, bad int")
    df = spark.createDataFrame([(0, "http://10.1.2.3/x"), (1, "http://99.8.2.3/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in judge_urls(df, outcomes, []).collect()} == {0: "block", 1: "allow"}


def test_host_counts_are_read_and_not_counted_anew(spark):
    plan = QUERIES["op9_url_reputation"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_id") > 0 and "labels" not in plan and "quality" not in plan
