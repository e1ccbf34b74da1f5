import re

import pytest
from pyspark.sql import functions as F

from rideflow.llm import url_reputation as ur
from rideflow.llm.queries import URL_RULES

URLS = [
    "http://Example.COM/En/a?x#y", "https://www.example.com/en/x", "ftp://a.b.example.com/en/", "http://x.net/es/1", "http://net/fr/",
    "http://notnet/fr/", "http://a.net", "http://a.net?q=/es/", "no scheme", "", None, "://", "http:///x", "a://b://c/d", "http://x.com",
    "http://ÀÉ.com/\npath?z", "http://www.example.com/english", "http://example.com#/en/",
]


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def _rule(host, path):
    fits = [(h + p, kind) for kind, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("old"))
    outcomes = ur.page_outcomes(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = {r.page_id: r for r in ur.judge_urls(pages, outcomes, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = _split(url)
        rule, kind = _rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (kind or "allow")


def test_reputation_shrinks_small_hosts(spark):
    rows = [("bad.spam.org", 1)] * 300 + [("good.org", 0)] * 600 + [("new.spam.org", None)] * 5 + [("one.org", 1)] + [("", None)]
    rows += [(f"h{i}.fine.net", int(i % 20 == 0)) for i in range(200)]
    hosts = {r.host: r for r in ur.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert hosts["bad.spam.org"].verdict == "block" and hosts["bad.spam.org"].bound > 0.9
    assert hosts["good.org"].verdict == "allow"
    assert 0 < hosts["one.org"].post < 1  # one bad page is not taken at its word
    # A host without labels has its domain's rate.
    assert hosts["new.spam.org"].post == pytest.approx(hosts["bad.spam.org"].post, abs=0.2)
    assert hosts[""].n == 0 and 0 < hosts[""].post < 1


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    outcomes = spark.createDataFrame([], "host string, bad int")
    assert ur.judge_urls(pages, outcomes, URL_RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in ur.judge_urls(some, outcomes, []).collect()] == ["allow"]


def test_domains(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "b.co.uk", "co.uk", "x.y.org", "org", "")], "h string")
    got = hosts.select(ur.registered_domain(F.col("h")).alias("d"), ur.public_suffix(F.col("h")).alias("s")).collect()
    assert [tuple(r) for r in got] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("y.org", "org"), ("org", "org"), ("", "")]
