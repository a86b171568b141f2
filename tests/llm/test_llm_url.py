"""URL verdicts: parsing, rules, shrinkage."""

import pytest
from pyspark.sql import functions as F

from personpub.llm.url_filter import SUFFIXES, domain_and_suffix, page_outcomes, url_verdicts

PAGES = "page_id long, url string, host int, path int, rule int, n int, s string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, 1, 2, 3, 4, "s") for i, u in enumerate(urls)], PAGES)


def labels(spark, rows):
    return page_outcomes(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))


def test_host_path_and_rules(spark):
    want = {
        "http://A.Com/x": ("a.com", "/x", "com/", "allow"),
        "https://example.com/en/1?q#f": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://a.www.example.com/en/x": ("a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "https://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
        "https://example.com": ("example.com", "", None, "allow"),
        "https://example.com?x=/en/": ("example.com", "", None, "allow"),
        "x://y.net/es/z://t": ("y.net", "/es/z://t", "net/es/", "block"),
        "http://y.net/fr/": ("y.net", "/fr/", "net/fr/", "block"),
        "http://ÄY.org/É#": ("Äy.org", "/É", None, "allow"),
        "http:///p": ("", "/p", None, "allow"),
        "no scheme.com/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://h.org:80/a\nb?c": ("h.org:80", "/a\nb", None, "allow"),
        "http://" + "a" * 100_000 + ".org/": ("a" * 100_000 + ".org", "/", None, "allow"),
    }
    urls = list(want)
    got = url_verdicts(pages(spark, urls), labels(spark, [])).collect()
    assert {urls[r["page_id"]]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert {r["bad_rate"] for r in got} == {0.5} and {r["labelled"] for r in got} == {0}


def test_shrinkage(spark):
    # many bad outcomes on one host, few on another, none on a third of the same domain
    hosts = ["bad.a.org"] * 60 + ["few.a.org"] * 2 + ["new.a.org"] + ["good.b.org"] * 60 + ["x.c.de"] * 10
    rows = [(i, 0, 0) for i in range(62)] + [(i, 1, 0) for i in range(63, 133)] + [(5, None, None), (None, 0, 1)]
    got = {}
    for r in url_verdicts(pages(spark, [f"http://{h}/p" for h in hosts]), labels(spark, rows)).collect():
        got[r["host"]] = (r["labelled"], r["bad_rate"], r["bad_bound"], r["verdict"])
    assert got["bad.a.org"][0] == 61 - 1 and got["bad.a.org"][3] == "block"
    assert got["good.b.org"][3] == got["x.c.de"][3] == "allow"
    assert got["good.b.org"][1] < got["new.a.org"][1] <= got["few.a.org"][1] <= got["bad.a.org"][1]
    assert got["few.a.org"][2] <= got["bad.a.org"][2]


def test_suffixes_of_two_labels_and_addresses(spark):
    # only the registered domain or the address tells: neither all of co.uk nor the last octets
    hosts = ["y.bad.co.uk"] * 300 + [f"www.site{i % 40}.co.uk" for i in range(400)]
    hosts += ["10.0.7.7:80"] * 100 + ["x.bad.co.uk", "x.new.co.uk", "192.168.7.7"]
    rows = [(i, int(300 <= i < 700), 0) for i in range(800)]
    got = {
        r["host"]: r
        for r in url_verdicts(pages(spark, [f"http://{h}/p" for h in hosts]), labels(spark, rows)).collect()
    }
    assert got["x.bad.co.uk"]["labelled"] == 0 and got["x.bad.co.uk"]["verdict"] == "block"
    assert got["x.new.co.uk"]["verdict"] == got["www.site1.co.uk"]["verdict"] == "allow"
    assert got["10.0.7.7:80"]["verdict"] == "block" and got["192.168.7.7"]["verdict"] == "allow"


def test_domain_and_suffix(spark):
    want = {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "b.uk": ("b.uk", "uk"),
        "a.b.com.br": ("b.com.br", "com.br"), "a.b.com": ("b.com", "com"), "": ("", ""), "x": ("x", "x"),
        "1.2.3.4": ("1.2.3.4",) * 2, "[::ffff:1.2.3.4]": ("[::ffff:1.2.3.4]",) * 2, "1.2.3.4.org": ("4.org", "org"),
    }
    df = spark.createDataFrame([(h,) for h in want], "bare string")
    got = df.select("bare", *domain_and_suffix(F.col("bare"), SUFFIXES)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == want


def test_repeated_rows_and_empty(spark):
    twice = pages(spark, ["http://a.org/"]).unionAll(pages(spark, ["http://a.org/"]))
    assert url_verdicts(twice, labels(spark, [(0, 0, 0)])).count() == 2
    assert url_verdicts(pages(spark, ["x"]).filter("false"), labels(spark, [(0, 0, 0)])).collect() == []


@pytest.mark.parametrize("quality,toxic,bad", [(0, 0, True), (1, 0, False), (1, 1, True), (None, 0, False), (0, None, True), (None, None, None)])
def test_outcomes(spark, quality, toxic, bad):
    assert labels(spark, [(1, quality, toxic)]).first()["bad"] is bad
