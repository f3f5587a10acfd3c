import pytest
from pyspark.sql import functions as F

from rankloom.functions import urls
from rankloom.operators import pages

BASE = "http://a/b/c/d?q"
REFERENCES = {
    "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g",
    "//h": "http://h/", "?y": "http://a/b/c/d?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d?q",
    "g#s": "http://a/b/c/g", "": "http://a/b/c/d?q", ".": "http://a/b/c/", "..": "http://a/b/",
    "../g": "http://a/b/g", "../../../g": "http://a/g", "/./g": "http://a/g", "./g/.": "http://a/b/c/g/",
    "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g?y/../x": "http://a/b/c/g?y/../x",
    "mailto:x@y.z": None, "javascript:void(0)": None, "HTTPS://H:443/x": "https://h/x",
    " g?a=1&amp;b=2 ": "http://a/b/c/g?a=1&b=2", "&#103;&#x2F;&#x1F600;": "http://a/b/c/g/😀",
    "&amp;lt;": "http://a/b/c/&lt;", None: None,
}
CANONICAL = {
    "http://User:Pw@Host.Org.:80": "http://User:Pw@host.org/", "https://h:/a": "https://h/a",
    "https://h:80/a": "https://h:80/a", "http://h/%7euser/%2E%2e/x": "http://h/x", "http:///x": None,
    "http://h/a/../../b/": "http://h/b/", "ftp://h/x": None, "x": None, None: None, "/a/./b?q#f": "/a/b?q",
    "http://h?q#f": "http://h/?q", "http://[::1]:80/": "http://[::1]/",
}


def test_references(spark):
    df = spark.createDataFrame([(k,) for k in REFERENCES], "ref string")
    rows = df.select("ref", urls.resolve_url(F.lit(BASE), F.col("ref")).alias("url")).collect()
    assert {r.ref: r.url for r in rows} == REFERENCES


def test_canonical(spark):
    df = spark.createDataFrame([(k,) for k in CANONICAL], "url string")
    rows = df.select("url", urls.canonical_url(F.col("url")).alias("to")).collect()
    assert {r.url: r.to for r in rows} == CANONICAL


def test_resolve_links(spark):
    table = spark.createDataFrame(
        [(1, "http://a/x/one"), (2, "http://A:80/x/two#top"), (3, "https://b/"), (4, "http://a/x/two"), (5, None)],
        "page_id long, url string",
    )
    links = spark.createDataFrame(
        [(1, 0, "two", "t"), (1, 1, "//b", "other scheme"), (3, 0, "//a/x/one", "x"), (4, 0, "#s", "self"),
         (4, 1, "https://B:443", "b"), (5, 0, "http://a/x/one", "no base"), (5, 1, "one", "nowhere"),
         (1, 2, "mailto:a@b", "m"), (1, 3, None, "n")],
        "page_id long, pos int, href string, text string",
    )
    got = pages.resolve_links(links, table).collect()
    assert sorted((r.page_id, r.pos, r.target, r.text) for r in got) == [
        (1, 0, 2, "t"), (4, 0, 2, "self"), (4, 1, 3, "b"), (5, 0, 1, "no base")
    ]
