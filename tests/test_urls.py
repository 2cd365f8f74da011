import pytest
from pyspark.sql import functions as F

from qaloom.functions import urls


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(make(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("url", "kind"),
    [("http://h/A.PDF", "pdf"), ("http://h/b.htm", "html"), ("http://h/c.txt", "txt"), ("http://h/a.pdf?x=1", "pdf"), ("http://h/a.pdf/view", "pdf"), ("http://h/", "unknown"), ("http://a.pdf.com/x", "unknown"), ("http://h/x?f=a.pdf&b", "unknown")],
)
def test_format(spark, url, kind):
    assert one(spark, url, urls.url_format) == kind


@pytest.mark.parametrize(
    ("cell", "found"),
    [
        ('{"urls": ["http://a/x.pdf"]}', ["http://a/x.pdf"]), ("{'topic': 'S', 'urls': ['http://a/x.pdf', 'http://b']}", ["http://a/x.pdf", "http://b"]), ("[1]", []), (None, []), ("", []),
        ('{"urls": null}', []), ('{"urls": "http://one"}', ["http://one"]), ('{"a": 1}', []),
    ],
)
def test_metadata(spark, cell, found):
    assert one(spark, cell, urls.metadata_urls) == found


def test_cleaning(spark):
    assert one(spark, ["", " http://a ", "ftp://b", "HTTP://c", None], urls.valid_urls, "array<string>") == ["http://a"]
    assert one(spark, None, urls.valid_urls, "array<string>") == []


def test_encyclopedia(spark):
    for url, wiki in {"https://en.wikipedia.org/wiki/A%20b": True, "https://en.m.wikipedia.org/wiki/A": False, "https://en.wikipedia.org/w/A": False, "https://xen.wikipedia.org/wiki/A": True}.items():
        assert one(spark, url, urls.is_wiki) is wiki
    assert one(spark, "https://en.wikipedia.org/wiki/C%2B%2B_a+b#x", urls.wiki_title) == "C++_a+b"
    assert one(spark, "https://en.wikipedia.org/w/A", urls.wiki_title) is None
    assert one(spark, '{"query": {"pages": {"1": {"extract": ""}, "2": {"extract": "<p>x</p>"}}}}', urls.wiki_extract) == "<p>x</p>"


def test_dispatch_order(spark):
    rows = spark.createDataFrame([("text/html", "x.pdf"), (None, "a.txt"), ("text/plain", "x"), ("", "x")], "t string, u string")
    assert [r[0] for r in rows.select(urls.dispatch(F.col("t"), F.col("u"))).collect()] == ["pdf", "text", "text", "guess"]
