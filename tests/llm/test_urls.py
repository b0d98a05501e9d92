import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import urls
from millrace.llm.queries import URL_RULES

CASES = [
    ("http://Www.Example.org/en/1", "www.example.org", "/en/1", "example.org/en/1", "block"),
    ("https://example.org/en/2?x#y", "example.org", "/en/2", "org/", "allow"),
    ("https://example.org", "example.org", "", None, "allow"),
    ("ftp://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/1://z/de/", "x.com", "/fr/1://z/de/", "com/fr/", "allow"),
    ("http://x.com?/de/", "x.com", "", None, "allow"),
    ("http://x.com:80/de/", "x.com:80", "/de/", None, "allow"),
    ("http://ÀX.COM/de/", "Àx.com", "/de/", "com/de/", "block"),
    ("://com/de/", "com", "/de/", "com/de/", "block"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://h/a\nb?c", "h", "/a\nb", None, "allow"),
    ("http://listed.net/p/?utm_source=x&b=2&a=1#top", "listed.net", "/p/", None, "block"),
    ("http://www.listed.net:443/p?a=1&b=2", "www.listed.net:443", "/p", None, "block"),
    ("http://listed.net/p?a=2&b=2", "listed.net", "/p", None, "allow"),
]


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame([("listed.net/p?a=1&b=2",), ("listed.net/p?a=1&b=2",), (None,), ("other",)], "verdict string")


def test_judge(spark, listed):
    pages = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(CASES)], "page_id long, url string, maybe string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, listed, URL_RULES).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}
    assert urls.judge(pages.where("false"), listed, URL_RULES).count() == 0
    both = urls.judge(pages.union(pages), listed.where("false"), URL_RULES)
    assert both.count() == 2 * len(CASES) and both.where("listed").isEmpty()


@pytest.mark.parametrize("most", [urls.MAX_BLOCKS, 1])
def test_filter_misses_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MAX_BLOCKS", most)
    listed = spark.range(3000).select(F.concat(F.lit("site.net/"), "id").alias("u"))
    table = urls.bloom_blocks(listed, "u")
    assert table.shape == (min(most, 128), 8) and table.dtype == np.uint64
    rows = spark.range(9000).select(F.concat(F.lit("site.net/"), "id").alias("u"), (F.col("id") < 3000).alias("real"))
    rows = rows.withColumn("maybe", urls.may_be_listed(rows, "u", table))
    assert rows.where("real and not maybe").isEmpty()
    if most > 1:
        assert rows.where("maybe and not real").count() < 200


def test_canonical_forms_agree(spark):
    same = ["http://a.org/x", "https://www.A.org/x/", "https://a.org:443/x#f", "http://a.org/x?utm_source=q&ref=y"]
    found = spark.createDataFrame([(u,) for u in same], "u string").select(urls.canonical(F.col("u"))).distinct().collect()
    assert [r[0] for r in found] == ["a.org/x"]
