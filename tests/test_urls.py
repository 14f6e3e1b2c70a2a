import pytest
from pyspark.sql import functions as F

from harrowmill.functions import urls as U

CASES = [
    ("", ""), ("http://example.com/article/123", "https://example.com/article/123"),
    ("https://example.com/a?utm_source=tw&utm_medium=social&fbclid=x&gclid=y&ref=feed", "https://example.com/a"),
    ("https://example.com/a?id=42&page=2", "https://example.com/a"), ("https://example.com/article/", "https://example.com/article"),
    ("https://example.com/", "https://example.com/"), ("https://example.com/a#section-2", "https://example.com/a"),
    ("https://Example.COM/Path", "https://example.com/Path"), ("https://www.example.com/a", "https://www.example.com/a"),
    ("http://Example.com/article/?utm_source=x&utm_campaign=y#top", "https://example.com/article"), ("/relative/path", "/relative/path"),
    ("http://Example.com:8080/x/", "https://example.com:8080/x"), (None, None), ("http://bad host/x", None),
]


def test_normalize(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(CASES)], "i int, u string")
    got = [r[0] for r in df.orderBy("i").select(U.normalize_url(F.col("u"))).collect()]
    assert got == [want for _, want in CASES]


def test_normalize_is_idempotent(spark):
    df = spark.createDataFrame([(u,) for u, _ in CASES], "u string").withColumn("n", U.normalize_url(F.col("u")))
    assert df.filter(~U.normalize_url(F.col("n")).eqNullSafe(F.col("n"))).count() == 0


def test_allowed_params(spark):
    df = spark.createDataFrame([("https://youtube.com/watch?v=abc&t=10&x=1",)], "u string")
    assert df.select(U.normalize_url(F.col("u"), allowed_params={"youtube.com": ["v", "T"]})).first()[0] == "https://youtube.com/watch?t=10&v=abc"


@pytest.mark.parametrize("query, kept", [
    ("v=a=b", "v=a%3Db"), ("v=%20x+y&V=1&t=2&v=0", "V=1&t=2&v=+x+y&v=0"), ("v&q=1", "v="), ("v=a~*", "v=a~%2A"), ("v=1;t=2", "v=1;t=2"), ("q=1", ""), ("", ""),
])
def test_allowed_params_are_encoded_again(spark, query, kept):
    df = spark.createDataFrame([(f"https://www.youtube.com/w?{query}",)], "u string")
    got = df.select(U.normalize_url(F.col("u"), allowed_params={"youtube.com": ["v", "T"]})).first()[0]
    assert got == "https://www.youtube.com/w" + (f"?{kept}" if kept else "")


@pytest.mark.parametrize("url, pattern", [("https://a.b/x.y/1", r"^/x\.y/1$"), ("https://a.b", "^/$")])
def test_exact_pattern(spark, url, pattern):
    assert spark.createDataFrame([(url,)], "u string").select(U.exact_path_pattern(F.col("u"))).first()[0] == pattern


def test_host_variants(spark):
    r = spark.createDataFrame([("https://A.b:81/p",), ("x",), (None,)], "u string").select(U.url_hostname(F.col("u")), U.host_with_port(F.col("u")), U.host_or_unknown(F.col("u"))).collect()
    assert [tuple(x) for x in r] == [("a.b", "a.b:81", "a.b"), ("", "", "_unknown_"), (None, None, "_unknown_")]
