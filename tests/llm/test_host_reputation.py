from pyspark.sql import functions as F

from strata.llm import host_reputation as H


def judged(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad int")
    return {r["page_id"]: r for r in H.judge(df).collect()}


def test_parts_and_rules(spark):
    urls = ["http://WWW.Example.NET/en/1?x#y", "https://a.example.com/de/2", "x://org/fr/", "http://forg/fr/1", "http://example.net", None,
            "no url", "http://é.net/a?b", "a://b://c/d", "http://myexample.net/en/"]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("www.example.net", "/en/1", "example.net/en/"), ("a.example.com", "/de/2", "example.com/de/"), ("org", "/fr/", "org/fr/"),
        ("forg", "/fr/1", None), ("example.net", "", None), ("", "", None), ("", "", None), ("é.net", "/a", "net/"), ("b:", "//c/d", None),
        ("myexample.net", "/en/", "net/")]
    assert [got[i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "allow"]


def test_shrinkage(spark):
    rows = [(i, "http://bad.example.com/x", 1) for i in range(60)] + [(100 + i, f"http://h{i % 20}.example.com/x", 0) for i in range(200)]
    rows += [(400, "http://once.example.com/x", 1), (401, "http://new.other.org/x", None)]
    got = judged(spark, rows)
    assert got[0]["verdict"] == "block" and got[100]["verdict"] == "allow"
    assert got[400]["verdict"] == "allow"       # one bad page is no proof
    assert got[401]["verdict"] == "allow"


def test_empty(spark):
    assert judged(spark, []) == {}


def test_outcome(spark):
    df = spark.createDataFrame([("a" * 60 + "###",), ("clean text",), ("",), (None,)], "html string")
    assert [r[0] for r in df.select(H.outcome(F.col("html"))).collect()] == [1, 0, 0, None]
