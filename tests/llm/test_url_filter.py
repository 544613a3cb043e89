import pytest
from pyspark.sql import functions as F

from tests.compare import SF, connect, rows
from tracklore.llm import url_filter as u


def test_query_equals_sql(spark):
    df = u.op4_url_filter(spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = connect().execute(u.SQL)
    assert rows(df.columns, got) == rows([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("n", [1, 40, 500])
def test_cascade_is_exact(spark, n):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter(F.col("key").isin([f"k{i * 3000 // n}" for i in range(n)]))
    cascade = u.build_cascade(listed, keys)
    assert {r[0] for r in keys.filter(cascade.contains(F.col("key"))).collect()} == {r[0] for r in listed.collect()}


def test_rules_and_cases(spark):
    urls = ["http://a.Example.ORG/es/x?q", "https://example.org/en/12#t", "http://x.org", "http://x.org/", "ftp://b.com/fr/", "//no", None, "http://m.cheap-pills.example.com/a", "http://notexample.org.net/", "http://b.com/de/fr/", "://"]
    pages = spark.createDataFrame([(i, t, "x") for i, t in enumerate(urls)] + [(None, urls[0], "x")], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in u.judge(pages).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block") == got[None]
    assert got[1][2:] == ("example.org/en/1", "block") and got[2] == ("x.org", "", None, "allow") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5] == ("", "", None, "allow") == got[6] == got[10]
    assert got[7][3] == "block" and got[8][3] == "allow" and got[9][2:] == ("com/de/", "block")
    assert u.judge(pages.filter("false")).count() == 0 and u.judge(pages, rules=(), hosts=()).filter("verdict = 'block'").count() == 0


def test_long_lists_are_joined(spark):
    urls = ["http://a.Example.ORG/es/x?q", "https://example.org/en/12#t", "http://x.org", "ftp://b.com/fr/", None, "http://m.cheap-pills.example.com/a", "http://b.com/de/fr/", "://", "http://b.com/de/fr/", "http://com/", "http://www.b.c.d/x"]
    pages = spark.createDataFrame([(i, t) for i, t in enumerate(urls)] + [(None, urls[0])], "page_id long, url string")
    key = lambda df: sorted(map(repr, df.collect()))
    more = {"rules": (*u.RULES, ("block", "b.c.d", ""), ("allow", "c.d", "/x")), "hosts": (*u.BLOCKED_HOSTS, "com")}
    assert key(u.judge(pages)) == key(u.judge(pages, max_listed=1))
    assert key(u.judge(pages, **more)) == key(u.judge(pages, **more, max_listed=1))
    real = spark.read.parquet(f"{SF}/pages.parquet")
    assert key(u.judge(real)) == key(u.judge(real, max_listed=1))
