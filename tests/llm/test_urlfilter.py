import random

from pyspark.sql import functions as F

from studyloom.llm import urlfilter as U


def judged(spark, urls, listed=(), **how):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS listed", "2 AS key", "3 AS path", "4 AS rule")
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    return {r.page_id: r for r in U.judge(pages, keys, **how).collect()}


def test_rules(spark):
    got = judged(spark, [
        "http://A.Example.NET/en/1?x", "http://example.net", "http://x.net/", "https://example.com/de/", "https://example.com/deutsch", "http://a.org/fr/2#t",
        None, "no scheme", "HTTP://H.org://x/fr/", "http://badexample.net/en/", "",
    ])
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(11)] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "", None, "allow"), ("x.net", "/", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"),
        ("example.com", "/deutsch", None, "allow"), ("a.org", "/fr/2", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h.org:", "//x/fr/", None, "allow"),
        ("badexample.net", "/en/", "net/", "block"), ("", "", None, "allow"),
    ]


def test_cascade_is_exact(spark):
    rnd = random.Random(4)
    hosts = [f"h{rnd.random()}.com" for _ in range(5000)]
    listed = set(hosts[::7])
    got = judged(spark, [f"http://{h}/" for h in hosts], [*listed, None, "other.com", *list(listed)[:5]], rules=())
    assert all((got[i].verdict == "block") == (h in listed) for i, h in enumerate(hosts))


def test_several_passes_agree(spark, monkeypatch):
    """A list beyond one pass's filters: still a cascade, several levels deep, and no join."""
    hosts = [f"h{i}.com" for i in range(3000)]
    monkeypatch.setattr(U, "MAX_BYTES", 250)
    assert U.passes_needed(1000, 2000) > 2
    depths = []
    plain = U.cascade
    monkeypatch.setattr(U, "cascade", lambda universe: depths.append(plain(universe)) or depths[-1])
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    out = U.judge(pages, spark.createDataFrame([(h,) for h in hosts[::3]], "key string"), rules=())
    assert len(depths) == U.passes_needed(1000, 2000) and min(map(len, depths)) > 2
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.page_id: r.verdict for r in out.collect()}
    assert all((got[i] == "block") == (i % 3 == 0) for i in range(3000)) and len(got) == 3000


def test_pages_as_keys(spark, monkeypatch):
    depths = []
    plain = U.cascade
    monkeypatch.setattr(U, "cascade", lambda universe: depths.append(plain(universe)) or depths[-1])
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = U.judge(pages, U.listed_pages(pages), rules=(), key=U.page_key).collect()
    assert len(got) == pages.count() and len(depths[0]) > 2
    assert all(r.listed == bool(set(r.host.split(".")) & set(U.LISTED_LABELS)) for r in got)


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, ["http://a.b/"])[0].verdict == "allow"


def test_no_python_and_no_join_in_plan(spark):
    pages = spark.createDataFrame([(1, "http://casino-win.example.com/")], "page_id long, url string")
    plan = U.judge(pages, U.listed_pages(pages), key=U.page_key)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and F is not None
