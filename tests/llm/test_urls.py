"""URL rules and host reputation."""

from compare import difference, duck
from pyspark.sql import functions as F

from diamondlake.llm.queries import ORACLE, QUERIES, URL_RULES
from diamondlake.llm.url_reputation import Rule, host_reputation, judge_urls

PAGES = "page_id long, url string, host string, bad long, n string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", 9, "n") for i, u in urls], PAGES)


def judged(spark, urls, outcomes=(), rules=URL_RULES):
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad long")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages(spark, urls), labels, rules).collect()}


def test_rules(spark):
    urls = [
        "http://WWW.Example.com/en/a?x#y", "https://blog.example.com/en/1", "https://a.com", "https://a.com/", "http://b.net/fr/", "http://b.net/en/",
        None, "no scheme", "x://h://p/q", "http://h?q=/en/", "http://h#f", "http://notexample.com/en/", "://", "http://\u00c4B.net/es/#",
    ]
    assert list(judged(spark, list(enumerate(urls))).values()) and judged(spark, list(enumerate(urls))) == {
        0: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 1: ("blog.example.com", "/en/1", "example.com/en/", "block"),
        2: ("a.com", "", None, "allow"), 3: ("a.com", "/", "com/", "allow"), 4: ("b.net", "/fr/", "net/fr/", "block"), 5: ("b.net", "/en/", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("h:", "//p/q", None, "allow"), 9: ("h", "", None, "allow"), 10: ("h", "", None, "allow"),
        11: ("notexample.com", "/en/", "com/", "allow"), 12: ("", "", None, "allow"), 13: ("\u00c4b.net", "/es/", "net/es/", "block"),
    }


def test_reputation(spark):
    """A host with many bad pages is blocked, a thin one is shrunk towards its domain."""
    urls = [(i, "http://bad.one.org/p") for i in range(40)] + [(100 + i, "http://good.two.org/p") for i in range(40)]
    urls += [(200, "http://thin.two.org/p"), (201, "http://new.org/p"), (0, "http://bad.one.org/again"), (None, "http://bad.one.org/x")]
    outcomes = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(200, 1), (None, 1)]
    got = judged(spark, urls, outcomes)
    assert got[1][3] == got[None][3] == "block" and got[101][3] == got[200][3] == got[201][3] == "allow"
    table = pages(spark, urls).drop("bad").join(spark.createDataFrame(outcomes, "page_id long, bad long"), "page_id", "left")
    hosts = {r["host"]: r for r in host_reputation(table).collect()}
    assert hosts["bad.one.org"]["mean"] > 0.9 and hosts["thin.two.org"]["mean"] < 0.9 and hosts["new.org"]["n"] == 0


def test_ties_and_empty(spark):
    rules = (Rule("allow", "a.b", "/"), Rule("block", "a.b", "/"))
    assert judged(spark, [(1, "http://a.b/")], rules=rules)[1] == ("a.b", "/", "a.b/", "block")
    assert judged(spark, []) == {}


def test_query(spark, small):
    assert difference(QUERIES["op10_url_reputation"](spark, small), duck(small), ORACLE["op10_url_reputation"]) is None
    plan = QUERIES["op10_url_reputation"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert F is not None
