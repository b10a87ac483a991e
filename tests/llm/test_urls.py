import pytest

from brightledger.llm import urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("bad.net", "/", "block"), ("good.net", "/", "allow"), (None, "/", "block"), ("x.y", None, "allow")]


def link(rel="canonical", href="", order=0):
    return f'<link rel="{rel}" href="{href}">' if order else f"<LINK href='{href}' data-x=1 rel='{rel}'/>"


PAGES = [
    (1, "http://a.org/x", None), (2, "http://B.Example.ORG/es/1?q#f", ""), (3, "http://example.org/es", "<p>"),
    (4, "https://plain.net/a", link(href="http://bad.net/z")), (5, "https://plain.net/b", link(href="/a", order=1)),
    (6, "https://plain.net/c#top", "<!-- " + link(href="http://bad.net/q") + " -->"),
    (7, "https://plain.net/d", '<meta http-equiv=refresh content="0; URL=https://plain.net/a">'),
    (8, "https://plain.net/e", link(href="http://good.net/")), (9, "https://plain.net/f", link(href="e")),
    (10, "https://plain.net/g", link(href="http://good.net/")), (11, "http://bad.net/own", link(href="http://good.net/")),
    (12, None, "x"), (13, "no scheme", "x"), (14, "", None), (None, "http://c.com/de/", None), (15, "http://c.com/de/", None), (15, "http://c.com/de/", None),
    (16, "x://bad.net?y/z", None), (17, "x://bad.net/?://a.org/", None), (18, "https://plain.net/h", link(rel="stylesheet", href="http://bad.net/z")),
]
WANT = {
    1: ("a.org", "/x", "org/", "allow"), 2: ("b.example.org", "/es/1", "example.org/es/", "block"), 3: ("example.org", "/es", "org/", "allow"),
    4: ("plain.net", "/a", None, "block"), 5: ("plain.net", "/b", None, "block"), 6: ("plain.net", "/c", None, "allow"), 7: ("plain.net", "/d", None, "block"),
    8: ("plain.net", "/e", None, "allow"), 9: ("plain.net", "/f", None, "allow"), 10: ("plain.net", "/g", None, "allow"), 11: ("bad.net", "/own", "bad.net/", "block"),
    12: ("", "", None, "allow"), 13: ("", "", None, "allow"), 14: ("", "", None, "allow"), 15: ("c.com", "/de/", "com/de/", "block"),
    None: ("c.com", "/de/", "com/de/", "block"), 16: ("bad.net", "", None, "allow"), 17: ("bad.net", "/", "bad.net/", "block"), 18: ("plain.net", "/h", None, "allow"),
}


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, urls.RULE_SCHEMA)


def test_rules_and_aliases(spark, rules):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, rule string")
    rows = urls.filtered(pages, rules).collect()
    assert sorted((r["page_id"] for r in rows), key=str) == sorted((p[0] for p in PAGES), key=str)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == WANT[r["page_id"]], r["page_id"]


def test_redirects_reach_over_many_steps(spark, rules):
    pages = spark.createDataFrame([(i, f"http://h{i}.net/", None) for i in range(30)], "page_id bigint, url string, html string")
    hops = spark.createDataFrame([(f"http://h{i}.net/", f"http://H{i + 1}.net") for i in range(0, 19)] + [("http://h19.net/", "http://bad.net/#x"), (None, "http://bad.net/")],
                                 "from_url string, to_url string")
    got = {r["page_id"]: r["verdict"] for r in urls.filtered(pages, rules, hops).collect()}
    assert got == {i: "block" if i < 20 else "allow" for i in range(30)}


def test_empty_tables(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.org/", None)], "page_id bigint, url string, html string")
    assert urls.filtered(pages.limit(0), rules).isEmpty()
    assert urls.filtered(pages, rules.limit(0)).first()["verdict"] == "allow"
