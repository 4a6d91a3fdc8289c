"""Verdicts of urls and of what redirects to them."""

import pytest

from erascore.llm import urls as U

CASES = [
    ("http://example.org/es/x", "example.org/es/", "block"), ("http://a.b.EXAMPLE.org/es/", "example.org/es/", "block"),
    ("http://example.org/es", "org/", "allow"), ("http://example.org/en/1", "example.org/en/1", "block"), ("http://example.org/en/19", "example.org/en/1", "block"),
    ("http://badexample.org/es/", "org/", "allow"), ("http://org/", "org/", "allow"), ("http://org", None, "allow"), ("http://x.org?q=/", None, "allow"),
    ("http://example.org:80/es/", None, "allow"), ("http://com/de/", "com/de/", "block"), ("http://x.com/fr/", "com/fr/", "allow"), ("http://x.com/de", None, "allow"),
    ("http://x.com#/de/", None, "allow"), ("a://b://x.com/de/", None, "allow"), ("x.com/de/", None, "allow"), ("", None, "allow"), (None, None, "allow"), ("://x.com/de/", "com/de/", "block"),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "<p>", "r", "v") for i, (u, _, _) in enumerate(CASES)]
    return {r["page_id"]: r for r in U.url_report(spark.createDataFrame(rows, "page_id long, url string, html string, rule string, verdict string")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rules(judged, i):
    assert (judged[i]["rule"], judged[i]["verdict"]) == CASES[i][1:]


def test_parts(judged):
    assert (judged[1]["host"], judged[1]["path"]) == ("a.b.example.org", "/es/")
    assert (judged[17]["host"], judged[17]["path"]) == ("", "") == (judged[15]["host"], judged[15]["path"])
    assert (judged[8]["host"], judged[8]["path"]) == ("x.org", "")


def test_decisions_reach_aliases(spark):
    link, refresh = '<link rel="canonical" href="{}">', "<META HTTP-EQUIV=refresh content='0; url={}'>"
    rows = [
        (1, "http://s.net/a", link.format("http://t.net/b#top")), (2, "http://t.net/b", refresh.format("http://x.com/de/z")), (3, "http://x.com/de/z", None),
        (4, "http://u.net/a", link.format("http://y.com/de/q")), (5, "http://y.com/de/q", refresh.format("http://z.org/ok")), (6, "http://z.org/ok#f", ""),
        (7, "http://free.net/", link.format("http://free.net/")), (8, "HTTP://S.net/a#again", "x"), (None, None, link.format("http://x.com/de/z")),
        (9, "http://v.net/", '<link rel="stylesheet" href="http://x.com/de/z">'),
    ]
    got = {r["page_id"]: r["verdict"] for r in U.url_report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "block", None: "allow", 9: "allow"}


def test_empty_table(spark):
    assert U.url_report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_targets_of_every_form(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    page, want = "http://A.x.net/p/q/r?s=1#t", "http://a.x.net"
    forms = [
        (refresh.format("'https://x.com/de/1'"), "https://x.com/de/1"), (refresh.format("/de/1"), want + "/de/1"), (link.format("/de/1?k=2#f"), want + "/de/1?k=2"),
        (link.format("//y.com/de/1"), "http://y.com/de/1"), ('<link rel="alternate canonical" href=z>', want + "/p/q/z"), (link.format("../z/./y"), want + "/p/z/y"),
        (link.format("../../../../z/.."), want + "/"), (link.format("?k"), want + "/p/q/r?k"), ("<META content='3;http://y.com/b' http-equiv=Refresh>", "http://y.com/b"),
        ("<link href='z' rel='canonical'>", want + "/p/q/z"), ("<base href='/w/'>" + link.format("z"), want + "/w/z"), (link.format("http://y.com/c"), "http://y.com/c"),
        ("<link rel=canonical href=/u>", want + "/u"), (link.format("."), want + "/p/q/"),
        (link.format("#top"), None), (link.format("mailto:a@b"), None), (link.format(""), None), ('<link rel="noncanonical" href="/x">', None), (refresh.format(""), None),
    ]
    rows = [(i, page.replace("x.net", f"x{i}.net"), h) for i, (h, _) in enumerate(forms)]
    got = {r["a"]: r["b"] for r in U.link_edges(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    node = f"{want}/p/q/r?s=1"
    expected = {node.replace("x.net", f"x{i}.net"): b and b.replace("a.x.net", f"a.x{i}.net") for i, (_, b) in enumerate(forms)}
    assert {a: got.get(a) for a in expected} == expected


def test_relative_redirects_spread_decisions(spark):
    rows = [(1, "http://s.net/", '<meta http-equiv="refresh" content="0; url=\'//x.com/de/1\'">'), (2, "http://x.com/start", '<link rel="alternate canonical" href="/de/1">')]
    got = {r["page_id"]: r["verdict"] for r in U.url_report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block"}


def test_plans_stay_small(spark):
    pages = spark.createDataFrame([(1, "http://s.net/", "")], "page_id long, url string, html string")
    assert len(U.link_edges(pages)._jdf.queryExecution().optimizedPlan().toString()) < 50_000  # once 1,069,427: parts of parts were copied in


def test_edges_equal_those_of_plain_rows(spark):
    """A page with several tags, bases and repeated rows; null urls and texts name no edge."""
    html = "<base href='//b.net/w/'><link rel=canonical href=x><link rel=canonical href='x#f'><meta http-equiv=refresh content='1; /y'>"
    rows = [(1, "http://s.net/p", html), (1, "http://s.net/p", html), (2, None, html), (3, "http://s.net/p", None), (4, "HTTP://b.net/w/x", html)]
    got = U.link_edges(spark.createDataFrame(rows, "page_id long, url string, html string")).distinct().collect()
    assert sorted(map(tuple, got)) == [("http://b.net/w/x", "http://b.net/y"), ("http://s.net/p", "http://b.net/w/x"), ("http://s.net/p", "http://b.net/y")]
