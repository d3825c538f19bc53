"""Operator 10: url rules and the n-gram model."""

import pytest

from txnlake.llm import url_filter as uf


@pytest.fixture(scope="module")
def model(llm_spark):
    return uf.train(uf.small_url_table(llm_spark))


CASES = [
    ("https://A.Example.NET/en/1?x=1#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://a.example.net/fr/1", "a.example.net", "/fr/1", "net/", "block"),
    ("http://example.com/de/x#f", "example.com", "/de/x", "example.com/de/", "block"),
    ("http://notexample.com/de/x", "notexample.com", "/de/x", None, "allow"),
    ("http://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://b.org?x=/fr/", "b.org", "", None, "allow"),
    ("x://y://z/p", "y:", "//z/p", None, "allow"),
    ("http://net", "net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("no scheme/net/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://best-casino.example.com/en/7", "best-casino.example.com", "/en/7", None, "block"),
    ("http://ÄB.example.com/Ä", "Äb.example.com", "/Ä", None, "allow"),
]


def test_rules_and_parts(llm_spark, model):
    rows = [(k, u, "clash", 1.0) for k, (u, *_) in enumerate(CASES)]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, host string, score double")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.url_filter(pages, model).collect()}
    assert got == {k: tuple(c[1:]) for k, c in enumerate(CASES)}


def test_longest_rule_wins(llm_spark):
    rules = (("net/", "block"), ("a.net/x/", "allow"), ("net/x/y", "block"))
    pages = llm_spark.createDataFrame([(0, "http://a.net/x/z"), (1, "http://a.net/x/y"), (2, "http://a.net/q")],
                                      "page_id long, url string")
    got = {r.page_id: r.rule for r in uf.url_filter(pages, uf.NgramModel(8, (3,), [0.0] * 256, 0.0), rules).collect()}
    assert got == {0: "a.net/x/", 1: "a.net/x/", 2: "net/"}


def test_held_out_words(model):
    unknown = [f"www.{w}.example.com/en/5" for w in ("thring", "orblen", "tionsh", "quarel", "zebra", "teacher")]
    bad = [f"www.{w}.example.com/en/5" for w in ("big-casino", "cheap-viagra", "spam-links", "free-casino")]
    assert (model.score(unknown) <= .9).all() and (model.score(bad) > .9).all()


def test_no_labels_or_one_class():
    args = dict(bits=8, sizes=(3,), steps=5, rate=.5, l2=0.0)
    assert uf.fit([], [], **args).score(["any"])[0] == .5
    assert uf.fit(["a"], [1], **args).score(["any"])[0] > .9
    assert uf.fit(["a", "b"], [0, 0], **args).score([""])[0] < .1


def test_empty(llm_spark, model):
    pages = llm_spark.createDataFrame([], "page_id long, url string")
    assert uf.url_filter(pages, model).count() == 0
