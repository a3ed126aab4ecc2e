"""Links of a page: all of them, decoded, absolute, without dot segments."""

from gradeloom.llm import url_filter


def test_links_of_a_page(spark):
    one = '<link rel="canonical" href="{}">'.format
    again = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [("http://A.com/x/y/z?q", one("../a") + one("http://b.com/?p=1&amp;r=2#f") + again("./c") + again("/d/../../e/.") + one("")),
            ("http://a.com", one("f/../g") + one("&#47;&#x2F;h.com/i/./j")), ("http://a.com/k", one("..") + one("http://a.com/l..m/..n")), ("none", one("o")),
            (None, one("http://p.com/")), ("http://q.com/", None), ("http://q.com/", "")]
    got = sorted(tuple(r) for r in url_filter.page_links(spark.createDataFrame(rows, "url string, html string")).collect())
    assert got == sorted([
        ("http://A.com/x/y/z?q", "http://a.com/x/a"), ("http://A.com/x/y/z?q", "http://b.com/?p=1&r=2#f"), ("http://A.com/x/y/z?q", "http://a.com/x/y/c"),
        ("http://A.com/x/y/z?q", "http://a.com/e/"), ("http://a.com", "http://a.com/g"), ("http://a.com", "http://h.com/i/j"),
        ("http://a.com/k", "http://a.com/"), ("http://a.com/k", "http://a.com/l..m/..n")])


def test_a_block_reaches_the_alias_behind_a_second_link(spark):
    pages = spark.createDataFrame([
        (1, "http://m.net/1", '<link rel="canonical" href="http://m.net/x"><link rel="canonical" href="https://x.com/en/../de/1?a=1&amp;b=2">'),
        (2, "http://m.net/2", ""), (3, "https://x.com/de/1?a=1&b=2", "")], "page_id long, url string, html string")
    out = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, [("block", "com", "/de/")]).collect()}
    assert out == {1: "block", 2: "allow", 3: "block"}
