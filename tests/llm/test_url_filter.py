"""URL rules against a plain loop."""

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


URLS = [None, "", "no scheme/en/", "http://Example.COM/en/x", "https://www.example.com/en/", "https://www.example.com/EN/", "ftp://a.net/es/1?x#y",
        "x://a.net/es", "http://net/fr/?q", "http://badexample.com/en/", "http://example.com", "http://example.com?/en/", "http://example.com#/en/",
        "http://a.b.c.example.com/en/deep/", "http://user@example.com/en/", "http://example.com:80/en/", "://com/", "http:///en/", "http://x.com/\n?a",
        "http://x.org/http://y.com/", "http://é.com/ü", "http://com./", "http://.com/", "http://x.com/" + "a" * 5000]


def test_verdicts_match_a_plain_loop(spark):
    rules = [*URL_RULES, ("org", "", "block"), ("com", "/a", "block"), ("com", "/", "block")]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS * 2)] + [(None, URLS[3], None, None)],
                                  "page_id long, url string, _rule string, host int")
    frame = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, action string")
    got = sorted((tuple(r) for r in url_filter.judge_urls(pages, frame).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1], rules)) for r in pages.select("page_id", "url").collect()), key=str)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert [tuple(r) for r in url_filter.judge_urls(pages, rules.limit(0), default="block").collect()] == [(1, "a.com", "/x", None, "block")]


def test_no_python_on_the_executors(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    plan = url_filter.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
