"""URL rules against a direct reading of every rule."""

from streamtab.llm import url_filter as uf
from streamtab.llm.registry import URL_RULES


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))
    return host, tail[:end]


def brute(url, rules, default="allow"):
    host, path = parse(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = [None, "", "no scheme/en/1", "http://", "http://example.org", "http://example.org/", "http://EXAMPLE.org/en/12?x=1", "ftp://a.b.example.org/es/",
        "http://notexample.org/es/1", "http://x.com/fr/a#b", "http://x.com/de/a", "http://com/de/", "http://x.com?q=/de/", "http://x.com/DE/",
        "http://org/", "http://a.org:80/", "http://user@b.org/", "a://b://c.org/", "http://\u00dcn\u00ef.org/es/", "http://example.org/es/" + "p/" * 5000,
        "http://" + "a." * 300 + "org/x"] * 2


def test_equals_brute_force(spark):
    rules = URL_RULES + [(None, "/", "block"), ("com", None, "block"), ("org", "/", "allow"), ("example.org", "", "block"), ("b.org", "/", "block"), ("b.org", "/", "allow")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, host string").repartition(4)
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    for limit in (uf.BROADCAST_RULES, 0):
        uf.BROADCAST_RULES, old = limit, uf.BROADCAST_RULES
        try:
            got = uf.judge(pages, r).orderBy("page_id").collect()
        finally:
            uf.BROADCAST_RULES = old
        assert [(x.host, x.path, x.rule, x.verdict) for x in got] == [brute(u, rules) for u in URLS]
    none = uf.judge(pages, r.where("false"), default="block").collect()
    assert {(x.rule, x.verdict) for x in none} == {(None, "block")}
    assert uf.judge(pages.where("false"), r).collect() == []
