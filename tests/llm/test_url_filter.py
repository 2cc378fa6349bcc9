from courtstats.llm.queries import ORACLES, QUERIES, URL_RULES
from courtstats.llm.url_filter import filter_urls
from tests.llm.oracle import same_as_sql

SF = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    name = "op7_url_filters"
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name], SF)


def brute(url, rules, default="allow"):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


RULES = [*URL_RULES, ("com", "/en/x", "block"), ("b.com", "/en", "allow"), ("dup.org", "/", "allow"),
         ("dup.org", "/", "block"), ("é.fr", "", "block"), ("", "", "block")]
URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a", "http://example.com/en/", "http://example.com/en",
    "x://a.www.example.com/en/?q", "x://notexample.com/en/", "x://a.net/es/1#f", "x://net/fr/", "x://b.com/en/x/y",
    "x://a.b.com/en", "x://dup.org/", "x://s.dup.org?x=/", "x://é.fr", "x://É.fr/", "x://com?/", "x://com#/", "x://com/",
    "x://a.b.c.d.e.f.g.com//en/", "x://" + "a." * 30_000 + "com/" + "z" * 50_000, "a://b.net://c/es/", "x://user@b.com:80/en",
    "x://.com/", "x://com./", "x://\nnet/es/\n",
]


def test_edges(spark):
    pages = spark.createDataFrame([(i, u, "q") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r[0]: tuple(r)[1:] for r in filter_urls(pages.union(pages), rules).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(URLS)}
    assert filter_urls(pages.union(pages), rules).count() == 2 * len(URLS)
    assert filter_urls(pages.limit(0), rules).count() == 0
    none = filter_urls(pages, rules.limit(0), "block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")}
