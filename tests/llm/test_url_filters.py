import random

from tidemart.llm import url_filters
from tidemart.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    rest = (url or "").partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    for c in "?#":
        path = path.partition(c)[0]
    best = (0, None, default)
    for rule, action in rules:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]) and len(rule) > best[0]:
            best = (len(rule), rule, action)
    return host, path, best[1], best[2]


def rules_df(spark, rules):
    return spark.createDataFrame(rules, "rule string, action string")


URLS = [None, "", "no scheme", "http://", "http:///x", "://net/", "https://NET/", "http://a.net", "http://a.net/", "http://anet/",
        "http://x.example.net/en/1", "http://example.net/EN/1", "http://example.net/english", "HTTP://WWW.Example.COM/de/?q#f",
        "http://example.com/de", "http://example.com.evil/de/", "http://a.org/fr/x://y/", "http://net:80/", "http://É.net/é",
        "http://a.net?x=/y", "http://a.net#/y", "http://.net/", "http://a..net/x", "x" * 200_000 + "://b.net/" + "y/" * 50_000]


def test_verdicts_by_brute_force(spark):
    rng = random.Random(1)
    urls = URLS + ["http://" + ".".join(rng.choice(["a", "example", "net", "com", "org"]) for _ in range(rng.randint(1, 4)))
                   + "".join("/" + rng.choice(["en", "de", "fr", ""]) for _ in range(rng.randint(0, 3))) for _ in range(300)]
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)] + [(None, URLS[6], "x", "y", "z")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, verdict string")
    for rules in (URL_RULES, [*URL_RULES, ("example.net/e", "block"), ("a.net/", "allow"), ("com/de/", "allow")]):
        got = url_filters.filter_pages(pages, rules_df(spark, rules)).collect()
        want = [(i, *brute(u, rules)) for i, u, *_ in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_tables_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    no_rules = rules_df(spark, [])
    assert [tuple(r) for r in url_filters.filter_pages(pages, no_rules).collect()] == [(1, "a.net", "/", None, "allow")]
    both = rules_df(spark, [("net/", "allow"), ("net/", "block"), (None, "block"), ("/x", "block")])
    assert url_filters.filter_pages(pages, both).collect()[0].verdict == "block"
    assert url_filters.filter_pages(pages.limit(0), both).count() == 0
