import random

import pytest

from orderflow.llm import url_filters as U


def brute(url, rules=U.RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((i for i, c in enumerate(rest) if c in "/?#"), default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = path[:min((i for i, c in enumerate(path) if c in "?#"), default=len(path))]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fit, key=lambda r: (-len(r.text), r.text), default=None)
    return host, path, best and best.text, best.verdict if best else default


URLS = [None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/",
        "http://example.com/en", "http://notexample.com/en/1", "http://a.b.example.com/en/1?x=/es/", "http://x.net/es/1#top", "http://net/fr/",
        "http://x.net/ES/1", "http://x.net?/es/", "http://x.net#/es/", "https://xnet/es/", "http://İ.com/", "http://x.com//en/", "a://b://c.com/",
        "http://x.net./es/", "http://.com/", "http://x.com/\n/en/", "http://www.example.com:80/en/"]


def test_rules_fit_as_they_are_read(llm_spark):
    df = llm_spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS verdict", "2 AS rule")
    got = {r["page_id"]: tuple(r)[1:] for r in U.filter_urls(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_many_random_rules(llm_spark):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "ab", "com", "net", "x"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 3)))
    path = lambda: "".join("/" + label() for _ in range(rng.randint(0, 3))) + rng.choice(["", "/"])
    rules = [U.UrlRule(rng.choice(["allow", "block"]), host(), path()) for _ in range(60)]
    rules = list({r.text: r for r in rules}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    index = U.RuleIndex(rules, {})
    for u in urls:
        assert (index.judge(*U.split_url(u)) or (None, "allow")) == brute(u, rules)[2:], u
    df = llm_spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert {r["page_id"]: tuple(r)[1:] for r in U.filter_urls(df, rules).collect()} == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_rarest_token_is_the_index(llm_spark):
    df = llm_spark.createDataFrame([(1, "http://a.com/q/1"), (2, "http://b.com/r/1"), (3, "http://b.com/r/q/")], "page_id long, url string")
    rules = [U.UrlRule("block", "com", "/q/"), U.UrlRule("block", "com", "/r/z", pattern=r"\d")]
    counts = U.token_counts(df, "url", rules)
    assert counts == {"h:com": 3, "p:q": 2, "p:r": 2}
    assert set(U.RuleIndex(rules, counts).by_token) == {"p:q", "p:r"}


def test_nulls_repeated_rows_and_empty_tables(llm_spark):
    df = llm_spark.createDataFrame([(None, None), (1, "http://x.net/es/"), (1, "http://x.net/es/")], "page_id long, url string")
    rows = sorted(map(tuple, U.filter_urls(df).collect()), key=str)
    assert rows == sorted([(None, "", "", None, "allow"), *[(1, "x.net", "/es/", "net/es/", "block")] * 2], key=str)
    assert U.filter_urls(df.limit(0)).count() == 0
    assert U.filter_urls(df, ()).count() == 3


@pytest.mark.parametrize("url", URLS)
def test_split(url):
    assert U.split_url(url) == brute(url)[:2]
