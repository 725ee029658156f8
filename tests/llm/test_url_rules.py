"""Rules against a plain scan of all rules."""

import random

import pytest

from subtide.llm import url_rules


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(str.maketrans(url_rules.UPPER, url_rules.LOWER)), rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http:///p", "http://NET", "http://net/", "https://a.b.net/x?y#z", "http://example.net/en/1", "http://m.Example.NET/en/",
    "http://example.net/en", "http://example.net?q=/en/", "http://x.org/fr/1", "http://org/fr/", "http://xorg/fr/", "http://a..net/", "http://.net/", "http://ünet/",
    "http://example.com/de/\U0010ffff", "http://example.com/de/a\nb", "http://netflix/", "ftp://u@example.com:8/de/", "http://example.com/DE/", "a://b://net/",
]


@pytest.mark.parametrize("rules", [
    url_rules.RULES, (), (("block", "net", ""),), (("block", "com", "/"), ("allow", "example.com", "/de/"), ("block", "m.example.com", "/de/x/"), ("allow", "com", "/de/")),
])
def test_cases(spark, rules):
    urls = URLS + ["http://m.example.com/de/x/1", "http://m.example.com/de/", "http://q.com/de/"]
    pages = spark.createDataFrame([(i % 20, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    found = sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in url_rules.judge_urls(pages, table).collect())
    expected = [judge(u, rules) for u in urls]
    assert found == sorted((i % 20, h, p, str(r), v) for i, (h, p, r, v) in enumerate(expected))


def test_random_rules_and_many_ranges(spark):
    rng = random.Random(6)
    label = lambda: rng.choice("a b c ab".split())
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 4)))
    rules = list({(h, p): (v, h, p) for v, h, p in ((rng.choice(("block", "allow")), host(), path()) for _ in range(60))}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = url_rules.judge_urls(pages, table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == len(urls)
    for r in rows:
        fits = [x for x in rules if (r.host == x[1] or r.host.endswith("." + x[1])) and r.path.startswith(x[2])]
        longest = max((len(x[1] + x[2]) for x in fits), default=0)
        assert (r.rule is None) == (not fits) and (not fits or (len(r.rule) == longest and r.rule in {x[1] + x[2] for x in fits}))


def test_empty_table_and_no_python(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    result = url_rules.judge_urls(pages, url_rules.rules_table(spark))
    assert result.collect() == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
