import re

import numpy as np

from shelfstack.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
URLS = [
    None, "", "no scheme", "http://a.com", "http://a.com/", "http://A.Com/x?y#z", "http://example.com/en/1", "x://example.com/en", "://example.com/en/",
    "http://www.example.com/en/", "http://m.www.EXAMPLE.com/en/?q", "http://badexample.com/en/", "http://net/es/", "http://a.net/es/x", "http://a.net/ES/",
    "http://a.net?/es/", "http://.net/es/", "http://a..net/es/\n1", "a\nhttp://b.com/\nq", "http://x/://y.com/", "http://ü.com/é", "http://com", "http:///en/",
    "http://a.com:80/en/", "http://" + "a." * 500 + "com/" + "x" * 5000, "http://a.org/en/",
]


def brute(url, rules):
    found = re.match(urls.PARTS, url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(filter(None, (best, (len(h + p), len(h), v == "block", h + p, v))))
    return host, path, best[3] if best else None, best[4] if best else "allow"


def test_agrees_with_brute_force(spark):
    more = RULES + [(f"h{i}.org", "/" + "p" * (i % 5), ("allow", "block")[i % 2]) for i in range(200)] + [("twice.org", "/", "allow"), ("twice.org", "/", "block")]
    every = URLS + [f"http://m.h{i}.org/{'p' * (i % 7)}" for i in range(400)] + ["http://twice.org/a", "http://twice.org/a"]
    pages = spark.createDataFrame(list(enumerate(every)), "page_id long, url string").selectExpr("*", "1 AS host", "'x' AS keys", "2 AS row").repartition(3)
    for rules in (RULES, more, []):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages, rules, "page_id").collect()}
        assert got == {i: brute(u, rules) for i, u in enumerate(every)}
    assert urls.judged(pages.limit(0), RULES, "page_id").count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id % 9000) AS key")
    listed = spark.range(3000).selectExpr("concat('k', id * 4) AS key")
    cascade = urls.build_cascade(listed, universe)
    rows = universe.union(listed).distinct().select("key", *urls._hashes(urls.F.col("key"))).collect()
    one, two = (np.array([r[c] for r in rows]).view(np.uint64) for c in ("one", "two"))
    inside = np.array([int(r.key[1:]) % 4 == 0 and int(r.key[1:]) < 12_000 for r in rows])
    assert (cascade.listed(one, two) == inside).all()
    assert len(cascade.levels) > 2


def test_hosts_of_a_hundred_thousand_labels(spark):
    long = "a." * 100_000
    rows = [(1, f"http://{long}example.com/en/x"), (2, f"http://{long}net/fr/"), (3, f"http://{long}org/")]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/fr/", "block")]
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), rules, "page_id").select("page_id", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == [(1, "example.com/en/", "block"), (2, "net/fr/", "block"), (3, None, "allow")]
