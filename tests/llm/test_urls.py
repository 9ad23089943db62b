from __future__ import annotations

import random

from orderloom.llm import urls


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v, len(h)) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    # Of two as long, the rule of the longer host.
    best = max(fits, key=lambda x: (len(x[0]), x[2]), default=(None, default))
    return host, path, *best[:2]


def check(spark, pages, rules):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(pages)], "page_id long, url string, host string, part int")
    rules_df = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, rules_df).collect()}
    assert len(found) == len(pages)
    for i, u in enumerate(pages):
        assert found[i] == plain(u, rules), u


def test_random_rules(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice(["a", "b", "a-b", "com", "net", "x"]) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choice(["en", "e", "fr", ""]) for _ in range(rng.randint(0, 3)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    pages = [f"http://{host().upper()}{path()}{rng.choice(['', '?q=/en/', '#top'])}" for _ in range(1500)]
    pages += [None, "", "nothing", "a.com/en", "://", "http://", "http://com", "http://com?x", "x://y://com/", "http://a..com/en/"]
    pages += ["http://hot.com/en/1"] * 700 + ["http://" + "a." * 3000 + "com/" + "e" * 100_000]
    check(spark, pages, rules)


def test_given_rules_and_empty(spark):
    check(spark, [f"https://{h}/{p}/1" for h in ("www.example.com", "example.com", "a.example.com", "b.net", "net") for p in ("en", "es", "fr")], list(urls.RULES))
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty, rules).count() == 0
    some = spark.createDataFrame([(1, "http://com/x")], "page_id long, url string")
    assert urls.judge(some, rules.limit(0), default="block").collect()[0].verdict == "block"
