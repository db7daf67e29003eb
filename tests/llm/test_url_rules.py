import random

import pytest

from tracemill.llm.url_rules import judge_urls, rule_table

LABELS = ["a", "b", "com", "org", ""]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    ends = [tail.find(c) for c in "?#" if c in tail]
    return host, tail[: min(ends)] if ends else tail


def plain_rule(host, path, rules):
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, "allow")


def judged(pages, rules, spark):
    rows = judge_urls(pages, rule_table(spark, rules)).collect()
    return sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows)


@pytest.mark.parametrize("ranges", [1, 7])
def test_like_brute_force(spark, settings, ranges):
    settings(spark__sql__shuffle__partitions=ranges)
    pick = random.Random(3)
    host = lambda most: ".".join(pick.choice(LABELS) for _ in range(pick.randint(1, most)))
    path = lambda: pick.choice(["", "/", "/x", "/x/", "/x/y", "/xy/z" * 20, "/é/\U0010ffff"])
    rules = {(host(2), path()): pick.choice(["allow", "block"]) for _ in range(40)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http://{host(4).upper()}{path()}{pick.choice(['', '?q=/x', '#y', 'z'])}" for _ in range(400)]
    urls += [None, "", "no url", "http://", "://", "x://A.Com", "http://" + "a." * 2000 + "com/x"]
    urls += ["https://b.com/x/y"] * 200
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    expected = []
    for i, url in enumerate(urls):
        h, p = plain_parts(url)
        rule, verdict = plain_rule(h, p, rules)
        expected.append((i, h, p, rule, verdict))
    assert judged(pages, rules, spark) == sorted(expected)


def test_contradicting_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = [("org", "/", "allow"), ("org", "/", "block"), (None, "/x", "block"), ("a.org", None, "allow")]
    assert judged(pages, rules, spark) == [(1, "a.org", "/x", "org/", "block")]


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert judged(pages, [], spark) == [(1, "a.org", "/x", None, "allow")]
    assert judged(pages.limit(0), [("org", "/", "block")], spark) == []
