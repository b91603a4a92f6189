import random

import pytest

from kithline.llm import url_filter
from kithline.llm.url_filter import judge_urls


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if c.isascii() else c for c in rest.split("/")[0].split("?")[0].split("#")[0])
    path = rest[len(host) :].split("?")[0].split("#")[0]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://org", "https://a.ORG/x?y#z", "ftp://example.org/es/1://u", "http://com/fr/", "http://x.com/fr", "http://notorg/", "http://.org/", "http://a..org/", "http://é.example.org/en/12", "http://x?://y/", "http://a.com:80/fr/"]


@pytest.mark.parametrize("size", [20_000, 7])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(url_filter, "RANGE", size)
    rng = random.Random(2)
    hosts = ["org", "example.org", "b.example.org", "a.b.example.org", "com", "x.com", "net", ""]
    paths = ["", "/", "/e", "/es/", "/en/1", "/en/12/x", "/fr/"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(25)]
    urls = URLS + [f"http://{rng.choice(['', 'www.', 'm.b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'q', '?u=1', '#t'])}" for _ in range(300)]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, URLS[4], "h", "r")] * 2, "page_id long, url string, host string, rule string").repartition(3)
    got = judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id if r.page_id is not None else 4], rules), urls[r.page_id or 4]


def test_empty_tables(spark):
    urls, rules = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in judge_urls(urls, rules, "block").collect()] == [(None, "block")]
    assert judge_urls(urls.where("false"), rules).count() == 0
