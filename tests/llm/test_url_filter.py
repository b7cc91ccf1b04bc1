"""URL rules against plain code, collisions and odd rows."""

import random

import pytest

from tablesync.llm import queries, url_filter
from tablesync.llm.common import table
from tests.compare import differences

PAGES, RULES = "page_id bigint, url string, rule string", "host string, path string, verdict string"


def plain(url, rules, default="allow"):
    host, path = url_filter.split_url(url)
    fitting = [
        (len(h + (p or "")), len(h), h + (p or ""), verdict) for h, p, verdict in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    if not fitting:
        return host, path, None, default
    *_, rule, verdict = max(fitting)  # of equally long rules the one with the longer host
    return host, path, rule, verdict


def run(spark, urls, rules, **options):
    pages = spark.createDataFrame([(n, u, "x") for n, u in enumerate(urls)], PAGES)
    got = url_filter.judge_urls(pages, spark.createDataFrame(rules, RULES), **options).collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r["page_id"])]


@pytest.mark.parametrize("url,host,path", [
    (None, "", ""), ("", "", ""), ("no scheme/x", "", ""), ("http://A.B", "a.b", ""),
    ("x://É.NET/P/Q?r#s", "É.net", "/P/Q"), ("http://h?q=/a", "h", ""), ("http://h#/a", "h", ""),
    ("a://b://c/d", "b:", "//c/d"), ("://h/", "h", "/"),
])
def test_parts(url, host, path):
    assert url_filter.split_url(url) == (host, path)


def test_query_equals_sql(spark, sf_dir, duck):
    df = queries.QUERIES["op10_url_filter"](spark, sf_dir)
    assert df.count() == table(spark, sf_dir, "pages").count()
    assert differences(df, duck, queries.SQL["op10_url_filter"]) == []


@pytest.mark.parametrize("shards", [1, 4])
def test_against_plain_code(spark, shards):
    rng = random.Random(shards)
    labels, paths = ["a", "b", "com", "x"], ["", "/", "/a", "/a/b", "/b"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = {(host(), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    # Two rules that read alike as one text are one rule here; keep the ones that do not.
    rules = [r for r in rules if sum(x[0] + x[1] == r[0] + r[1] for x in rules) == 1]
    urls = [f"http://{host()}{rng.choice(paths)}{rng.choice(['', '/c', '?q', '#f'])}" for _ in range(400)]
    assert run(spark, urls, rules, shards=shards) == [plain(u, rules) for u in urls]


def test_a_digest_collision_decides_nothing(spark, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda key: len(key))
    rules = [("a.com", "/x", "block"), ("b.com", "/y", "allow"), ("c.com", "/z", "block")]
    index = url_filter.build_index(spark.createDataFrame(rules, RULES)).collect()
    opened = [url_filter._open(r["file"]) for r in index]
    found = url_filter._probe(["a.com/x", "d.com/x", "c.com/z"], opened)
    assert set(found) <= {"a.com/x", "c.com/z"}


def test_odd_rows(spark):
    rules = [("n.net", None, "block"), ("n.net", None, "allow"), (None, "/", "block"), ("m", "/", None),
             ("long.org", "/" + "p" * 5000, "block")]
    urls = ["http://n.net", None, "", "http://m/", "http://long.org/" + "p" * 100_000, "http://n.net"]
    got = run(spark, urls, rules)
    assert [r[2] and r[2][:10] for r in got] == ["n.net", None, None, None, "long.org/p", "n.net"]
    assert [r[3] for r in got] == ["block", "allow", "allow", "allow", "block", "block"]
    assert [r[3] for r in run(spark, urls, [], default="block")] == ["block"] * 6
    empty = spark.createDataFrame([], PAGES)
    assert url_filter.judge_urls(empty, spark.createDataFrame(rules, RULES)).collect() == []
    nameless = spark.createDataFrame([(None, "http://n.net/a", "x")] * 2, PAGES)
    got = url_filter.judge_urls(nameless, spark.createDataFrame(rules, RULES)).collect()
    assert [tuple(r) for r in got] == [(None, "n.net", "/a", "n.net", "block")] * 2
