"""URL rules: against a plain loop over all rules, against SQL, and with equal digests."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthmill.llm import queries, url_rules
from tests.oracle_check import compare, connect


def plain(url, rules):
    """(host, path, rule, verdict) by trying every rule."""
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = {}
    for action, h, p in rules:
        if action not in ("allow", "block") or h is None or re.search("[/?#]", h) or (p or "") and not (p or "").startswith("/"):
            continue
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            key = (len((h + (p or "")).encode()), len(h), h + (p or ""))
            fits[key] = "block" if action == "block" else fits.get(key, "allow")
    return (host, path, max(fits)[2], fits[max(fits)]) if fits else (host, path, None, "allow")


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x=/es/#y", "http://example.com", "http://example.com?x=1", "http://example.com/en", "http://a.b.example.com/en/x", "http://notexample.com/en/x",
    "http://x.net/es/", "http://x.net/ES/", "http://net/fr/1", "http://x.net:80/fr/1", "http://user@x.net/fr/1", "http://É.COM/é", "a://b://c.com/x", "http://.com/", "http://com./", "http://x.com\n/en/", "http://x.com/" + "y" * 100_000,
    "http://www.example.com/en/1#http://x.net/fr/", "://com/", "http://deep.blocked.example.org/long/way/down", "http://blocked.example.org/longer", "http://ünï.example/ßtraße/1", "http://x.com/a\u0000b",
]
MORE = [
    ("block", "org", None), ("allow", "example.org", "/long"), ("block", "blocked.example.org", "/lo"), ("block", "Deep.Blocked.Example.ORG", "/long/way/"), ("allow", "ünï.example", "/ß"), ("block", "dup.com", "/"), ("allow", "dup.com", "/"),
    ("block", "bad/host", "/"), ("block", "com", "nopath"), ("maybe", "com", "/a"), (None, "com", "/b"), ("block", None, "/c"), ("block", "", "/"), ("allow", "", ""),
]


@pytest.mark.parametrize("shard_rules", [url_rules.SHARD_RULES, 2])
def test_rules_of_odd_urls(spark, shard_rules):
    urls = [*URLS, "http://dup.com/x", *URLS[:5]]
    for rules in (url_rules.RULES, url_rules.RULES + MORE, []):
        table = spark.createDataFrame([(h, p, a, "k") for a, h, p in rules], "host string, path string, action string, key string")
        index = url_rules.build(table, shard_rules=shard_rules)
        pages = spark.createDataFrame([(k, u, "mine", "clash") for k, u in enumerate(urls)], "page_id long, url string, verdict string, `odd.name` string")
        found = url_rules.judged(pages, index)
        assert found.columns == ["page_id", "url", "odd.name", "host", "path", "rule", "verdict"]
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
        assert got == {k: plain(u, rules) for k, u in enumerate(urls)}
        assert url_rules.judged(pages.limit(0), index).count() == 0
    assert url_rules.judged(pages, index, otherwise="block").where("verdict = 'block'").count() == len(urls)


def test_equal_digests_are_told_apart(spark, tmp_path):
    texts = [f"host{i}/" .encode() for i in range(40)]
    keys = np.sort(np.array([i // 8 - 2 for i in range(40)], np.int64))
    at = url_rules.Shard(url_rules.write_shard(f"file://{tmp_path}", keys, texts, np.arange(40) % 2))
    asked = [*texts, b"other/"]
    found = dict(at.find(asked, np.array([*keys, 0])))
    assert found == {k: k % 2 for k in range(40)}
    assert list(at.find([b"x"], np.array([99]))) == []


def test_digests_are_sparks(spark):
    texts = ["", "com/", "ünï.example/ß", "x" * 1000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert got == [url_rules.digest(t.encode()) for t in texts]


def test_many_rules_in_many_shards(spark):
    hosts = [f"{a}{b}.{c}.example" for a, b, c in itertools.product("abcdefgh", range(40), "xyz")]
    rules = [(("allow", "block")[i % 2], h, f"/{i % 3}") for i, h in enumerate(hosts)]
    index = url_rules.build(url_rules.rule_table(spark, rules), shard_rules=100)
    assert len(index.shards) > 5
    urls = [f"http://www.{h}/{k}/x" for h in hosts for k in range(3)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    table = dict(zip(hosts, rules, strict=True))
    for r in url_rules.judged(pages, index).collect():
        action, h, p = table[r.host.removeprefix("www.")]
        assert (r.rule, r.verdict) == ((h + p, action) if r.path.startswith(p) else (None, "allow"))


def test_registered_url_rules(spark):
    folder = "/root/testdata/sf0.1"
    assert compare(spark, connect(folder), folder, queries.op12_url_rules, url_rules.ORACLE_SQL) is None
    rows = queries.op12_url_rules(spark, folder).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    assert all((r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], url_rules.RULES) for r in rows) and len({r.rule for r in rows}) > 4
