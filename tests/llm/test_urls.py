import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import urls
from pulsegrid.llm.queries import BLOCKED_SITES, BLOCKED_UNDER, URL_RULES

SF = "/root/testdata/sf0.01"
LISTED = [f"{s}.{u}" for s in BLOCKED_SITES for u in BLOCKED_UNDER]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute(url, rules=URL_RULES, listed=LISTED):
    host, path = parts(url)
    best = None
    for verdict, rule in rules:
        rule_host, _, rule_path = rule.partition("/")
        fits = (host == rule_host or host.endswith(f".{rule_host}")) and path.startswith(f"/{rule_path}")
        if fits and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    if best:
        return host, path, best[1], best[0]
    on = any(host == x or host.endswith(f".{x}") for x in listed)
    return host, path, None, "block" if on else "allow"


def judged(spark, pages):
    listed = spark.createDataFrame([(x,) for x in LISTED], "host string")
    return [tuple(r)[1:5] for r in urls.judge_urls(pages, URL_RULES, listed).orderBy("page_id").collect()]


def test_query_equals_brute_force(spark):
    from pulsegrid.llm.queries import QUERIES

    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op10_url_cascade"](spark, SF).collect()
    assert len(rows) == len(pages)
    assert all((r.host, r.path, r.rule, r.verdict) == brute(pages[r.page_id]) for r in rows)


def test_odd_urls(spark):
    some = [
        None, "", "no scheme", "://", "http://", "http://COM/x", "http://com", "http://com?x=/", "https://WWW.Example.com/en/1#a?b", "http://notexample.com/en/",
        "http://example.com/en", "http://example.com/en/", "http://a.b.example.com/en/?q", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "http://.net/es/",
        "http://x..com/", "http://casino-win.example.org/a", "http://m.casino-win.example.net/en/", "http://mycasino-win.example.org/", "a://b://c.com/", "http://u:p@x.com:80/",
        "http://exämple.net/fr/x", "http://x.net/fr/" + "y" * 20_000, "http://org/", "x" * 5000,
    ]
    pages = spark.createDataFrame(list(enumerate(some)) + [(90, some[5]), (91, some[5])], "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit("clash")})
    assert judged(spark, pages) == [brute(u) for u in [*some, some[5], some[5]]]
    assert judged(spark, pages.limit(0)) == []


@pytest.mark.parametrize("n_listed,n_rest", [(300, 20_000), (2000, 2000), (1, 5), (5, 0), (0, 5)])
def test_cascade_is_exact_over_its_universe(spark, n_listed, n_rest):
    rng = random.Random(n_listed)
    keys = [f"{rng.getrandbits(60):x}.example" for _ in range(n_listed + n_rest)]
    listed = spark.createDataFrame([(k,) for k in keys[:n_listed]], "key string")
    universe = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    cascade = urls.build_cascade(listed, universe)
    both = universe.where("key IS NOT NULL").select("key", F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit(1)).alias("b")).toPandas()
    found = cascade.contains(both["a"].to_numpy(), both["b"].to_numpy())
    assert np.array_equal(found, both["key"].isin(keys[:n_listed]).to_numpy())
    bits = sum(size for _, size, _ in cascade.levels)
    assert bits <= 64 * 8 + 40 * n_listed  # grows with the list, not with the universe


def test_query_takes_a_list_of_any_length(spark, tmp_path, monkeypatch):
    """A file of 100,000 hosts, some of them the pages'."""
    from pulsegrid.llm.queries import QUERIES

    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    hosts = sorted({parts(u)[0] for u in pages.values()} - {""})
    mine = hosts[::3]
    (tmp_path / "hosts.txt").write_text("\n".join([*mine, *(f"h{i}.blocked.test" for i in range(100_000)), "", " "]))
    monkeypatch.setenv("PULSEGRID_BLOCKED_HOSTS", f"file://{tmp_path}/hosts.txt")
    rows = QUERIES["op10_url_cascade"](spark, SF).collect()
    want = {i: brute(u, listed=mine) for i, u in pages.items()}
    assert all((r.host, r.path, r.rule, r.verdict) == want[r.page_id] for r in rows)
    assert len({r.verdict for r in rows if r.rule is None}) == 2
