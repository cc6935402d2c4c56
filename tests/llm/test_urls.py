"""URL rules and the propagation of trust."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starsift.llm import url_filter as u
from starsift.llm.queries import URL_RULES

PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType())])


@pytest.fixture(scope="module")
def judge(spark):
    def run(rows, rules=URL_RULES, **options):
        full = [(i, url, html) for i, (url, html) in enumerate(rows)]
        return {r["page_id"]: r for r in u.filter_urls(spark.createDataFrame(full, PAGES), rules, **{"tolerance": 1e-2, **options}).collect()}

    return run


CASES = [
    ("http://A.Com/x", "a.com", "/x", "com/", "allow"),
    ("https://example.com/en/1?q#f", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://blog.example.com/en/", "blog.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("ftp://x.net/es/a://b.com/", "x.net", "/es/a://b.com/", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, None),
    ("http://a.com", "a.com", "", None, None),
    ("http://a.com?x=/y", "a.com", "", None, None),
    ("com/x", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("http://user@x.net:80/fr/", "user@x.net:80", "/fr/", None, None),
]


def test_hosts_paths_and_rules(judge):
    got = judge([(c[0], None) for c in CASES])
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict is None or got[i]["verdict"] == verdict


def link(*hosts):
    return "".join(f'<a HREF="//{h}/p">x</a>' for h in hosts) + '<a href="/own">y</a>'


def matrix_ranks(edges, seeds, kind):
    """(hosts, seeded and plain mass that arrives along links) by summing powers of the transition matrix."""
    hosts = sorted({h for e in edges for h in e[:2]})
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        a, b = (a, b) if kind == "trust" else (b, a)
        m[at[a], at[b]] += n
    m = np.array([row / row.sum() if row.sum() else row for row in m])
    start = np.zeros((2, len(hosts)))
    start[1] = 1
    for k, h, x in seeds:
        if k == kind and h in at:
            start[0, at[h]] = x
    arrived, now = np.zeros_like(start), (1 - u.DAMPING) * start
    for _ in range(400):
        now = u.DAMPING * now @ m
        arrived += now
    return hosts, arrived


EDGES = [("a.com", "b.org", 2), ("b.org", "c.org", 1), ("b.org", "a.com", 1), ("c.org", "bad.net", 3), ("d.org", "bad.net", 1), ("p", "q", 1), ("q", "p", 1), ("q", "bad.net", 1)]
SEEDS = [("trust", "a.com", 1.0), ("distrust", "bad.net", 0.75), ("trust", "alone.com", 0.5)]


@pytest.mark.parametrize("kind", ["trust", "distrust"])
def test_ranks_equal_powers_of_the_matrix(spark, kind):
    seeds = spark.createDataFrame(SEEDS, "kind string, host string, seed double")
    links = spark.createDataFrame(EDGES, "src string, dst string, n bigint")
    found = {r["host"]: r for r in u.host_ranks(seeds, links, tolerance=1e-2).where(F.col("kind") == kind).collect()}
    hosts, (seeded, plain) = matrix_ranks(EDGES, SEEDS, kind)
    assert set(found) == set(hosts)
    assert np.allclose(seeded, [found[h]["got"] for h in hosts], rtol=0.1) and np.allclose(plain, [found[h]["got_plain"] for h in hosts], rtol=0.1)
    shares = {r["host"]: r["share"] for r in u.host_shares(seeds, links, tolerance=1e-2).where(F.col("kind") == kind).collect()}
    assert shares.get("alone.com") == (0.5 if kind == "trust" else None)
    for h, s, p in zip(hosts, seeded, plain, strict=True):
        seed = sum(x for k, host, x in SEEDS if (k, host) == (kind, h))
        assert shares[h] == pytest.approx(max(seed, s / p if p else 0.0), abs=0.05)


def test_links_to_blocked_hosts_are_distrusted(judge):
    rows = [("http://bad.net/es/1", None), ("http://farm.org/x", link("bad.net")), ("http://fine.org/x", link("a.com")), ("http://a.com/", link("fine.org"))]
    got = judge(rows)
    assert got[0]["verdict"] == got[1]["verdict"] == "block" and got[1]["distrust"] > got[1]["trust"]
    assert got[2]["verdict"] == "allow" and got[2]["trust"] > 0


@pytest.mark.parametrize("linkers", [1, 2, 1000])
def test_distrust_does_not_thin_out_among_linkers(judge, linkers):
    rows = [("http://bad.net/es/1", None), *[(f"http://h{i}.org/", link("bad.net")) for i in range(linkers)]]
    rows.append(("http://wide.org/", link("bad.net", "a.org", "b.org")))
    got = judge(rows)
    assert all(got[i]["verdict"] == "block" and got[i]["distrust"] == pytest.approx(1.0) for i in range(1, linkers + 1))
    assert got[linkers + 1]["verdict"] == "allow" and 0 < got[linkers + 1]["distrust"] < 0.3


def test_seed_share_is_kept_whoever_links(judge):
    got = judge([*[(f"http://x.net/es/{i}", None) for i in range(9)], ("http://x.net/en/", None), ("http://one.org/", link("x.net", "y.org"))])
    assert got[9]["distrust"] == pytest.approx(0.9) and got[9]["verdict"] == "block" and got[10]["verdict"] == "allow"


def test_distant_hosts_and_loops_are_reached(spark):
    links = [(f"h{i + 1}", f"h{i}", 1) for i in range(12)] + [("p", "q", 1), ("q", "p", 1), ("q", "h0", 1)]
    seeds = [("distrust", "h0", 1.0)]
    found = u.host_shares(spark.createDataFrame(seeds, "kind string, host string, seed double"), spark.createDataFrame(links, "src string, dst string, n bigint"), tolerance=1e-2)
    got = {r["host"]: r["share"] for r in found.where("kind = 'distrust'").collect()}
    hosts, (seeded, plain) = matrix_ranks(links, seeds, "distrust")
    assert all(got[h] == pytest.approx(s / p if p else 1.0, abs=0.05) for h, s, p in zip(hosts, seeded, plain, strict=True) if h != "h0")
    assert got["h1"] == pytest.approx(1.0, abs=0.05) and all(0 < got[f"h{i + 1}"] < got[f"h{i}"] for i in range(1, 12))


def test_empty_and_repeated_pages(judge, spark):
    assert judge([]) == {}
    got = judge([("http://x.net/es/", None)] * 3 + [("http://x.net/en/", link("x.net"))])
    assert got[3]["distrust"] == pytest.approx(0.75) and got[3]["verdict"] == "block"
    assert all(r["verdict"] == "allow" for r in judge([("http://x.net/es/", None)], rules=[]).values())


def test_links_are_parsed(spark):
    html = """<a href='https://One.org/x'> <img src=http://two.org?a> <a href="//three.org"> <a href="/own"> text //no.org/ <a href=" http://x.org/">"""
    pages = spark.createDataFrame([(1, "http://X.org/", html), (2, None, html)], PAGES)
    assert {(r["src"], r["dst"], r["n"]) for r in u.host_links(pages).collect()} == {("x.org", h, 1) for h in ("one.org", "two.org", "three.org")}


def test_no_python_in_the_plan(spark):
    plan = u.host_links(spark.createDataFrame([], PAGES)).groupBy().agg(F.sum("n"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
