import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartlake.llm import url_filter as uf

PAGES = "page_id bigint, url string, host string, n int, verdict string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "old", 1, "old") for i, u in urls], PAGES)


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("https://WWW.Example.COM:80/A/b?x=/#y", "www.example.com:80", "/A/b"),
        ("http://a.b#c/d", "a.b", ""),
        ("http://a.b?c/d", "a.b", ""),
        ("x://y://z/w", "y:", "//z/w"),
        ("http://Ünï.de", "Ünï.de", ""),
        ("example.com/a", "", ""),
        ("://", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("a\n://b\nc/d\ne", "b\nc", "/d\ne"),
    ],
)
def test_split_url(spark, url, host, path):
    h, p = uf.split_url(F.col("url"))
    assert tuple(spark.createDataFrame([(url,)], "url string").select(h, p).first()) == (host, path)


@pytest.mark.parametrize(
    "host, domain, suffix",
    [
        ("a.b.example.com", "example.com", "com"),
        ("a.b.example.co.uk", "example.co.uk", "co.uk"),
        ("co.uk", "co.uk", "co.uk"),
        ("com", "com", "com"),
        ("xco.uk", "xco.uk", "uk"),
        ("", "", ""),
    ],
)
def test_registered(spark, host, domain, suffix):
    d, s = uf.registered(F.col("host"))
    assert tuple(spark.createDataFrame([(host,)], "host string").select(d, s).first()) == (domain, suffix)


def test_rules_against_all_of_them(spark):
    rnd = random.Random(2)
    names = ["com", "a.com", "b.a.com", "org", "x.org", "ba.com"]
    rules = {(rnd.choice(names), rnd.choice(["/", "/p", "/p/q", "", "/z"])): rnd.choice(["allow", "block"]) for _ in range(20)}
    urls = [(rnd.choice([*names, "c.b.a.com", "net", ""]), rnd.choice(["", "/", "/p/q/r", "/pq", "/z"])) for _ in range(300)]
    listed = spark.createDataFrame([(v, h, p) for (h, p), v in rules.items()], "verdict string, host string, path string")
    found = uf.match_rules(spark.createDataFrame(urls, "host string, path string"), listed).collect()
    want = {}
    for host, path in set(urls):
        fits = [
            (-len(h + p), h + p, v)
            for (h, p), v in rules.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        if fits:
            want[host, path] = min(fits)[1:]
    assert {(r.host, r.path): (r.rule, r.verdict) for r in found} == want and len(found) == len(want)


def estimate(groups, prior):
    """Weight and means of ``{name: (n, bad)}`` with a prior each."""
    over = sum((b - n * prior[g]) ** 2 - n * prior[g] * (1 - prior[g]) for g, (n, b) in groups.items())
    under = sum(n * (n - 1) * prior[g] * (1 - prior[g]) for g, (n, b) in groups.items())
    spread = min(max(over / under if under else uf.MOST_SPREAD, uf.LEAST_SPREAD), uf.MOST_SPREAD)
    weight = 1 / spread - 1
    return weight, {g: (b + weight * prior[g]) / (n + weight) for g, (n, b) in groups.items()}


def labelled(seed):
    """Pages of good and bad hosts, some without labels."""
    rnd = random.Random(seed)
    share = {f"h{i}.{d}": 0.95 if d == "spam.biz" or i == 3 else 0.05 for i in range(6) for d in ("a.com", "b.com", "spam.biz")}
    urls, outcomes = [], []
    for k in range(1500):
        host = rnd.choice(list(share))
        urls.append((k, f"http://{host}/{k}"))
        if rnd.random() < 0.4 and not host.startswith("h5"):
            outcomes.append((k, rnd.random() < share[host]))
    return urls, outcomes, share


def test_reputations_against_plain_sums(spark):
    urls, outcomes, share = labelled(1)
    labels = spark.createDataFrame(outcomes, "id bigint, bad boolean")
    h, _ = uf.split_url(F.col("url"))
    found = {r.host: r for r in uf.reputations(pages(spark, urls).withColumn("host", h), labels).collect()}
    hosts = {h: [0, 0] for h in share}
    for k, bad in outcomes:
        host = urls[k][1].split("/")[2]
        hosts[host][0] += 1
        hosts[host][1] += bad
    up = [lambda h: h, lambda h: h.split(".", 1)[1], lambda h: h.rsplit(".", 1)[1], lambda h: ""]
    sums = [defaultdict(lambda: [0, 0]) for _ in up]
    for host, (n, bad) in hosts.items():
        for level, name in enumerate(up):
            sums[level][name(host)][0] += n
            sums[level][name(host)][1] += bad
    total = sums[3][""]
    means = {"": (total[1] + 0.5) / (total[0] + 1)}
    for level in (2, 1, 0):
        groups = sums[level]
        some = {up[level](h): up[level + 1](h) for h in hosts}
        weight, means = estimate(groups, {g: means[some[g]] for g in groups})
    for host, r in found.items():
        n, bad = hosts[host]
        assert (r.n, r.bad) == (n, bad) and math.isclose(r.mean, means[host])
        wide = uf.DEVIATIONS * math.sqrt(r.mean * (1 - r.mean) / (n + weight + 1))
        assert math.isclose(r.low, max(0, r.mean - wide)) and r.kept == (r.low <= uf.MAX_BAD)


def test_bad_hosts_are_blocked_and_clean_ones_kept(spark):
    urls, outcomes, share = labelled(2)
    judged = uf.judge(pages(spark, urls), spark.createDataFrame(outcomes, "id bigint, bad boolean"))
    verdicts = {(r.host, r.verdict) for r in judged.collect()}
    # Hosts without labels go by their domain.
    blocked = {h for h in share if h.endswith("spam.biz") or h.startswith("h3")}
    assert verdicts == {(h, "block" if h in blocked else "allow") for h in share}


def test_edges(spark):
    urls = [(1, None), (1, "http://a.com/x"), (None, "http://a.com/x"), (2, ""), (3, "http://" + "a." * 20_000 + "com/" + "p" * 100_000)]
    urls += [(4, "http://A.COM/x")] * 2
    outcomes = spark.createDataFrame([(1, True), (1, None), (None, True), (4, False), (4, False), (99, True)], "id bigint, bad boolean")
    rules = [uf.Rule("block", "com", "/p"), uf.Rule("allow", "com", "/p")]
    found = uf.judge(pages(spark, urls), outcomes, rules)
    got = Counter((r.id, r.host[:9], r.path[:2], r.rule, r.verdict, r.n, r.bad) for r in found.collect())
    # The two rows of page 4 have two labels each; the page of id 1 has one, also as the page without a URL.
    assert got == Counter(
        [
            (1, "", "", None, "allow", 1, 1),
            (2, "", "", None, "allow", 1, 1),
            (1, "a.com", "/x", None, "allow", 5, 1),
            (None, "a.com", "/x", None, "allow", 5, 1),
            (3, "a.a.a.a.a", "/p", "com/p", "allow", 0, 0),
            (4, "a.com", "/x", None, "allow", 5, 1),
            (4, "a.com", "/x", None, "allow", 5, 1),
        ]
    )
    assert uf.judge(pages(spark, []), outcomes, rules).count() == 0
    assert uf.judge(pages(spark, urls), outcomes.where("false")).where("verdict = 'allow'").count() == len(urls)
