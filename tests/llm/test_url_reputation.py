"""URL rules on single urls, and reputations against their formula in plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from vitrine.llm import url_reputation as ur

URLS = [
    (1, None, "", "", None),
    (2, "example.org/es/", "", "", None),
    (3, "https://Blog.EXAMPLE.org/es/9?q=/fr/#x", "blog.example.org", "/es/9", "example.org/es/"),
    (4, "http://example.org/en/17.html", "example.org", "/en/17.html", "example.org/en/1"),
    (5, "http://example.org/en/2", "example.org", "/en/2", "org/"),
    (6, "http://example.org", "example.org", "", None),
    (7, "http://badexample.org/es/", "badexample.org", "/es/", "org/"),
    (8, "http://www.example.com/fr/", "www.example.com", "/fr/", "com/fr/"),
    (9, "http://www.example.com/de/5#a?b", "www.example.com", "/de/5", "com/de/"),
    (10, "http://www.example.com/DE/5", "www.example.com", "/DE/5", None),
    (11, "http://?u=http://x.org/", "", "", None),
    (12, "a://b://org/", "b:", "//org/", None),
    (13, "http://exÄmple.org#/es/", "exÄmple.org", "", None),
    (14, "http://two\nlines.org/a\nb?c", "two\nlines.org", "/a\nb", "org/"),
    (14, "http://example.net/de/", "example.net", "/de/", None),
]
VERDICT = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
           "com/de/": "block", None: "allow"}
LABELS = "doc_id long, quality int, toxic int, host string, page_id int"


@pytest.fixture(scope="module")
def odd_pages(spark):
    made = [(i, u, "x", "lang") for i, u, *_ in URLS] + [(None, "http://z.example.net/", None, None)]
    return spark.createDataFrame(made, "page_id long, url string, host string, rule string")


def test_parts_and_rules(spark, odd_pages):
    labels = spark.createDataFrame([], LABELS)
    got = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in ur.judge(odd_pages, labels).collect())
    want = [(i, h, p, r, VERDICT[r]) for i, _, h, p, r in URLS] + [(0, "z.example.net", "/", None, "allow")]
    assert got == sorted(want)


def test_odd_labels(spark, odd_pages):
    labels = spark.createDataFrame([(None, 0, 1, "a", 1), (10, None, None, "a", 1), (10, 1, None, "a", 1), (99, 0, 0, "b", 2),
                                    (14, 1, 0, None, 3), (14, 0, None, None, 3)], LABELS)
    got = ur.judge(odd_pages, labels)
    assert got.count() == len(URLS) + 1 and got.columns == ["page_id", "host", "path", "rule", "verdict", "lower"]
    empty = odd_pages.limit(0)
    assert ur.judge(empty, labels).collect() == []


def test_domains(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"),
             "u:p@x.shop.co.uk:80": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "10.1.2.3": ("10.1.2.3",) * 2,
             "10.1.2.3:8080": ("10.1.2.3",) * 2, "": ("", ""), "[::1]": ("[::1]",) * 2}
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain = ur.registered_domain(ur.bare_host(F.col("host")))
    got = {r.host: (r.d, r.s) for r in rows.select("host", domain.alias("d"), ur.suffix_of(domain).alias("s")).collect()}
    assert got == hosts


def plain(counts, limit=0.5, sigmas=1.645):
    """Rates of hosts {(host, domain, suffix): (n, x)}."""
    def worth(units):
        spread = sum((x - n * m) ** 2 - n * m * (1 - m) for n, x, m in units)
        pairs = sum(n * (n - 1) * m * (1 - m) for n, x, m in units)
        return 1 / max(1 / 1001, min(1 / 1.5, spread / pairs)) - 1 if pairs > 0 else 2.0

    def level(depth):
        out = {}
        for key, (n, x) in counts.items():
            a, b = out.get(key[depth:], (0, 0))
            out[key[depth:]] = (a + n, b + x)
        return out

    total = [sum(v[i] for v in counts.values()) for i in (0, 1)]
    prior = {(): (total[1] + 1) / (total[0] + 2)}
    for depth in (2, 1, 0):
        units = level(depth)
        w = worth([(n, x, prior[k[1:]]) for k, (n, x) in units.items()])
        prior |= {k: (x + w * prior[k[1:]]) / (n + w) for k, (n, x) in units.items()}
    return {k[0]: (prior[k], prior[k] - sigmas * math.sqrt(prior[k] * (1 - prior[k]) / (n + w + 1)) > limit)
            for k, (n, _) in counts.items()}


def test_reputations(spark):
    """A bad domain, one bad host of a good domain, a bad page on a good host, and hosts without labels."""
    counts = {(f"h{i}.bad.com", "bad.com", "com"): (10 + i, 9 + i) for i in range(8)}
    counts |= {(f"h{i}.good.com", "good.com", "com"): (10 + i % 8, i % 2) for i in range(40)}
    counts |= {("rotten.good.com", "good.com", "com"): (40, 39), ("new.bad.com", "bad.com", "com"): (0, 0),
               ("new.good.com", "good.com", "com"): (0, 0), ("one.good.com", "good.com", "com"): (1, 1),
               ("new.net", "new.net", "net"): (0, 0)}
    told = spark.createDataFrame([(k[0], int(i < x)) for k, (n, x) in counts.items() for i in range(n)], "host string, bad int")
    hosts = spark.createDataFrame([(k[0],) for k in counts], "host string")
    got = {r.host: (r.bad_rate, r.blocked) for r in ur.host_reputations(hosts, told).collect()}
    want = plain(counts)
    assert set(got) == set(want)
    for host, (rate, blocked) in want.items():
        assert got[host] == (pytest.approx(rate, rel=1e-9), blocked), host
    assert got["rotten.good.com"][1] and got["h3.bad.com"][1]
    assert not got["one.good.com"][1] and not got["new.net"][1] and not got["h3.good.com"][1]
    assert got["new.bad.com"][0] > got["new.net"][0] > got["new.good.com"][0]
