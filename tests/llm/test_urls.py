"""URL verdicts: parsing, rules, segmentation and the learned verdict."""

import math
from itertools import product

from assaylake.llm.urls import host_of, path_of, segmented, url_verdicts

URLS = [
    (1, "http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
    (2, "https://b.net", "b.net", "", None, None),
    (3, "https://b.net/", "b.net", "/", "net/", "block"),
    (4, "https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    (5, "https://notexample.com/de/", "notexample.com", "/de/", None, None),
    (6, "ftp://x.org/fr?q", "x.org", "/fr", None, None),
    (7, "//x.org/fr", "", "", None, None),
    (8, None, "", "", None, None),
    (9, "", "", "", None, None),
    (10, "http://?x", "", "", None, None),
    (11, "a://b://c/d", "b:", "//c/d", None, None),
    (12, "http://www.casino-win.example.com/en/1", "www.casino-win.example.com", "/en/1", None, "block"),
    (13, "http://ÄB.org/x\ny?z", "Äb.org", "/x\ny", None, None),
    (14, "http://net/p", "net", "/p", "net/", "block"),
    (14, "http://net/p", "net", "/p", "net/", "block"),
    (None, "http://example.net/en/", "example.net", "/en/", "example.net/en/", "allow"),
]


def pages(spark, rows):
    html = "<p>the casino win the free bets the bets</p><script>casino</script>"
    return spark.createDataFrame([(i, u, html if i != 3 else None, "x") for i, u, *_ in rows], "page_id long, url string, html string, host string")


def test_hosts_paths_and_rules(spark):
    got = url_verdicts(pages(spark, URLS)).collect()
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=repr) == sorted(
        ((i, h, p, rule) for i, _, h, p, rule, _ in URLS), key=repr)
    verdicts = {r["page_id"]: r["verdict"] for r in got}
    assert all(verdicts[i] == v for i, _, _, _, _, v in URLS if v)
    assert all((r["score"] is None) == (r["rule"] is not None) and r["verdict"] in ("block", "allow") for r in got)


def test_no_pages(spark):
    assert url_verdicts(pages(spark, [])).count() == 0


def test_one_class_only_means_allow(spark):
    got = url_verdicts(pages(spark, [(1, "http://b.net/"), (2, "http://c.com/x")])).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow"}


def test_segmentation_is_the_likeliest():
    counts = {"free": 40, "bets": 30, "fre": 2, "ebets": 1, "be": 90, "ts": 3, "e": 5}
    total = float(sum(counts.values()))

    def weight(w):
        return math.log(counts[w] / total) if w in counts else math.log(10 / (total * 10 ** len(w)))

    for word in ("freebets", "betsfree", "xbets", "be", "tsfre"):
        known = {(i, n): float(counts[word[i:i + n]]) for i in range(len(word)) for n in range(1, len(word) - i + 1) if word[i:i + n] in counts}
        best = -math.inf
        for cuts in product([0, 1], repeat=len(word) - 1):
            parts, at = [], 0
            for k, c in enumerate(cuts, 1):
                if c:
                    parts.append(word[at:k])
                    at = k
            parts.append(word[at:])
            best = max(best, sum(map(weight, parts)))
        got = segmented(word, known, total)
        assert "".join(got) == word
        assert math.isclose(sum(map(weight, got)), best)


def test_registered_query(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    got = url_verdicts(table).collect()
    assert len(got) == table.count()
    seeds = [r for r in got if r["rule"] is None and any(w in r["host"] for w in ("casino", "bets", "pills", "spam", "adult"))]
    assert all(r["verdict"] == "block" for r in seeds)


def test_expressions_on_their_own(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("x://Q/a",)], "url string").select(host_of(F.col("url")), path_of(F.col("url"))).first()
    assert tuple(rows) == ("q", "/a")


def test_the_rule_of_org_ends_with_a_slash(spark):
    urls = ["http://x.org/fr/", "http://x.org/fr/a", "http://x.org/fr", "http://x.org/free", "http://x.org/fr2/a", "http://b.net/"]
    got = url_verdicts(pages(spark, list(enumerate(urls)))).collect()
    assert {r["page_id"]: r["rule"] for r in got} == {0: "org/fr/", 1: "org/fr/", 2: None, 3: None, 4: None, 5: "net/"}
    assert all((r["score"] is None) == (r["rule"] is not None) for r in got)
