import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from txnmill.llm.queries import LISTED_RULES, op11_url_filter
from txnmill.llm.url_rules import RuleIndex, host_tokens, judged, labelled_by_list, mine_rules, url_tokens

SMALL = "/root/testdata/sf0.01"
ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.Net/en/x", "http://example.net", "http://example.net/",
    "https://a.b.example.net/EN/", "http://notexample.net/en/", "http://example.network/", "x?u=http://example.com/de/",
    "http://example.com/de", "http://example.com/de/#a?b", "http://example.com?/de/", "http://example.com#/de/", "http://org/fr/",
    "http://example.com:80/de/", "http://ÄÖ.net/ß?q=1&q=2&=3&r#", "http://a.net/1/22/x9.html?a=b=c&&d", "http://x.net/\n?y\n=1", "http://o.org/fr/" + "y/" * 5000,
]


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(url, rules):
    host, path = parts(url)
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def mined_by_hand(baskets, least, min_confidence, left_out, max_share):
    """Every combination of tokens of every address."""
    n = len(baskets)
    count, with_label, single = Counter(), Counter(), Counter()
    for tokens, _ in baskets:
        single.update(tokens)
    for tokens, label in baskets:
        usable = sorted(t for t in tokens if single[t] <= max_share * n and t not in left_out)
        for size in range(1, len(usable) + 1):
            for some in combinations(usable, size):
                count[some] += 1
                with_label[some, label] += 1
    rules = {
        key: c / count[key[0]]
        for key, c in with_label.items()
        if c >= least * n - 1e-9 and c / count[key[0]] >= min_confidence
    }
    return {
        (frozenset(some), label): (confidence, with_label[some, label] / n)
        for (some, label), confidence in rules.items()
        if all(
            rules.get((less, label), 0) < confidence
            for size in range(1, len(some))
            for less in combinations(some, size)
        )
    }


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SMALL}/pages.parquet")


@pytest.mark.parametrize("share", [0.9, 0.3])
def test_rules_equal_to_counting_all_combinations(spark, pages, share):
    labelled = labelled_by_list(pages, LISTED_RULES)
    left_out = host_tokens(LISTED_RULES)
    index = mine_rules(labelled, least_urls=4, min_confidence=0.7, max_share=share, left_out=left_out)
    baskets = labelled.distinct().select(url_tokens(F.col("url")), "label").collect()
    least = max(0.005, 4 / len(baskets))
    want = mined_by_hand([(list(t), b) for t, b in baskets], least, 0.7, left_out, share)
    assert {(r[0], r[1]): (pytest.approx(r[2]), pytest.approx(r[3])) for r in index.rules} == want
    assert len(want) > 5


def test_index_finds_the_best_rule():
    rules = [(["a"], "x", 0.8, 0.5), (["a", "b"], "y", 0.9, 0.2), (["b", "c"], "x", 0.9, 0.3), (["a", "b", "c"], "x", 0.85, 0.1)]
    index = RuleIndex(rules, {"a": 9, "b": 5, "c": 1})
    assert (frozenset("abc"), "x", 0.85, 0.1) not in index.rules
    by_hand = lambda there: next((i for i, r in enumerate(index.rules) if r[0] <= there), None)
    for size in range(5):
        for there in combinations("abcd", size):
            assert index.best(there) == by_hand(set(there))


def test_a_gap_in_the_confident_rules_hides_no_smaller_rule():
    kept = RuleIndex([(["a"], "x", 0.95, 0.5), (["a", "b", "c"], "x", 0.9, 0.2)], {}).rules
    assert kept == [(frozenset("a"), "x", 0.95, 0.5)]


def test_odd_addresses(spark):
    rows = [*enumerate(ODD_URLS), (None, "http://a.net/x"), (5, ODD_URLS[5]), (5, ODD_URLS[5])]
    more = [(i, url, "h", "p", "v") for i, url in rows]
    frame = spark.createDataFrame(more, "page_id long, url string, host string, path string, rule string")
    rules = mine_rules(labelled_by_list(frame, LISTED_RULES), least_urls=1)
    got = [tuple(r)[:4] for r in judged(frame, LISTED_RULES, rules).collect()]
    assert sorted(got, key=str) == sorted([(i, *parts(u), listed(u, LISTED_RULES)[0]) for i, u in rows], key=str)
    for r in judged(frame, LISTED_RULES, rules).filter("rule is not null").collect():
        assert r["verdict"] == {h + p: v for v, h, p in LISTED_RULES}[r["rule"]] and r["because"] is None
    none = judged(frame, LISTED_RULES).filter("host = ''").collect()
    assert none and all(r["verdict"] == "allow" for r in none)
    assert judged(frame.limit(0), LISTED_RULES, rules).collect() == []
    assert mine_rules(labelled_by_list(frame.limit(0), LISTED_RULES)).rules == []


def test_the_bound_on_rows_and_rules(spark, pages):
    labelled = labelled_by_list(pages, LISTED_RULES)
    some = mine_rules(labelled, fit_rows=60, least_urls=2)
    again = mine_rules(labelled.repartition(7), fit_rows=60, least_urls=2)
    assert some.rules == again.rules and some.rules
    assert len(mine_rules(labelled, least_urls=2, max_rules=3).rules) <= 3


def test_query(spark, pages):
    got = op11_url_filter(spark, SMALL)
    rows = {r["page_id"]: r for r in got.collect()}
    assert len(rows) == pages.count()
    for r in pages.select("page_id", "url").collect():
        rule, verdict = listed(r["url"], LISTED_RULES)
        row = rows[r["page_id"]]
        assert (row["host"], row["path"], row["rule"]) == (*parts(r["url"]), rule)
        assert row["verdict"] == (verdict or row["verdict"]) and row["verdict"] in ("allow", "block")
    assert any(r["because"] and r["verdict"] == "block" for r in rows.values())
