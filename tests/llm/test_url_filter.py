"""URL rules and vocabulary against plain string tests."""

import random
import re

import pytest

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import judge_urls

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, id string, verdict string"


def brute(url, rules, vocabulary, reject_at=2):
    url = url or ""
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.split("[/?#]", rest)[0].translate(upper)
    path = re.split("[?#]", rest)[0][len(host):]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[2:]
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    weight = sum(w for t, w in vocabulary.items() if re.search(f"(?<!{words}){re.escape(t)}(?!{words})", url.translate(upper)))
    return host, path, None, "block" if weight >= reject_at else "allow"


def judged(spark, urls, rules=URL_RULES, **options):
    df = spark.createDataFrame([(i, u, "h", "x", "x", "x", "x", "x") for i, u in enumerate(urls)], SCHEMA)
    rows = judge_urls(df, rules, **options).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.page_id)]


def test_against_brute_force(spark):
    pick = random.Random(4)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "xexample.com", "example.net", "m.site.net", "net", "com", "free-bets.org", "casino.org",
             "free.org", "essex.org", "ünicode.org", "user@casino.org:80", ""]
    paths = ["", "/", "/en/", "/en", "/es/x", "/fr/1?casino=1", "#casino", "?a=free&b=win", "/free-free-free", "/xcasinox/Ä", "/casinoü", "/Free/BETS", "//en/"]
    urls = [f"{pick.choice(['http', 'HTTPS', ''])}{pick.choice(['://', '://', ':/'])}{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "://", "casino", "a://b://casino.org/c", "http://h/" + "free " * 30_000 + "win", "http://" + "a." * 50_000 + "net/es/", "http://x.net/es/\nfree\nwin"]
    got = judged(spark, urls)
    assert [g[:4] for g in got] == [brute(u, URL_RULES, url_filter.VOCABULARY) for u in urls]


def test_the_longest_rule_wins(spark):
    urls = ["https://example.com/en/1", "https://m.example.com/en/1", "https://www.example.com/en/1", "https://www.example.com/EN/1", "https://x.net/fr/", "https://x.net"]
    assert [g[2:4] for g in judged(spark, urls)] == [("example.com/en/", "block"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow"),
                                                     ("net/fr/", "block"), (None, "allow")]
    # equally long: the longer host
    assert [g[2:4] for g in judged(spark, ["http://a.bc/xyz"], [("bc", "/xy", "block"), ("a.bc", "/", "allow")])] == [("a.bc/", "allow")]


def test_hits_are_counted_and_need_boundaries(spark):
    got = judged(spark, ["http://a.org/free/free", "http://a.org/free/win/win", "http://a.org/casino/casino/free", "http://a.org/freedom/casinos", "http://free.org/éfree"], [])
    assert [g[3:] for g in got] == [("allow", 0, 2, 1), ("block", 0, 3, 2), ("block", 2, 1, 3), ("allow", 0, 0, 0), ("allow", 0, 1, 1)]


def test_empty_and_refused(spark):
    assert judged(spark, []) == []
    assert judged(spark, ["http://casino.org/"], [], vocabulary={}) == [("casino.org", "/", None, "allow", 0, 0, 0)]
    df = spark.createDataFrame([(None, "http://casino.org"), (None, "http://casino.org")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(df, []).collect()] == ["block", "block"]
    with pytest.raises(ValueError, match="lower case"):
        judge_urls(df, [], vocabulary={"Casino": 2})
    with pytest.raises(ValueError, match="more than"):
        judge_urls(df, [], most_rules=3)
