import itertools
import re

from pyspark.sql import functions as F

from vigie.llm import urlrules
from vigie.llm.queries.op4 import RULES

URLS = [
    "https://www.example.com/en/1", "http://example.com/en/2?x=1", "http://a.b.example.com/en/3#t", "http://EXAMPLE.com/EN/4",
    "http://notexample.com/en/5", "https://x.net/es/6", "https://net/fr/7", "http://a.net/de/8", "http://a.com", "http://a.com?q=/x", "ftp://a.com#/",
    "no scheme", "", None, "://", "http:///path", "http://h.org//net/es/", "http://x.net/es/6", "http://x.com/a\nb?c", "a://b://c/d",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    return host, re.match(r"[^?#]*", rest[len(raw) :])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_explicit_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([], "page_id long, label string")
    got = {r["page_id"]: r for r in urlrules.url_filter(pages, labels, RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = parts(u)
        name, verdict = rule(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, name, verdict or "allow"), u


def mined(rows, min_support, min_confidence, min_lift):
    """Association rules by counting every token set; pruned as documented."""
    n = len(rows)
    items = sorted({t for ts, _ in rows for t in ts})
    useful = [t for t in items if min_support <= sum(t in ts for ts, _ in rows) / n <= urlrules.MAX_SUPPORT]
    found = {}
    for k in range(1, len(useful) + 1):
        for own in itertools.combinations(useful, k):
            with_all = [label for ts, label in rows if set(own) <= set(ts)]
            for says in {"allow", "block"}:
                hits = with_all.count(says)
                if not with_all or hits / n < min_support:
                    continue
                confidence = hits / len(with_all)
                lift = confidence / (sum(label == says for _, label in rows) / n)
                if confidence >= min_confidence and lift >= min_lift:
                    found[(own, says)] = confidence
    return {k: v for k, v in found.items() if not any(s != k[0] and set(s) < set(k[0]) and says == k[1] and c >= v for (s, says), c in found.items())}


def test_mining_matches_brute_force(spark):
    import random

    rng = random.Random(6)
    rows = []
    for _ in range(300):
        own = [t for t in ("a", "b", "c", "d", "e") if rng.random() < 0.4] + ["always"]
        bad = {"a", "b"} <= set(own) or "e" in own and rng.random() < 0.9
        rows.append((own, "block" if bad and rng.random() < 0.95 else "allow"))
    got = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.7, 1.1).collect()
    want = mined(rows, 0.05, 0.7, 1.1)
    assert {(tuple(r["antecedent"]), r["verdict"]): round(r["confidence"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert want


def test_mined_rules_decide(spark):
    pages = [(i, f"http://site{i % 7}.org/{'casino' if i % 3 == 0 else 'news'}/{i}") for i in range(210)]
    pages += [(None, "http://s.org/casino/1"), (5000, None), (3, pages[3][1])]
    labels = [(i, "block" if i % 3 == 0 else "allow") for i in range(150)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = urlrules.url_filter(df, spark.createDataFrame(labels, "page_id long, label string"), RULES).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["verdict"] == ("block" if "casino" in r["path"] else "allow")


def test_best_rule_by_brute_force(spark):
    rules = [(1, ["x"], "block", 0.8, 0.2), (2, ["x", "y"], "allow", 0.9, 0.1), (3, ["z"], "allow", 0.8, 0.2), (4, ["x", "z"], "block", 0.95, 0.05)]
    rows = [(i, list(t)) for i, t in enumerate(["x", "xy", "xyz", "z", "y", "", "xz", "zx"])]
    got = urlrules.fired(spark.createDataFrame(rows, "rid long, tokens array<string>"), spark.createDataFrame(rules, "rule_id long, antecedent array<string>, verdict string, confidence double, support double"))
    want = {}
    for i, own in rows:
        hits = [(c, s, v) for _, a, v, c, s in rules if set(a) <= set(own)]
        if hits:
            want[i] = max(hits)[2]
    assert {r["rid"]: r["verdict"] for r in got.collect()} == want


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([(1, "block")], "page_id long, label string")
    assert urlrules.url_filter(pages, labels, RULES).count() == 0
    assert urlrules.with_parts(pages).select(F.count("*")).first()[0] == 0
