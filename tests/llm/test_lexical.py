import math
import random
from collections import Counter

import numpy as np
import pytest

from vigie.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute(docs, items, k=10):
    own = [(i, Counter(w.decode() for w in lexical.terms((t or "").encode()))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in {w.decode() for w in lexical.terms((text or "").encode())} if t in c)
            if s > 0:
                scored.append((-s, 2**63 - 1 if i is None else i))
        out += [(item, r + 1, None if i == 2**63 - 1 else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **kw):
    out = lexical.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **kw)
    assert out.columns == ["item_id", "_rank", "_doc_id", "_score"]
    return sorted(map(tuple, out.collect()), key=str)


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 120)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(20)]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    docs += [(1000 + i, docs[7][1]) for i in range(200)]  # a third are copies: ties go by id
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    # many blocks of queries and documents
    assert found(spark, docs, items, query_terms=60, block_postings=500) == want


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n!?.-"), (4, "Alpha alpha ALPHA"), (5, "alpha beta"), (5, "alpha beta"), (None, "alpha beta"), (6, "Été été ÉTÉ 日本語 x"), (7, "beta " * 30_000), (8, "a-b_c alpha9")]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "nothing here"), (None, "beta"), (5, "Été 日本語"), (6, "ÉTÉ"), (7, "beta alpha beta"), (8, "a b c 9 alpha9")]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(20)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_extra_columns_with_clashing_names(spark):
    import pyspark.sql.functions as F

    docs, items = corpus(50)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for c in ("query", "score", "doc", "place", "code", "n_docs"):
        d, i = d.withColumn(c, F.lit("x")), i.withColumn(c, F.lit("y"))
    out = lexical.search(d, i, columns=("item_id", "score", "query"))
    assert {r["score"] for r in out.collect()} == {"y"}
    assert sorted(map(tuple, out.select("item_id", "_rank", "_doc_id", "_score").collect()), key=str) == brute(docs, items)


@pytest.mark.parametrize("n", [1, 2, 300])
def test_range_maximum_and_pruning(n):
    rng = np.random.default_rng(n)
    lens = rng.integers(1, 200, n)
    who, code = np.nonzero(rng.random((n, 6)) < 0.6)
    times = rng.integers(1, 9, len(who))
    block = lexical.packed(np.arange(n), lens, who, code, times)
    held = [np.frombuffer(x, t) for x, t in zip(block, (np.int64, np.int64, np.int32, np.int32, np.int32))]
    own = lexical.Impacts(*held, np.arange(6) * 100 + 50, n, int(lens.sum()))
    for c in range(6):
        lo, hi = own.starts[c], own.starts[c + 1]
        for a in range(lo, hi, 7):
            for b in range(a + 1, hi + 1, 5):
                bound, at = own.largest(np.array([[a]]), np.array([[b]]))
                top = own.impact[a:b].max()
                assert bound[0] == top and at[0] in own.place[a:b][own.impact[a:b] == top]
    total = np.bincount(own.place, weights=own.impact, minlength=max(own.n, 1))
    want = sorted((-int(s), int(d)) for s, d in zip(total, own.docs) if s > 0)[:10]
    seen, largest = [0], own.largest
    own.largest = lambda a, b: (seen.__setitem__(0, seen[0] + len(a)), largest(a, b))[1]
    assert own.search(np.arange(6), 10, []) == want
    assert n < 300 or seen[0] < 2 * n
