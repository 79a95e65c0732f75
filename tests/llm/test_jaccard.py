import random
import re

import numpy as np
import pytest

from vigie.llm import jaccard
from vigie.llm.common import components


def shingle_set(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute(rows, percent=80):
    """(id, set size, component) per row; a null id sorts last."""
    big = 2**63 - 1
    sets = {}
    for i, t in rows:
        sets.setdefault(big if i is None else i, shingle_set(t))
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    back = lambda i: None if i == big else i
    return sorted(((i, len(shingle_set(t)), back(find(big if i is None else i))) for i, t in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(seed, families, most):
    rng = random.Random(seed)
    out = []
    for f in range(families):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, most)):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"new{rng.random()}"
            out.append((len(out) * 7 % 1009 + 10000 * f, " ".join(own)))
    return out


def test_edges(docs, rows, empty):
    rows = [r[:2] for r in rows if not (r[0] is None and r[1] is None)]
    got = jaccard.jaccard_components(docs.where("doc_id is not null or text is not null"))
    assert result(got) == brute(rows)
    assert jaccard.jaccard_components(empty).count() == 0


@pytest.mark.parametrize("tile", [512, 4])
def test_random_families(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE_DOCS", tile)
    rows = near_copies(3, 25, 12) + near_copies(9, 1, 40)[:40]
    rows = list({i: (i, t) for i, t in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(jaccard.jaccard_components(df)) == brute(rows)


def test_threshold_is_exact(spark):
    """Nine of eleven shingles shared is above 80 %, eight of ten is exactly 80 %, seven of nine is below."""
    rows = []
    for k, (common, own) in enumerate([(8, 1), (9, 1), (7, 1)]):
        for side in range(2):
            words = [f"f{k}w{j}" for j in range(common + 4)] + [f"f{k}side{side}{j}" for j in range(own)]
            rows.append((10 * k + side, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()}
    assert got == {0: 0, 1: 0, 10: 10, 11: 10, 20: 20, 21: 21}


def test_bitmaps_bound_from_above():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 500, 60).astype(np.uint64)) for _ in range(30)]
    maps = jaccard._bitmaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            bound = min(len(a) - np.bitwise_count(maps[i] & ~maps[j]).sum(), len(b) - np.bitwise_count(maps[j] & ~maps[i]).sum())
            assert len(np.intersect1d(a, b)) <= bound


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, x) for x in range(201, 260)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
