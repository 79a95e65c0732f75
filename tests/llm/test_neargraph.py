import tracemalloc

import numpy as np
import pandas as pd
import pytest

from vigie.llm import neargraph


def families(seed, n_families, most, dim=24, labels=3, noise=0.12):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_families):
        centre = rng.standard_normal(dim)
        label = int(rng.integers(labels))
        for _ in range(int(rng.integers(1, most + 1))):
            v = centre + noise * np.linalg.norm(centre) / np.sqrt(dim) * rng.standard_normal(dim)
            out.append((len(out) * 13 % 10007, [float(x) for x in v], label))
    return out


def brute(rows, threshold=0.93):
    """(id, links, component) by all pairs; unusable vectors link with nothing."""
    big = 2**63 - 1
    usable = {}
    for i, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            usable.setdefault(big if i is None else i, []).append((np.array(v, float) / np.abs(v).max(), label))
    ids = sorted(usable)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = dict.fromkeys(ids, 0)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (v, lv), (w, lw) = usable[a][0], usable[b][0]
            if lv == lw and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    out = []
    for i, *_ in rows:
        k = big if i is None else i
        c = find(k) if k in root else k
        out.append((i, links.get(k, 0), None if c == big else c, c == k))
    return sorted(out, key=str)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_edges(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1),
        (8, [float("inf"), 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.1], 1), (13, [-1.0, 0.0], 1), (None, [1.0, 0.05], 1),
        (1, [1.0, 0.0], 1), (14, [1e-30, 0.0], 1), (15, [3e38, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as shard", "1 as n_rows", "'y' as vec")
    got = neargraph.near_duplicates(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert neargraph.near_duplicates(df.limit(0)).count() == 0
    assert neargraph.near_duplicates(df.where("vec_id = 5")).collect()[0][1:] == (0, 5, True)


@pytest.mark.parametrize("limits", [{}, {"shard_nodes": 40, "limit": 1024}, {"shard_nodes": 60, "limit": 25}])
def test_recall_and_precision(spark, limits):
    rows = families(1, 60, 8) + [(20000 + i, v, 1) for i, (_, v, _) in enumerate(families(2, 1, 300) * 1)]
    rows = list({r[0]: r for r in rows}.values())
    rows = [(i, np.array(v, np.float32).astype(float).tolist(), label) for i, v, label in rows]
    got = {r["vec_id"]: r for r in neargraph.near_duplicates(spark.createDataFrame(rows, SCHEMA), **limits).collect()}
    want = brute(rows)
    assert all(got[i]["n_links"] <= n for i, n, *_ in want)
    assert sum(got[i]["n_links"] for i, *_ in want) >= 0.9 * sum(n for _, n, *_ in want)
    same = sum(got[i]["component_id"] == c for i, _, c, _ in want)
    assert same >= 0.9 * len(want)


def test_search_reaches_everything_near():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 16))
    x[300:] = x[0] + 0.05 * rng.standard_normal((300, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = neargraph.build(x)
    found = set()
    for a, b in neargraph.search(x, links, 0.93):
        found |= set(zip(a.tolist(), b.tolist()))
    sim = x @ x.T
    want = {(i, j) for i in range(600) for j in np.flatnonzero(sim[i] >= 0.93).tolist() if i != j}
    assert found <= want
    assert len(found) >= 0.98 * len(want)


def test_query_recall(spark):
    from vigie.llm.queries import op9

    sf = "/root/testdata/sf0.01"
    got = {r["vec_id"]: r["n_links"] for r in op9.query(spark, sf).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert len(got) == len(rows)
    assert sum(min(got[i], n) for i, n, *_ in want) >= 0.9 * sum(n for _, n, *_ in want)
    assert all(got[i] <= n for i, n, *_ in want)


def test_near_copies_stay_bounded():
    """A tile of near copies: every link, hubs pruned, and an executor's worth of memory to spare."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal(64) + 0.02 * rng.standard_normal((2048, 64))
    group = pd.DataFrame({"vec_id": np.arange(2048), "n_rows": 1, "block": 0, "shard": "s", "lo": 0, "hi": 0, "shards": [["s"]] * 2048})
    group["vec"] = [v.tobytes() for v in x / np.linalg.norm(x, axis=1)[:, None]]
    tracemalloc.start()
    group["near"] = neargraph._build_tile(group)["near"]
    found = neargraph._search_tile(0.93)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    assert (found[found["other"] < 0]["links"] == 2047).all()
    assert (found["other"] >= 0).sum() == 2047
    assert np.median([len(own) for own in group["near"]]) <= neargraph.HUB


def test_forest_spans_components():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal(16) + 0.05 * rng.standard_normal((n, 16)) for n in (40, 7, 1, 90, 2)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x)) * 3
    group = pd.DataFrame({"vec_id": ids, "n_rows": 1, "block": 0, "shard": "s", "lo": 0, "hi": 0, "shards": [["s"]] * len(x), "vec": [v.tobytes() for v in x]})
    group["near"] = neargraph._build_tile(group)["near"]
    found = neargraph._search_tile(0.93)(group)
    tree = found[found["other"] >= 0]
    assert len(tree) == len(x) - 5
    size = np.repeat([40, 7, 1, 90, 2], [40, 7, 1, 90, 2])
    part = np.repeat(np.arange(5), [40, 7, 1, 90, 2])
    assert (part[tree["vec_id"] // 3] == part[tree["other"] // 3]).all()
    assert (found[found["other"] < 0]["links"].to_numpy() == size - 1).all()


def test_missed_recall_is_not_silent(spark, monkeypatch):
    rows = list({r[0]: r for r in families(6, 12, 20)}.values())
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(neargraph, "MAX_OVERLAP", 1)
    got = {r["vec_id"]: r["n_links"] for r in neargraph.near_duplicates(df, shard_nodes=2, overlap=1).collect()}
    want = brute(rows)
    assert sum(got[i] for i, *_ in want) >= 0.95 * sum(n for _, n, *_ in want)
    monkeypatch.setattr(neargraph, "MIN_RECALL", 1.1)
    with pytest.raises(RuntimeError, match="recall"):
        neargraph.near_duplicates(df, shard_nodes=2, overlap=1)
