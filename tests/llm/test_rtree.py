import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.llm import rtree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, k=5, n=3, least=50, most=95):
    """Every anchor against every row, in Python's integers."""
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            kept[(i, label, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v))] = None
    out = []
    for i, label, v in kept:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in kept if j != i and len(w) == len(v))
        for s, j, m in [x for x in scored if x[2] == label][:k]:
            hard = [(t, h) for t, h, o in scored if o != label and -least * s <= -100 * t <= -most * s][:n]
            out += [(i, j, r + 1, h, -s, -t) for r, (t, h) in enumerate(hard)]
    return sorted(out)


def found(spark, rows, anchor=5, schema=SCHEMA, **kw):
    out = rtree.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % anchor == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_equals_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + spread * rng.standard_normal(16)], int(rng.integers(4))) for i in range(700)]
    # one vector under many ids: a third of the rows, and ties in all scores
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(350)]
    got = found(spark, rows, tile=128, block=40, sample=300)
    assert got == brute(rows, lambda i: i % 5 == 0) and len(got) > 500


def test_large_components_use_double_precision(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in 1000 * rng.standard_normal(8)], i % 2) for i in range(200)]
    assert found(spark, rows, tile=64) == brute(rows, lambda i: i % 5 == 0)


def test_awkward_rows(spark):
    rows = [
        (5, [1.0, 0.5], 1), (5, [1.0, 0.5], 1), (6, [1.0, 0.5], 1), (7, [1.0, 0.4], 1), (8, [0.9, 0.3], 2), (9, [0.6, 0.5], 3), (9, [0.6, 0.5], 3),
        (11, [0.6, 0.5], 2), (None, [1.0, 0.5], 1), (12, None, 1), (13, [], 2), (14, [1.0, None], 2), (15, [float("nan"), 1.0], 2), (16, [float("inf"), 1.0], 2),
        (17, [1.0, 0.5], None), (18, [1.0, 0.5, 0.1], 1), (20, [0.0, 0.0], 1), (25, [-1.0, 0.0], 4), (30, [0.5, 0.5, 0.5], 2), (31, [0.5, 0.5, 0.5], 2),
        (32, [0.4, 0.4, 0.4], 1),
    ]
    want = brute(rows, lambda i: i % 5 == 0)
    assert found(spark, rows) == want
    assert {r[0] for r in want} >= {5, 30}
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", tile string, pos int")  # extra columns of names used inside
    assert sorted(map(tuple, rtree.hard_negatives(wide, F.col("vec_id") % 5 == 0).collect())) == want


def test_an_id_with_two_vectors_is_not_its_own_partner(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.9, 0.0], 1), (5, [0.8, 0.0], 2), (6, [1.0, 0.0], 1), (7, [0.7, 0.0], 2)]
    assert found(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_out_of_bound_components_take_no_part(spark):
    rows = [(5, [1.0], 1), (6, [1e30], 1), (7, [0.9], 1), (8, [0.7], 2), (9, [5000.0], 2)]
    assert found(spark, rows) == brute([r for r in rows if r[1][0] < 4096], lambda i: i % 5 == 0)


@pytest.mark.parametrize("rows", [[], [(5, [1.0], 1)], [(6, [1.0], 1), (7, [1.0], 2)], [(5, [1.0], 1), (6, [1.0], 2)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == []


def test_boxes_bound_their_rows_and_are_skipped():
    rng = np.random.default_rng(9)
    vec = np.floor(np.repeat(rng.standard_normal((30, 8)) * 200, 64, axis=0) + rng.standard_normal((1920, 8)) * 4)
    tree = rtree.Tree(np.arange(1920), np.zeros(1920, np.int64), vec, leaf=16, fan=4)
    q = vec[::100]
    low, high = tree.bounds(q)
    every = q @ tree.vec.T
    leaf = np.arange(1920) // 16 + tree.first_leaf
    assert (low[:, leaf] <= every).all() and (every <= high[:, leaf]).all()
    opened = []
    best = rtree.Best(len(q), 5)

    def take(who, leaves):
        opened.extend(leaves)
        best.add(who, tree.scores(q[who], leaves), tree.ids[tree.rows[leaves]])

    tree.visit(high, lambda who, box: high[who, box] >= best.score[who, -1], take)
    assert len(opened) < 0.2 * len(q) * 120  # most boxes stay shut
    assert (best.score == -np.sort(-every, axis=1)[:, :5]).all()
