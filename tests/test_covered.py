"""Coverage by one other feature: against brute force, and as a search that ends at the first one found."""

import random

import pytest
from pyspark.sql import functions as F

from vigie.functions import kernel as K
from vigie.operators import spatial
from vigie.plans import cells as C

SHAPES = {
    "box": lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)],
    "ell": lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s / 2), (x + s / 2, y + s / 2), (x + s / 2, y + s), (x, y + s)],
    "triangle": lambda x, y, s: [(x, y), (x + s, y), (x, y + s)],
}


def features(n: int, kinds, seed: int, at: float = 0.0):
    rng = random.Random(seed)
    # a third crowd into one place, so that a cell there is split
    spot = lambda: rng.randrange(0, 12) if rng.random() < 0.3 else rng.randrange(0, 80)
    return [(i, rng.choice((2015, 2018, 2021, 2024)), rng.choice(("p", "q", None)), SHAPES[rng.choice(kinds)](at + spot(), at + spot(), rng.choice((4, 6, 10)))) for i in range(n)]


def as_layer(spark, rows):
    df = spark.createDataFrame([(i, y, p, [[{"x": float(a), "y": float(b)} for a, b in ring]]) for i, y, p, ring in rows],
                               f"id long, year int, parcel string, rings {C.geo.RINGS_TYPE}")
    return C.as_layer(df, "id", keep=("year", "parcel"))


def overlap(p, q):
    return K.overlap_area([K.np.array(p, float)], [K.np.array(q, float)])


def own_area(p):
    return abs(K.signed_area(K.np.array(p, float)))


@pytest.mark.parametrize("kinds, at", [(("box",), 0.0), (("box", "ell", "triangle"), 0.0), (("box", "ell", "triangle"), 6_500_000.0)])
@pytest.mark.parametrize("ratio", [0.5, 0.05])
def test_first_detection_against_brute_force(spark, kinds, at, ratio):
    rows = features(250, kinds, 7, at)
    got = {r["id"]: r["first_detection"] for r in spatial.first_detection(as_layer(spark, rows), 24.0, seq_col="year", ratio=ratio).collect()}
    want = {i: not any(v < y and overlap(p, q) > ratio * own_area(p) * (1 + 1e-12) for _, v, _, q in rows) for i, y, _, p in rows}
    assert got == want


@pytest.mark.parametrize("kinds", [("box",), ("box", "ell", "triangle")])
def test_history_against_brute_force(spark, kinds):
    rows = features(250, kinds, 11)
    det = as_layer(spark, rows).withColumn("object_type", F.lit("piscine")).withColumnsRenamed({"year": "batch_year", "parcel": "id_parcellaire"})
    got = {r["id"]: r["count_histo_6y_detection"] for r in spatial.prescribed_by_history(det, 24.0).collect()}
    want = {i: len({v for _, v, o, q in rows if p is not None and o == p and y - v >= 6 and overlap(s, q) >= 0.5 * own_area(s) * (1 - 1e-12)}) for i, y, p, s in rows}
    assert got == want


def test_search_ends_at_the_first_one(spark):
    """Boxes are paired in a semi join, and each asks in the leaf of its middle only."""
    det = as_layer(spark, features(200, ("box",), 3))
    out = spatial.first_detection(det, 24.0, seq_col="year")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "Join Inner" not in plan.split("Join LeftSemi")[0]
