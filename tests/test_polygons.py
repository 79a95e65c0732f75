"""Features that are no boxes, measured in the JVM, against the numpy kernel; cells that hold much are split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.functions import geo
from vigie.functions import kernel as K
from vigie.operators import spatial
from vigie.plans import cells as C


def star(rng, x, y, size):
    n = int(rng.integers(5, 12))
    angle = (np.arange(n) + 0.9 * rng.random(n)) / n * 2 * np.pi
    r = size * (0.3 + 0.7 * rng.random(n))
    return np.stack([x + r * np.cos(angle), y + r * np.sin(angle)], 1)


def polygons(seed, n, size, spread=40):
    """Stars (some on an integer grid, some with a hole), boxes and triangles."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x, y = rng.random(2) * spread
        kind = i % 5
        if kind == 0:
            out.append([star(rng, x, y, size)])
        elif kind == 1:
            x, y = np.floor([x, y])
            out.append([np.array([(x, y), (x + 4, y), (x + 4, y + 2), (x + 2, y + 2), (x + 2, y + 4), (x, y + 4)])])
        elif kind == 2:
            out.append([K.box_ring(*np.floor([x, y, x + size, y + size]))])
        elif kind == 3:
            out.append([K.box_ring(x, y, x + size, y + size), K.box_ring(x + size / 4, y + size / 4, x + size / 2, y + size / 2)[::-1]])
        else:
            x, y = np.floor([x, y])
            out.append([np.array([(x, y), (x + 5, y + 1), (x + 2, y + 6)])])
    return out


def layer(spark, shapes, first=1):
    rows = [(i, K.from_rings(s)) for i, s in enumerate(shapes, first)]
    return C.materialize(C.as_layer(spark.createDataFrame(rows, f"id long, rings {geo.RINGS_TYPE}"), "id"))


def python_over_pairs(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(x in plan for x in ("MapInPandas", "MapInArrow", "PythonUDF", "FlatMapGroups"))


def test_trapezoids_cover_the_polygon(spark):
    shapes = polygons(1, 60, 7.0)
    for r, shape in zip(layer(spark, shapes).select("id", geo.trapezoids("rings").alias("t")).orderBy("id").collect(), shapes):
        t = np.array([list(x) for x in r["t"]])
        area = ((t[:, 1] - t[:, 0]) * (t[:, 4] + t[:, 5] - t[:, 2] - t[:, 3]) / 2).sum()
        assert area == pytest.approx(abs(K.area(K.normalize_orientation(shape))))


def test_trapezoids_without_area(spark):
    rows = [(1, [[(0.0, 0.0), (4.0, 2.0)]]), (2, [[]]), (3, None), (4, [[(1.0, 5.0), (1.0, 0.0)]]), (5, [])]
    got = {r["id"]: [tuple(t) for t in r["t"]] if r["t"] is not None else None for r in spark.createDataFrame(rows, f"id long, rings {geo.RINGS_TYPE}").select("id", geo.trapezoids("rings").alias("t")).collect()}
    assert set(got[1]) == {(0.0, 4.0, 0.0, 2.0, 0.0, 2.0)} and set(got[4]) == {(1.0, 1.0, 0.0, 0.0, 5.0, 5.0)}
    assert got[2] == [] and got[5] == [] and got[3] is None


@pytest.mark.parametrize("cell", [3.0, 50.0])
def test_feature_pairs_equal_the_kernel(spark, cell):
    P, Q = polygons(2, 50, 6.0), polygons(3, 50, 5.0)
    pairs = C.feature_pairs(layer(spark, P), layer(spark, Q), cell, with_touch=True)
    assert not python_over_pairs(pairs)
    got = {(r["a_id"], r["b_id"]): r["area_ab"] for r in pairs.collect()}
    want = {(i, j): K.overlap_area(p, q) for i, p in enumerate(P, 1) for j, q in enumerate(Q, 1) if K.rings_intersect(p, q)}
    assert set(got) == set(want) and len(want) > 50
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_contact_in_a_point_and_along_a_slanted_side(spark):
    triangle = np.array([(0.0, 0.0), (6.0, 0.0), (0.0, 6.0)])
    others = [np.array([(3.0, 3.0), (5.0, 3.0), (5.0, 5.0)]), np.array([(6.0, 0.0), (8.0, 0.0), (8.0, 2.0)]), np.array([(6.0, 1.0), (1.0, 6.0), (7.0, 7.0)]),
              np.array([(5.0, 1.0), (1.0, 5.0), (7.0, 7.0)]), K.box_ring(2.0, 4.0, 5.0, 7.0), K.box_ring(2.1, 4.1, 5.0, 7.0)]
    got = C.feature_pairs(layer(spark, [[triangle]]), layer(spark, [[o] for o in others]), 4.0, with_touch=True).collect()
    assert {r["b_id"] for r in got} == {1, 2, 4, 5} and all(abs(r["area_ab"]) < 1e-9 for r in got)


def test_zone_measures_equal_the_kernel(spark):
    P, Z = polygons(4, 60, 3.0), polygons(5, 12, 14.0)
    m = C.zone_measures(layer(spark, P), layer(spark, Z), 5.0, with_touch=True)
    got = {(r["fid"], r["zone_id"]): r["area_in"] for r in m.collect()}
    want = {(i, j): K.overlap_area(p, z) for i, p in enumerate(P, 1) for j, z in enumerate(Z, 1) if K.rings_intersect(p, z)}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    tags = {tuple(r) for r in spatial.zone_tag(layer(spark, P), layer(spark, Z), 5.0).collect()}
    assert tags == {(i, j) for (i, j), a in want.items() if a >= abs(K.area(K.normalize_orientation(P[i - 1]))) * (1 - 1e-9)}


def test_union_of_trapezoids():
    rng = np.random.default_rng(6)
    for _ in range(40):
        parts = [[star(rng, *rng.random(2) * 4, 4.0)] for _ in range(int(rng.integers(1, 5)))]
        t = K.union_trapezoids(np.concatenate([K.trapezoids(p, None) for p in parts]))
        area = ((t[:, 1] - t[:, 0]) * (t[:, 4] + t[:, 5] - t[:, 2] - t[:, 3]) / 2).sum()
        assert area == pytest.approx(K.overlap_area_union([K.box_ring(-20, -20, 30, 30)], parts))


def test_outside_bounds_of_polygons_in_overlapping_zones(spark):
    P, Z = polygons(7, 150, 2.0, 30), polygons(8, 14, 14.0, 25)
    sets = spark.createDataFrame([(1 + j % 2, j) for j in range(1, len(Z) + 1)], "tileset_id int, geozone_id long")
    det = layer(spark, P).withColumn("tile_set_id", (F.col("id") % 2 + 1).cast("int"))
    got = {r["id"] for r in spatial.outside_bounds(det, sets, layer(spark, Z), 4.0).collect()}
    want = set()
    for i, p in enumerate(P, 1):
        own = [z for j, z in enumerate(Z, 1) if j % 2 == i % 2]
        if K.overlap_area_union(p, own) < abs(K.area(K.normalize_orientation(p))) * (1 - 1e-9):
            want.add(i)
    assert got == want and 0 < len(want) < len(P)


# ---------------------------------------------------------------- cell tree
def block(spark, dense=3000, wide=400):
    """Boxes of side 1: ``wide`` of them over 1,000 x 1,000, ``dense`` in one block of 20 x 20 whose middle is denser still."""
    rng = np.random.default_rng(9)
    xy = np.concatenate([rng.random((wide, 2)) * 1000, 520 + 20 * rng.random((dense // 2, 2)), 528 + 2 * rng.random((dense - dense // 2, 2))])
    rows = [(i, float(x), float(y), float(x + 1), float(y + 1), i % 4) for i, (x, y) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id long, minx double, miny double, maxx double, maxy double, seq int")
    return C.materialize(C.box_layer(df, "id", keep=("seq",)))


def largest(rows):
    return rows.groupBy("level", "lx", "ly").count().agg(F.max("count")).first()[0]


def test_dense_cells_are_split(spark):
    det = block(spark)
    tree = C.cell_tree([det], 64.0, most=100)
    assert tree.depth >= 5 and tree.n_splits > 4
    plain, split = C.leaves_of(det, 64.0, None), C.leaves_of(det, 64.0, tree)
    assert largest(plain) > 2500
    # the middle holds 1,500 boxes of side 1 in 2 x 2, and leaves end at the boxes' own size
    assert largest(split) < 0.6 * largest(plain) and split.groupBy("level").count().count() > 3
    pairs = lambda x: x.groupBy("level", "lx", "ly").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert pairs(split) < 0.7 * pairs(plain)  # the middle is 1,500 boxes that do overlap


def test_leaves_hold_a_bounded_number_of_small_features(spark):
    rng = np.random.default_rng(10)
    xy = np.concatenate([rng.random((500, 2)) * 1000, 520 + 20 * rng.random((6000, 2))])
    df = spark.createDataFrame([(i, float(x), float(y), float(x) + 0.05, float(y) + 0.05) for i, (x, y) in enumerate(xy)], "id long, minx double, miny double, maxx double, maxy double")
    det = C.materialize(C.box_layer(df, "id"))
    most = 64
    tree = C.cell_tree([det], 64.0, most)
    assert largest(C.leaves_of(det, 64.0, None)) > 5000
    assert largest(C.leaves_of(det, 64.0, tree)) <= 1.5 * most  # those that begin in the leaf, and a few that reach into it


def test_the_tree_changes_no_pair(spark):
    det = block(spark, 1200, 200)
    pairs = lambda tree: {(r["a_id"], r["b_id"]): r["area_ab"] for r in C.feature_pairs(det, det, 64.0, with_touch=True, tree=tree).collect()}
    tree = C.cell_tree([det], 64.0, most=50)
    got, want = pairs(tree), pairs(None)
    assert tree is not None and got == want and len(want) > 10_000
    odd = layer(spark, polygons(11, 300, 3.0, 12))
    tree = C.cell_tree([odd], 32.0, most=20)
    pairs = lambda tree: {(r["a_id"], r["b_id"]): round(r["area_ab"], 9) for r in C.feature_pairs(odd, odd, 32.0, tree=tree).collect()}
    assert tree is not None and pairs(tree) == pairs(None)


def test_operators_on_a_dense_block(spark, monkeypatch):
    det = block(spark, 800, 100)
    want = {(r["id"], r["first_detection"]) for r in spatial.first_detection(det, 64.0, "seq").collect()}
    monkeypatch.setattr(C, "cell_tree", lambda layers, cell, most=20, real=C.cell_tree: real(layers, cell, most))
    assert {(r["id"], r["first_detection"]) for r in spatial.first_detection(det, 64.0, "seq").collect()} == want


def test_no_tree_without_a_dense_cell(spark):
    assert C.cell_tree([block(spark, 10, 100)], 64.0, most=50) is None
    assert C.cell_tree([block(spark, 10, 100).limit(0)], 64.0) is None
