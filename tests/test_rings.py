"""Ring assembly by list ranking against the one-group version it replaces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_polygons import layer, polygons
from vigie.functions import kernel as K
from vigie.functions import overlay
from vigie.operators import rings, spatial
from vigie.plans import cells as C

EDGES = "group_id long, x1 double, y1 double, x2 double, y2 double"


def edge_rows(shapes):
    return [(g, *map(float, e)) for g, shape in shapes for e in K.edges_of(shape)]


def assembled(spark, rows):
    out = spatial.assemble(spark.createDataFrame(rows, EDGES).repartition(3)).collect()
    return {r["group_id"]: [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in out}


def one_group(rows):
    """Rings of each group by following its sorted edges."""
    found = {}
    for g in {r[0] for r in rows}:
        got = overlay.rings_from_edges(np.array(sorted(r[1:] for r in rows if r[0] == g), float))
        if got:
            found[g] = [[tuple(p) for p in ring] for ring in got]
    return found


def same(a, b):
    turned = lambda ring: min(tuple(ring[k:] + ring[:k]) for k in range(len(ring)))
    key = lambda groups: {g: sorted(turned([(round(float(x), 9), round(float(y), 9)) for x, y in ring]) for ring in rr) for g, rr in groups.items()}
    return key(a) == key(b)


def test_squares_holes_and_touching_corners(spark):
    box = K.box_ring
    shapes = [
        (1, [box(0, 0, 4, 4)]), (2, [box(0, 0, 9, 9), box(2, 2, 5, 5)[::-1]]), (3, [box(0, 0, 2, 2), box(2, 2, 4, 4)]),  # corners that touch
        (4, [box(0, 0, 6, 6), box(2, 2, 3, 3)[::-1], box(3, 3, 4, 4)[::-1]]), (5, [np.array([(0.0, 0.0), (1, 0), (2, 0), (2, 2), (1, 2), (0, 2)])]),  # points on a line
    ]
    rows = edge_rows(shapes)
    got = assembled(spark, rows)
    assert same(got, one_group(rows)) and set(got) == {1, 2, 3, 4, 5}
    assert [len(r) for r in got[3]] == [4, 4] and [len(r) for r in got[5]] == [4]


@pytest.mark.parametrize("cell", [3.0, 9.0])
def test_dissolved_polygons(spark, cell):
    lay = layer(spark, polygons(21, 40, 6.0, 30))
    groups = spark.createDataFrame([(i, i % 3) for i in range(1, 41)], "id long, group_id long")
    boundary = C.materialize(spatial.dissolve(lay, groups, cell))
    rows = [tuple(r) for r in boundary.collect()]
    out = spatial.assemble(boundary).collect()
    got = {r["group_id"]: [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in out}
    assert same(got, one_group(rows))
    area = {r["group_id"]: r["area"] for r in spatial.edge_measures(boundary, "group_id").collect()}
    for g, rr in got.items():
        assert K.area([np.array(x) for x in rr]) == pytest.approx(area[g])


def test_a_long_ring_takes_few_rounds_and_no_group(spark, monkeypatch):
    n = 4000
    t = np.arange(n) / n * 2 * np.pi
    ring = np.stack([100 * np.cos(t), 100 * np.sin(t)], 1)
    rounds = []
    real = rings.materialize
    monkeypatch.setattr(rings, "materialize", lambda df: (rounds.append(df), real(df))[1])
    df = spark.createDataFrame(edge_rows([(7, [ring])]), EDGES).repartition(4)
    vertices = rings.ring_vertices(df)
    got = vertices.orderBy("pos").collect()
    assert len(got) == n and len({r["ring"] for r in got}) == 1
    path = np.array([(r["x"], r["y"]) for r in got])
    assert K.signed_area(path) == pytest.approx(K.signed_area(ring))
    assert np.allclose(np.hypot(*(np.roll(path, -1, 0) - path).T), 2 * 100 * np.sin(np.pi / n))
    assert len(rounds) <= 3 + 14  # edges, links, first state, and log2(4000) + 1 doublings
    for df in rounds:  # rows stay edges: nothing is grouped into Python or collected
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapGroups" not in plan and "collect_list" not in plan


def test_open_chains_and_empty_input(spark):
    rows = edge_rows([(1, [K.box_ring(0, 0, 2, 2)])]) + [(1, 5.0, 5.0, 6.0, 5.0), (1, 6.0, 5.0, 7.0, 6.0), (2, 0.0, 0.0, 1.0, 1.0)]
    assert same(assembled(spark, rows), {1: [[(0, 0), (2, 0), (2, 2), (0, 2)]]})
    assert assembled(spark, []) == {}


def test_ends_that_differ_by_rounding_meet(spark):
    e = 1e-13
    rows = [(1, 0.0, 0.0, 2.0 + e, 0.0), (1, 2.0, 0.0, 2.0, 2.0), (1, 2.0, 2.0 - e, 0.0, 2.0), (1, 0.0, 2.0, -e, 0.0)]
    assert [len(r) for r in assembled(spark, rows)[1]] == [4]


def test_ingested_zone_keeps_its_rings(spark):
    lay = spark.createDataFrame([("a", 4326, K.from_rings([K.box_ring(0, 0, 2, 2)])), ("a", 4326, K.from_rings([K.box_ring(1, 1, 3, 3)]))], f"file string, srid int, rings {C.geo.RINGS_TYPE}")
    zone, bad = spatial.ingest_layer(lay, "z")
    r = zone.collect()[0]
    assert bad.count() == 0 and r["n_rings"] == 1 and len(r["rings"][0]) == 8 and r["area"] == pytest.approx(7)
    assert zone.select(F.size(F.col("rings")[0])).first()[0] == 8
