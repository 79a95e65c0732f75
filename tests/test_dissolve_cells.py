"""The parts of polygons in cells and their union: boxes without the general cut, points and edges many at a time."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigie.functions import kernel as K
from vigie.functions import overlay
from vigie.operators import spatial
from vigie.plans import cells as C

BOXES = [(1.0, 1.0, 3.0, 2.0), (0.0, 0.0, 16.0, 16.0), (15.0, -3.0, 40.0, 17.5), (-16.0, 4.0, 16.0, 5.0), (3.25, 2.5, 3.5, 50.0)]


def general(box, cell):
    """The cells of a box by the general cut: (cx, cy) -> (area, boundary length)."""
    out = {}
    for cx, cy, _, clip, segs in K.decompose([K.box_ring(*box)], cell, borders=True):
        segs = np.zeros((0, 4)) if segs is None else segs
        out[cx, cy] = (cell * cell if clip is None else K.area(clip), np.hypot(segs[:, 2] - segs[:, 0], segs[:, 3] - segs[:, 1]).sum())
    return out


@pytest.mark.parametrize("box", BOXES)
def test_box_cells_are_those_of_the_general_cut(box):
    got = {}
    for cx, cy, (x0, y0, x1, y1), segs in spatial._box_cells(*box, 16.0):
        s = np.array(segs, float).reshape(-1, 4)
        got[cx, cy] = ((x1 - x0) * (y1 - y0), np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]).sum())
    want = general(box, 16.0)
    assert set(got) == set(want)
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_boxes_are_cut_without_polygons(monkeypatch):
    monkeypatch.setattr(K, "decompose", lambda *a, **k: pytest.fail("a box was cut as a polygon"))
    pdf = pd.DataFrame([(7, None, *b) for b in BOXES], columns=["group_id", "rings", "minx", "miny", "maxx", "maxy"])
    out = pd.concat(spatial._polygon_batches(16.0)(iter([pdf])))
    assert len(out) > len(BOXES) and out["rings"].isna().all()


def test_union_asks_for_many_points_at_once(monkeypatch):
    monkeypatch.setattr(K, "point_in_rings", lambda *a: pytest.fail("a point was tested alone"))
    rng = random.Random(4)
    boxes = [(x, y, x + rng.randint(1, 4), y + rng.randint(1, 4)) for x, y in ((rng.randint(0, 10), rng.randint(0, 10)) for _ in range(40))]
    pieces = [([K.box_ring(*b)], K.edges_of([K.box_ring(*b)])) for b in boxes]
    e = overlay.union_edges(pieces, (0.0, 0.0, 16.0, 16.0))
    covered = {(x, y) for x0, y0, x1, y1 in boxes for x in range(x0, x1) for y in range(y0, y1)}
    assert (e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]).sum() / 2 == pytest.approx(len(covered))


def test_rings_are_turned_once(spark):
    """A filter on a layer's columns does not repeat the orientation of its rings."""
    df = spark.createDataFrame([(1, [[{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 2.0}, {"x": 2.0, "y": 2.0}, {"x": 2.0, "y": 0.0}]]), (2, None)], f"id long, rings {C.geo.RINGS_TYPE}")
    layer = C.as_layer(df, "id")
    assert [(r["id"], r["area"], r["is_rect"]) for r in layer.orderBy("id").collect()] == [(1, 4.0, True), (2, None, None)]
    plan = layer.where(F.col("is_rect") & (F.col("area") > 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") <= 3  # the three branches of one orientation
