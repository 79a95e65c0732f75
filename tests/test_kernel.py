"""Polygon kernel: hand values, closed forms and properties (seeded random)."""

import numpy as np
import pytest

from vigie.functions import kernel as K


def box(a, b, c, d):
    return [K.box_ring(a, b, c, d)]


L_SHAPE = [np.array([(0, 0), (600, 0), (600, 300), (300, 300), (300, 600), (0, 600)], float)]
HOLED = [K.box_ring(500, 500, 1000, 1000), K.box_ring(650, 650, 850, 850)[::-1].copy()]


def box_overlap(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def test_areas():
    assert K.area(L_SHAPE) == 270000
    assert K.area(HOLED) == 210000
    assert K.area(box(0, 0, 2, 3)) == 6


def test_overlap_hand_values():
    assert K.overlap_area(box(290, 290, 296, 296), L_SHAPE) == 36
    assert K.overlap_area(box(298, 298, 304, 304), L_SHAPE) == 20
    assert K.overlap_area(box(648, 700, 654, 706), HOLED) == 12
    assert K.overlap_area(box(700, 700, 706, 706), HOLED) == 0


def test_touch_counts_as_intersection():
    assert K.rings_intersect(box(600, 0, 610, 10), L_SHAPE)  # shared edge
    assert K.rings_intersect(box(300, 300, 310, 310), L_SHAPE)  # corner of the notch
    assert not K.rings_intersect(box(301, 301, 310, 310), L_SHAPE)
    assert K.overlap_area(box(600, 0, 610, 10), L_SHAPE) == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_matches_closed_form(seed):
    rng = np.random.default_rng(seed)
    for _ in range(300):
        x0, y0 = rng.integers(-20, 1020, 2)
        w, h = rng.integers(1, 80, 2)
        bb = (x0, y0, x0 + w, y0 + h)
        exp_l = box_overlap(bb, (0, 0, 600, 600)) - box_overlap(bb, (300, 300, 600, 600))
        exp_o = box_overlap(bb, (500, 500, 1000, 1000)) - box_overlap(bb, (650, 650, 850, 850))
        assert K.overlap_area(box(*bb), L_SHAPE) == pytest.approx(exp_l, abs=1e-6)
        assert K.overlap_area(box(*bb), HOLED) == pytest.approx(exp_o, abs=1e-6)


def test_properties_symmetry_translation_rotation():
    rng = np.random.default_rng(7)
    for _ in range(100):
        pts = rng.uniform(0, 100, size=(7, 2))
        ang = np.argsort(np.arctan2(pts[:, 1] - 50, pts[:, 0] - 50))
        star = [pts[ang]]  # simple polygon (star-shaped around the centre)
        b = box(*rng.uniform(0, 60, 2), *rng.uniform(60, 100, 2)) if False else box(20, 30, 70, 90)
        a1 = K.overlap_area(star, b)
        a2 = K.overlap_area(b, star)
        assert a1 == pytest.approx(a2, rel=1e-9, abs=1e-9)
        assert 0 <= a1 <= min(abs(K.area(star)), K.area(b)) + 1e-9
        moved = [r + np.array([1000.5, -333.25]) for r in star]
        bm = [r + np.array([1000.5, -333.25]) for r in b]
        assert K.overlap_area(moved, bm) == pytest.approx(a1, rel=1e-9, abs=1e-7)
        rolled = [np.roll(star[0], 3, axis=0)]
        assert K.overlap_area(rolled, b) == pytest.approx(a1, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("cell", [7.0, 25.0, 64.0, 100.0, 1000.0])
def test_decompose_partitions_area(cell):
    for poly in (L_SHAPE, HOLED):
        pieces = list(K.decompose(poly, cell))
        total = sum(cell * cell if kind == 0 else K.area(clip) for _, _, kind, clip, _ in pieces)
        assert total == pytest.approx(K.area(poly), rel=1e-12)
        keys = [(cx, cy) for cx, cy, *_ in pieces]
        assert len(keys) == len(set(keys))


def test_decompose_keeps_boundary_contact_cells():
    # a zone whose right edge lies on a cell border still emits the neighbour cell (segments only)
    pieces = {(cx, cy): (kind, segs) for cx, cy, kind, _, segs in K.decompose(box(0, 0, 100, 100), 50.0)}
    assert (2, 0) in pieces and pieces[(2, 0)][0] == 2 and len(pieces[(2, 0)][1]) > 0


def test_clip_segments_closed_box():
    s = np.array([[0, 0, 10, 0], [5, -5, 5, 5], [20, 20, 30, 30]], float)
    out = K.clip_segments(s, (0, 0, 10, 10))
    assert len(out) == 2


def test_simplify_keeps_corners():
    ring = np.array([(0, 0), (5, 0.001), (10, 0), (10, 10), (0, 10)], float)
    out = K.simplify_ring(ring, 0.01)
    assert len(out) == 4


def test_orientation_normalization():
    outer_cw = K.box_ring(0, 0, 10, 10)[::-1].copy()
    hole_ccw = K.box_ring(2, 2, 4, 4)
    fixed = K.normalize_orientation([outer_cw, hole_ccw])
    assert K.signed_area(fixed[0]) > 0 and K.signed_area(fixed[1]) < 0
    assert K.area(fixed) == 96
