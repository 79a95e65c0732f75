"""Exact planar polygon measures in numpy, evaluated inside Arrow batches on candidate pairs only.

A polygon is a list of rings (each an ``(n, 2)`` float array, open: the first vertex is not repeated) read under the
even-odd rule; ingest orients outer rings counter-clockwise and holes clockwise, so signed shoelace sums give areas.

* ``overlap_area(P, Q)``: slab decomposition. Cut the common x-range at every vertex and at every crossing of a P edge
  with a Q edge; inside a slab no edges cross, so the length of the P∩Q cross-section is linear in x and
  width × (length at mid-slab) is exact.
* ``boundaries_touch(P, Q)``: closed segment–segment intersection over all edge pairs (collinear overlap included).
* ``clip_rings(rings, box)``: Sutherland–Hodgman against an axis-aligned box, ring by ring (valid for even-odd areas;
  it may add zero-width bridge edges on the box border, which carry no area).
* ``clip_segments(segs, box)``: Liang–Barsky, keeping true boundary pieces inside a closed box.
* ``simplify_ring``: Douglas–Peucker.
"""

from __future__ import annotations

import numpy as np

EPS_REL = 1e-9


# ------------------------------------------------------------------ conversions
def to_rings(obj) -> list[np.ndarray]:
    """Arrow/pandas nested list of rings of {x, y} structs → list of (n, 2) arrays (empty rings dropped)."""
    if obj is None:
        return []
    out = []
    for ring in obj:
        if ring is None or len(ring) == 0:
            continue
        if isinstance(ring, np.ndarray) and ring.dtype != object and ring.ndim == 2:
            arr = ring.astype(float)
        else:
            arr = np.array([(p["x"], p["y"]) for p in ring], dtype=float)
        if len(arr) > 1 and arr[0, 0] == arr[-1, 0] and arr[0, 1] == arr[-1, 1]:
            arr = arr[:-1]
        if len(arr) >= 2:
            out.append(arr)
    return out


def from_rings(rings: list[np.ndarray]) -> list[list[dict]]:
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def box_ring(minx, miny, maxx, maxy) -> np.ndarray:
    return np.array([(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy)], dtype=float)


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    """All ring edges as an (m, 4) array x1, y1, x2, y2."""
    if not rings:
        return np.zeros((0, 4))
    parts = [np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings if len(r) >= 2]
    return np.vstack(parts) if parts else np.zeros((0, 4))


def bbox(rings: list[np.ndarray]):
    pts = np.vstack(rings)
    return pts[:, 0].min(), pts[:, 1].min(), pts[:, 0].max(), pts[:, 1].max()


# ------------------------------------------------------------------ areas
def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return 0.5 * float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))


def area(rings: list[np.ndarray]) -> float:
    """Area of an oriented polygon (outer CCW, holes CW)."""
    return float(sum(signed_area(r) for r in rings))


def point_in_rings(px: float, py: float, rings: list[np.ndarray]) -> bool:
    """Even-odd point-in-polygon (boundary points are undefined; callers use interior sample points)."""
    e = edges_of(rings)
    x1, y1, x2, y2 = e[:, 0], e[:, 1], e[:, 2], e[:, 3]
    cross = (y1 > py) != (y2 > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        xi = x1 + (py - y1) * (x2 - x1) / (y2 - y1)
    return bool(np.count_nonzero(cross & (xi > px)) % 2)


def normalize_orientation(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Orient rings by nesting depth: even depth counter-clockwise (outer), odd depth clockwise (hole)."""
    out = []
    for i, r in enumerate(rings):
        a = signed_area(r)
        if a == 0:
            continue
        # interior sample point of ring i: midpoint of its first edge nudged inward is fragile; use a vertex-based
        # probe: test other rings with the ring's first vertex (rings of a valid polygon do not cross).
        px, py = r[0]
        depth = sum(1 for j, o in enumerate(rings) if j != i and point_in_rings(px, py, [o]))
        want_ccw = depth % 2 == 0
        out.append(r if (a > 0) == want_ccw else r[::-1].copy())
    return out


def _cross_section(edges: np.ndarray, xm: np.ndarray) -> np.ndarray:
    """Sorted y of edges spanning each abscissa in ``xm`` → (k, m) array, NaN padded at the end of each row."""
    x1, y1, x2, y2 = edges[:, 0], edges[:, 1], edges[:, 2], edges[:, 3]
    lo, hi = np.minimum(x1, x2), np.maximum(x1, x2)
    span = (lo[None, :] < xm[:, None]) & (xm[:, None] < hi[None, :])
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (xm[:, None] - x1[None, :]) / (x2 - x1)[None, :]
        y = y1[None, :] + t * (y2 - y1)[None, :]
    y = np.where(span, y, np.nan)
    return np.sort(y, axis=1)


def _crossing_xs(ep: np.ndarray, eq: np.ndarray) -> np.ndarray:
    """x of proper crossings between edges of P and edges of Q."""
    if len(ep) == 0 or len(eq) == 0:
        return np.zeros(0)
    p1x, p1y, p2x, p2y = (ep[:, i][:, None] for i in range(4))
    q1x, q1y, q2x, q2y = (eq[:, i][None, :] for i in range(4))
    rx, ry = p2x - p1x, p2y - p1y
    sx, sy = q2x - q1x, q2y - q1y
    den = rx * sy - ry * sx
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((q1x - p1x) * sy - (q1y - p1y) * sx) / den
        u = ((q1x - p1x) * ry - (q1y - p1y) * rx) / den
        ok = (den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        return (p1x + t * rx)[ok]


def overlap_area(P: list[np.ndarray], Q: list[np.ndarray]) -> float:
    """Area of P ∩ Q for even-odd polygons (exact up to float rounding)."""
    if not P or not Q:
        return 0.0
    ep, eq = edges_of(P), edges_of(Q)
    pminx, pmaxx = min(ep[:, 0].min(), ep[:, 2].min()), max(ep[:, 0].max(), ep[:, 2].max())
    qminx, qmaxx = min(eq[:, 0].min(), eq[:, 2].min()), max(eq[:, 0].max(), eq[:, 2].max())
    xlo, xhi = max(pminx, qminx), min(pmaxx, qmaxx)
    if not xhi > xlo:
        return 0.0
    pminy, pmaxy = min(ep[:, 1].min(), ep[:, 3].min()), max(ep[:, 1].max(), ep[:, 3].max())
    qminy, qmaxy = min(eq[:, 1].min(), eq[:, 3].min()), max(eq[:, 1].max(), eq[:, 3].max())
    if not min(pmaxy, qmaxy) > max(pminy, qminy):
        return 0.0
    # local origin keeps products small
    ox, oy = xlo, max(pminy, qminy)
    ep = ep - np.array([ox, oy, ox, oy])
    eq = eq - np.array([ox, oy, ox, oy])
    xhi -= ox
    xs = np.concatenate([ep[:, 0], ep[:, 2], eq[:, 0], eq[:, 2], _crossing_xs(ep, eq), [0.0, xhi]])
    xs = np.unique(xs[(xs >= 0.0) & (xs <= xhi)])
    if len(xs) < 2:
        return 0.0
    xm = 0.5 * (xs[:-1] + xs[1:])
    w = np.diff(xs)
    yp = _cross_section(ep, xm)
    yq = _cross_section(eq, xm)
    a0, a1 = yp[:, 0::2], yp[:, 1::2]
    b0, b1 = yq[:, 0::2], yq[:, 1::2]
    if a1.shape[1] < a0.shape[1]:
        a0 = a0[:, : a1.shape[1]]
    if b1.shape[1] < b0.shape[1]:
        b0 = b0[:, : b1.shape[1]]
    lo = np.maximum(a0[:, :, None], b0[:, None, :])
    hi = np.minimum(a1[:, :, None], b1[:, None, :])
    seg = np.where(np.isnan(lo) | np.isnan(hi), 0.0, np.clip(hi - lo, 0.0, None))
    return float(np.dot(w, seg.sum(axis=(1, 2))))


def boundaries_touch(ep: np.ndarray, eq: np.ndarray) -> bool:
    """True when some edge of ep meets some edge of eq (closed segments, touching and collinear overlap included)."""
    if len(ep) == 0 or len(eq) == 0:
        return False
    p1x, p1y, p2x, p2y = (ep[:, i][:, None] for i in range(4))
    q1x, q1y, q2x, q2y = (eq[:, i][None, :] for i in range(4))
    # bbox reject
    box = (
        (np.minimum(p1x, p2x) <= np.maximum(q1x, q2x)) & (np.minimum(q1x, q2x) <= np.maximum(p1x, p2x))
        & (np.minimum(p1y, p2y) <= np.maximum(q1y, q2y)) & (np.minimum(q1y, q2y) <= np.maximum(p1y, p2y))
    )
    if not box.any():
        return False

    def orient(ax, ay, bx, by, cx, cy):
        return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    d1 = orient(q1x, q1y, q2x, q2y, p1x, p1y)
    d2 = orient(q1x, q1y, q2x, q2y, p2x, p2y)
    d3 = orient(p1x, p1y, p2x, p2y, q1x, q1y)
    d4 = orient(p1x, p1y, p2x, p2y, q2x, q2y)
    general = (d1 * d2 <= 0) & (d3 * d4 <= 0)
    # when all four are zero the segments are collinear: the bbox test decides
    collinear = (d1 == 0) & (d2 == 0) & (d3 == 0) & (d4 == 0)
    hit = box & (general | collinear)
    return bool(hit.any())


def rings_intersect(P: list[np.ndarray], Q: list[np.ndarray]) -> bool:
    """Closed-set intersection of two areal polygons."""
    return boundaries_touch(edges_of(P), edges_of(Q)) or overlap_area(P, Q) > 0.0


# ------------------------------------------------------------------ clipping
def _clip_half(pts: np.ndarray, axis: int, bound: float, keep_ge: bool) -> np.ndarray:
    """Sutherland–Hodgman against one axis-aligned half-plane; vectorized over the ring's edges."""
    if len(pts) == 0:
        return pts
    v = pts[:, axis]
    ins = v >= bound if keep_ge else v <= bound
    if ins.all():
        return pts
    if not ins.any():
        return pts[:0]
    s, e = pts, np.roll(pts, -1, axis=0)
    ins_s, ins_e = ins, np.roll(ins, -1)
    crossing = ins_s != ins_e
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (bound - s[:, axis]) / (e[:, axis] - s[:, axis])
        ip = s + t[:, None] * (e - s)
    ip[:, axis] = bound
    out = np.empty((len(pts), 2, 2))
    out[:, 0] = ip
    out[:, 1] = e
    mask = np.stack([crossing, ins_e], axis=1)
    return out[mask]


def clip_rings(rings: list[np.ndarray], box) -> list[np.ndarray]:
    minx, miny, maxx, maxy = box
    out = []
    for r in rings:
        c = _clip_half(r, 0, minx, True)
        c = _clip_half(c, 0, maxx, False)
        c = _clip_half(c, 1, miny, True)
        c = _clip_half(c, 1, maxy, False)
        if len(c) >= 3 and signed_area(c) != 0.0:
            out.append(c)
    return out


def clip_segments(segs: np.ndarray, box) -> np.ndarray:
    """Liang–Barsky: parts of segments (m, 4) inside the closed box."""
    if len(segs) == 0:
        return segs
    minx, miny, maxx, maxy = box
    x1, y1, x2, y2 = segs[:, 0], segs[:, 1], segs[:, 2], segs[:, 3]
    dx, dy = x2 - x1, y2 - y1
    t0 = np.zeros(len(segs))
    t1 = np.ones(len(segs))
    ok = np.ones(len(segs), dtype=bool)
    for p, q in ((-dx, x1 - minx), (dx, maxx - x1), (-dy, y1 - miny), (dy, maxy - y1)):
        par = p == 0
        ok &= ~(par & (q < 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = q / p
        t0 = np.where(~par & (p < 0), np.maximum(t0, r), t0)
        t1 = np.where(~par & (p > 0), np.minimum(t1, r), t1)
    ok &= t0 <= t1
    out = np.stack([x1 + t0 * dx, y1 + t0 * dy, x1 + t1 * dx, y1 + t1 * dy], axis=1)[ok]
    return out


def is_rect(rings: list[np.ndarray]) -> bool:
    """Single axis-aligned rectangle (4 distinct corners, edges axis-parallel)."""
    if len(rings) != 1 or len(rings[0]) != 4:
        return False
    r = rings[0]
    e = np.roll(r, -1, axis=0) - r
    axis_parallel = np.all((e[:, 0] == 0) ^ (e[:, 1] == 0))
    return bool(axis_parallel) and abs(signed_area(r)) > 0


# ------------------------------------------------------------------ cell decomposition of one zone
def decompose(rings: list[np.ndarray], cell: float, segs: np.ndarray | None = None, borders: bool = False):
    """Yield (cx, cy, kind, clip_rings, segments) for every closed cell the zone touches.

    kind: 0 full cell inside the zone, 1 rectangle piece (clip is one axis-aligned rectangle), 2 general piece.
    Recursive halving of the cell range: a region fully inside the zone emits all its cells as full without further
    clipping; a region the zone does not reach is dropped. ``segs``: the true boundary, when ``rings`` were clipped before
    and have edges that are no boundary. ``borders``: a full cell whose border is part of the boundary comes with those segments.
    """
    if not rings and (segs is None or not len(segs)):
        return
    segs = edges_of(rings) if segs is None else segs
    minx, miny, maxx, maxy = bbox(rings + ([segs[:, :2], segs[:, 2:]] if len(segs) else []))
    i0, i1 = int(np.floor(minx / cell)), int(np.floor(maxx / cell))
    j0, j1 = int(np.floor(miny / cell)), int(np.floor(maxy / cell))
    stack = [(i0, i1, j0, j1, rings, segs)]
    while stack:
        a0, a1, b0, b1, rr, ss = stack.pop()
        box = (a0 * cell, b0 * cell, (a1 + 1) * cell, (b1 + 1) * cell)
        rr = clip_rings(rr, box)
        ss = clip_segments(ss, box)
        ar = area(rr)
        box_area = (box[2] - box[0]) * (box[3] - box[1])
        if ar <= 0.0 and len(ss) == 0:
            continue
        interior_full = ar >= box_area * (1 - EPS_REL) and not _segments_inside_open(ss, box)
        if interior_full and borders and len(ss):
            if a0 == a1 and b0 == b1:
                yield a0, b0, 0, [box_ring(*box)], ss
                continue
        elif interior_full:
            for i in range(a0, a1 + 1):
                for j in range(b0, b1 + 1):
                    yield i, j, 0, None, None
            continue
        if a0 == a1 and b0 == b1:
            kind = 1 if is_rect(rr) else 2
            yield a0, b0, kind, rr, ss
            continue
        if (a1 - a0) >= (b1 - b0):
            m = (a0 + a1) // 2
            stack.append((a0, m, b0, b1, rr, ss))
            stack.append((m + 1, a1, b0, b1, rr, ss))
        else:
            m = (b0 + b1) // 2
            stack.append((a0, a1, b0, m, rr, ss))
            stack.append((a0, a1, m + 1, b1, rr, ss))


def trapezoids(rings: list[np.ndarray], segs: np.ndarray) -> np.ndarray:
    """The polygon as disjoint trapezoids with vertical sides, rows (x0, x1, bottom at x0, at x1, top at x0, at x1).

    Slabs between neighbouring vertex abscissas; in a slab the edges that span it, sorted by height, pair up even-odd. A
    polygon without area gives its segments as flat trapezoids, so contact with it can still be seen.
    """
    if not rings:
        v = segs[:, 0] == segs[:, 2]
        a, b = segs[:, :2], segs[:, 2:]
        swap = (a[:, 0] > b[:, 0])[:, None]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        lo, hi = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
        return np.stack([a[:, 0], b[:, 0], np.where(v, lo, a[:, 1]), np.where(v, lo, b[:, 1]), np.where(v, hi, a[:, 1]), np.where(v, hi, b[:, 1])], 1)
    e = edges_of(rings)
    e = e[e[:, 0] != e[:, 2]]
    flip = e[:, 0] > e[:, 2]
    e[flip] = e[flip][:, [2, 3, 0, 1]]
    xs = np.unique(np.concatenate([e[:, 0], e[:, 2], _crossing_xs(e, e)]))
    out = []
    for x0, x1 in zip(xs[:-1], xs[1:]):
        own = e[(e[:, 0] <= x0) & (e[:, 2] >= x1)]
        slope = (own[:, 3] - own[:, 1]) / (own[:, 2] - own[:, 0])
        y0 = np.where(own[:, 0] == x0, own[:, 1], own[:, 1] + slope * (x0 - own[:, 0]))
        y1 = np.where(own[:, 2] == x1, own[:, 3], own[:, 1] + slope * (x1 - own[:, 0]))
        order = np.argsort(y0 + y1, kind="stable")
        y0, y1 = y0[order], y1[order]
        for k in range(0, len(own) - 1, 2):
            if y0[k] != y0[k + 1] or y1[k] != y1[k + 1]:
                out.append((x0, x1, y0[k], y1[k], y0[k + 1], y1[k + 1]))
    return np.array(out, float).reshape(-1, 6)


def union_trapezoids(t: np.ndarray) -> np.ndarray:
    """Disjoint trapezoids of the union of trapezoids (rows as in ``trapezoids``).

    Slabs between all ends and all crossings of sides; in a slab nothing crosses, so the pieces that span it are merged by
    their heights in its middle.
    """
    t = t[t[:, 1] > t[:, 0]]
    lines = np.concatenate([t[:, [0, 2, 1, 3]], t[:, [0, 4, 1, 5]]])
    xs = np.unique(np.concatenate([t[:, 0], t[:, 1], _crossing_xs(lines, lines)]))
    out = []
    for x0, x1 in zip(xs[:-1], xs[1:]):
        own = t[(t[:, 0] <= x0) & (t[:, 1] >= x1)]
        width = own[:, 1] - own[:, 0]
        at = lambda lo, hi, x: own[:, lo] + (own[:, hi] - own[:, lo]) * ((x - own[:, 0]) / width)  # noqa: E731, B023
        b0, b1, t0, t1 = at(2, 3, x0), at(2, 3, x1), at(4, 5, x0), at(4, 5, x1)
        held: list[list[float]] = []
        for k in np.argsort(b0 + b1, kind="stable"):
            if held and b0[k] + b1[k] <= held[-1][2] + held[-1][3]:
                if t0[k] + t1[k] > held[-1][2] + held[-1][3]:
                    held[-1][2:] = [t0[k], t1[k]]
            else:
                held.append([b0[k], b1[k], t0[k], t1[k]])
        out += [(x0, x1, *h) for h in held if h[2] + h[3] > h[0] + h[1]]
    return np.array(out, float).reshape(-1, 6)


def trapezoid_ring(t) -> np.ndarray:
    """Corners of a trapezoid row, counter-clockwise."""
    x0, x1, b0, b1, t0, t1 = t
    return np.array([(x0, b0), (x1, b1), (x1, t1), (x0, t0)], float)


def _segments_inside_open(ss: np.ndarray, box) -> bool:
    """Whether some boundary piece reaches the open interior of the box (then the region is not simply full)."""
    if len(ss) == 0:
        return False
    minx, miny, maxx, maxy = box
    on_border = (
        ((ss[:, 0] == minx) & (ss[:, 2] == minx)) | ((ss[:, 0] == maxx) & (ss[:, 2] == maxx))
        | ((ss[:, 1] == miny) & (ss[:, 3] == miny)) | ((ss[:, 1] == maxy) & (ss[:, 3] == maxy))
    )
    return bool((~on_border).any())


# ------------------------------------------------------------------ simplification
def simplify_ring(ring: np.ndarray, tol: float) -> np.ndarray:
    """Douglas–Peucker on a closed ring (keeps at least 4 points when the input has them)."""
    if len(ring) <= 4 or tol <= 0:
        return ring
    closed = np.vstack([ring, ring[:1]])
    keep = np.zeros(len(closed), dtype=bool)
    keep[0] = keep[-1] = True
    stack = [(0, len(closed) - 1)]
    while stack:
        s, e = stack.pop()
        if e <= s + 1:
            continue
        a, b = closed[s], closed[e]
        seg = closed[s + 1 : e]
        d = b - a
        n = np.hypot(*d)
        if n == 0:
            dist = np.hypot(seg[:, 0] - a[0], seg[:, 1] - a[1])
        else:
            dist = np.abs(d[0] * (seg[:, 1] - a[1]) - d[1] * (seg[:, 0] - a[0])) / n
        k = int(np.argmax(dist))
        if dist[k] > tol:
            idx = s + 1 + k
            keep[idx] = True
            stack.append((s, idx))
            stack.append((idx, e))
    out = closed[keep][:-1]
    return out if len(out) >= 3 else ring


def overlap_area_union(P: list[np.ndarray], Qs: list[list[np.ndarray]]) -> float:
    """Area of P ∩ (Q1 ∪ … ∪ Qk) without building the union: slabs cut at all vertices and all pairwise crossings,
    per slab the union of the Qs' cross-section intervals is intersected with P's."""
    Qs = [q for q in Qs if q]
    if not P or not Qs:
        return 0.0
    ep = edges_of(P)
    eqs = [edges_of(q) for q in Qs]
    allq = np.vstack(eqs)
    ox, oy = ep[:, [0, 2]].min(), ep[:, [1, 3]].min()
    shift = np.array([ox, oy, ox, oy])
    ep = ep - shift
    eqs = [e - shift for e in eqs]
    allq = allq - shift
    xhi = ep[:, [0, 2]].max()
    cuts = [ep[:, 0], ep[:, 2], allq[:, 0], allq[:, 2], _crossing_xs(ep, allq), [0.0, xhi]]
    for i in range(len(eqs)):
        for j in range(i + 1, len(eqs)):
            cuts.append(_crossing_xs(eqs[i], eqs[j]))
    xs = np.concatenate(cuts)
    xs = np.unique(xs[(xs >= 0.0) & (xs <= xhi)])
    if len(xs) < 2:
        return 0.0
    xm = 0.5 * (xs[:-1] + xs[1:])
    w = np.diff(xs)
    yp = _cross_section(ep, xm)
    total = 0.0
    sections = [_cross_section(e, xm) for e in eqs]
    for k in range(len(xm)):
        row = yp[k][~np.isnan(yp[k])]
        p_iv = list(zip(row[0::2], row[1::2]))
        if not p_iv:
            continue
        q_iv = []
        for sec in sections:
            r = sec[k][~np.isnan(sec[k])]
            q_iv.extend(zip(r[0::2], r[1::2]))
        if not q_iv:
            continue
        q_iv.sort()
        merged = []
        for a, b in q_iv:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        length = 0.0
        for a, b in p_iv:
            for c, d in merged:
                length += max(0.0, min(b, d) - max(a, c))
        total += w[k] * length
    return float(total)
