"""Union of polygons in one cell, and rings from boundary edges (numpy, inside Arrow batches)."""

from __future__ import annotations

import numpy as np

from vigie.functions import kernel as K


#: Pairs of edges compared at once.
AT_ONCE = 250_000


def _split(edges: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges cut at every point where another edge crosses or touches them: (pieces, number of the edge they are from)."""
    p, q = edges[:, :2], edges[:, 2:]
    d = q - p
    length = np.hypot(d[:, 0], d[:, 1])
    long = np.flatnonzero(length > tol)
    out, src = [], []
    step = max(1, AT_ONCE // max(1, len(edges)))
    for at in range(0, len(long), step):
        own = long[at:at + step]
        points, of = _cut(edges[own], length[own], p, q, d, length, tol)
        out.append(points)
        src.append(own[of])
    return (np.vstack(out), np.concatenate(src)) if out else (np.zeros((0, 4)), np.zeros(0, int))


def _cut(own: np.ndarray, own_length: np.ndarray, p, q, d, length, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """The edges ``own`` cut by all edges p -> q."""
    start, r = own[:, :2], own[:, 2:] - own[:, :2]
    rx, ry, n = r[:, 0, None], r[:, 1, None], own_length[:, None]
    slack = tol / n
    cross = rx * d[:, 1] - ry * d[:, 0]
    px, py = p[:, 0] - start[:, 0, None], p[:, 1] - start[:, 1, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (px * d[:, 1] - py * d[:, 0]) / cross
        u = (px * ry - py * rx) / cross
        near = tol / length
        hit = (np.abs(cross) > 1e-9 * n * length) & (t > slack) & (t < 1 - slack) & (u >= -near) & (u <= 1 + near)
    rows, values = [np.repeat(np.arange(len(own)), 2)], [np.tile([0.0, 1.0], len(own))]
    rows.append(np.nonzero(hit)[0])
    values.append(t[hit])
    for ends in (p, q):  # ends of other edges that lie on this one
        ex, ey = ends[:, 0] - start[:, 0, None], ends[:, 1] - start[:, 1, None]
        s = (ex * rx + ey * ry) / n ** 2
        on = (np.abs(ex * ry - ey * rx) / n <= tol) & (s > slack) & (s < 1 - slack)
        rows.append(np.nonzero(on)[0])
        values.append(s[on])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    kept = np.concatenate([[True], (np.diff(row) > 0) | (np.diff(value) > slack[row[1:], 0])])
    row, value = row[kept], value[kept]
    points = start[row] + value[:, None] * r[row]
    first = np.concatenate([[True], np.diff(row) > 0])
    last = np.concatenate([first[1:], [True]])
    points[first], points[last] = own[:, :2], own[:, 2:]
    return np.hstack([points[:-1], points[1:]])[~last[:-1]], row[~last]


def _inside(points: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Which points lie in the rings (even-odd); all points at once."""
    e = K.edges_of(rings)
    x, y = points[:, 0, None], points[:, 1, None]
    spans = (e[:, 1] > y) != (e[:, 3] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    return np.count_nonzero(spans & (at > x), axis=1) % 2 == 1


def union_edges(pieces: list[tuple[list[np.ndarray], np.ndarray]], box: tuple[float, float, float, float]) -> np.ndarray:
    """Directed boundary edges (interior on the left) of the union of ``pieces`` within the cell ``box``.

    A piece is a polygon's part of the closed cell: its clipped rings and its true boundary there. An edge on the cell's
    upper or right border is left to the neighbour. Along an edge both sides are known from the polygons that have a
    boundary just there and those that have none but hold its middle.
    """
    minx, miny, maxx, maxy = box
    size = max(maxx - minx, maxy - miny)
    tol = 1e-9 * size
    owner = np.concatenate([np.full(len(s), i) for i, (_, s) in enumerate(pieces)]) if pieces else np.zeros(0, int)
    if not len(owner):
        return np.zeros((0, 4))
    edges, src = _split(np.vstack([s for _, s in pieces if len(s)]).astype(float), tol)
    owner = owner[src]
    on_far = ((np.abs(edges[:, 0] - maxx) <= tol) & (np.abs(edges[:, 2] - maxx) <= tol)) | ((np.abs(edges[:, 1] - maxy) <= tol) & (np.abs(edges[:, 3] - maxy) <= tol))
    edges, owner = edges[~on_far], owner[~on_far]
    if not len(edges):
        return np.zeros((0, 4))
    a = np.round((edges[:, :2] - (minx, miny)) / (4 * tol)).astype(np.int64)
    b = np.round((edges[:, 2:] - (minx, miny)) / (4 * tol)).astype(np.int64)
    forward = (a[:, 0] < b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] < b[:, 1]))
    key = np.where(forward[:, None], np.hstack([a, b]), np.hstack([b, a]))
    _, first, group = np.unique(key, axis=0, return_index=True, return_inverse=True)
    group = group.reshape(-1)
    n = len(first)
    # along the edge from its lesser end: who has its interior to the left, who to the right
    left, right = np.zeros(n, bool), np.zeros(n, bool)
    has = np.zeros((n, len(pieces)), np.int64)
    np.add.at(has, (group, owner), np.where(forward, 1, -1))
    left, right = (has > 0).any(1), (has < 0).any(1)
    bound = np.zeros((n, len(pieces)), bool)
    bound[group, owner] = True
    start = np.where(forward[first][:, None], edges[first][:, :2], edges[first][:, 2:])
    stop = np.where(forward[first][:, None], edges[first][:, 2:], edges[first][:, :2])
    mid = (start + stop) / 2
    nudge = 1e-7 * size  # off the cell's border, to the side of the cell
    mid = np.clip(mid, (minx + nudge, miny + nudge), (maxx - nudge, maxy - nudge))
    for i, (rings, _) in enumerate(pieces):
        if rings:
            ask = np.flatnonzero(~bound[:, i] & ~(left & right))
            pts = np.vstack(rings)
            ask = ask[np.all((mid[ask] >= pts.min(0)) & (mid[ask] <= pts.max(0)), axis=1)]
            if len(ask):
                ask = ask[_inside(mid[ask], rings)]
                left[ask] = right[ask] = True
    keep = left != right
    out = np.where(left[keep][:, None], np.hstack([start[keep], stop[keep]]), np.hstack([stop[keep], start[keep]]))
    return out


def rings_from_edges(edges: np.ndarray) -> list[np.ndarray]:
    """Closed rings from directed edges (interior on the left); vertices on a straight line are left out.

    Where several edges leave a vertex the sharpest right turn is taken, so rings touch in points but do not cross.
    """
    if not len(edges):
        return []
    scale = max(np.ptp(edges[:, [0, 2]]), np.ptp(edges[:, [1, 3]]), 1e-300)
    key = np.round(edges / (1e-8 * scale)).astype(np.int64)
    leave: dict[tuple[int, int], list[int]] = {}
    for i, (x, y) in enumerate(key[:, :2].tolist()):
        leave.setdefault((x, y), []).append(i)
    angle = np.arctan2(edges[:, 3] - edges[:, 1], edges[:, 2] - edges[:, 0])
    used = np.zeros(len(edges), bool)
    rings = []
    for first in range(len(edges)):
        if used[first]:
            continue
        path, at = [], first
        while not used[at]:
            used[at] = True
            path.append(at)
            ways = [k for k in leave.get(tuple(key[at, 2:].tolist()), []) if not used[k]]
            if not ways:
                break
            back = angle[at] + np.pi
            at = max(ways, key=lambda k: (angle[k] - back) % (2 * np.pi))
        ring = edges[path][:, :2]
        d1, d2 = ring - np.roll(ring, 1, 0), np.roll(ring, -1, 0) - ring
        bend = np.abs(d1[:, 0] * d2[:, 1] - d1[:, 1] * d2[:, 0]) > 1e-9 * np.hypot(*d1.T) * np.hypot(*d2.T)
        if bend.sum() >= 3:
            rings.append(ring[bend])
    return rings
