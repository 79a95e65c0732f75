"""Geometry as Column expressions (JVM-side, whole-stage codegen).

Layer schema: ``rings array<array<struct<x:double,y:double>>>`` (open rings, even-odd rule, outer CCW / holes CW)
plus a stored bbox ``minx, miny, maxx, maxy``. Vertex-wise maps (projections, translation) use the ``transform``
higher-order function; bbox, area and centroid use ``aggregate`` over the flattened vertices, so no Python runs here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def pt(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_rings(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Counter-clockwise rectangle as a one-ring polygon."""
    return F.array(F.array(pt(minx, miny), pt(maxx, miny), pt(maxx, maxy), pt(minx, maxy)))


def bbox_cols(rings: str = "rings", prefix: str = "") -> list[Column]:
    """minx, miny, maxx, maxy of a rings column."""
    flat = F.flatten(F.col(rings))
    return [
        F.array_min(F.transform(flat, lambda p: p["x"])).alias(prefix + "minx"),
        F.array_min(F.transform(flat, lambda p: p["y"])).alias(prefix + "miny"),
        F.array_max(F.transform(flat, lambda p: p["x"])).alias(prefix + "maxx"),
        F.array_max(F.transform(flat, lambda p: p["y"])).alias(prefix + "maxy"),
    ]


def _ring_sum(rings: str, term: str) -> Column:
    """Σ over rings Σ over edges (i → i+1) of ``term`` (an SQL expression in a = r[i], b = r[(i+1) % n])."""
    return F.expr(
        f"""aggregate({rings}, cast(0 as double), (acc, r) -> acc + aggregate(sequence(0, size(r) - 1), cast(0 as double),
            (s, i) -> s + ({term.replace('a.', 'r[i].').replace('b.', 'r[(i + 1) % size(r)].')})))"""
    )


def wkt(rings: str = "rings") -> Column:
    """Well-known text of a one-polygon geometry."""
    point = lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), point), ", "), F.lit(")"))
    return F.concat(F.lit("POLYGON("), F.array_join(F.transform(F.col(rings), ring), ", "), F.lit(")"))


def area(rings: str = "rings") -> Column:
    """Shoelace area of an oriented polygon."""
    return _ring_sum(rings, "a.x * b.y - b.x * a.y") / 2.0


def centroid(rings: str = "rings") -> tuple[Column, Column]:
    """Area-weighted centroid (x, y) of an oriented polygon."""
    a6 = area(rings) * 6.0
    cx = _ring_sum(rings, "(a.x + b.x) * (a.x * b.y - b.x * a.y)") / a6
    cy = _ring_sum(rings, "(a.y + b.y) * (a.x * b.y - b.x * a.y)") / a6
    return cx, cy


def _signed(ring: str) -> str:
    return (f"aggregate(sequence(0, size({ring}) - 1), cast(0 as double), (s, i) -> s + {ring}[i].x * {ring}[(i + 1) % size({ring})].y "
            f"- {ring}[(i + 1) % size({ring})].x * {ring}[i].y)")


def oriented(rings: str = "rings") -> Column:
    """Rings with outer ones counter-clockwise and holes clockwise, whatever the source's convention is.

    A ring is a hole if an odd number of the other rings contains it (judged by most of its vertices, even-odd rule).
    """
    inside = ("aggregate(sequence(0, size({o}) - 1), false, (s, k) -> s != "
              "(({o}[k].y > p.y) != ({o}[(k + 1) % size({o})].y > p.y) AND p.x < ({o}[(k + 1) % size({o})].x - {o}[k].x) * (p.y - {o}[k].y) "
              "/ ({o}[(k + 1) % size({o})].y - {o}[k].y) + {o}[k].x))").format(o="o")
    depth = f"size(filter({rings}, (o, j) -> j <> n AND 2 * size(filter(r, p -> {inside})) > size(r)))"
    return F.expr(
        f"""CASE WHEN {rings} IS NULL THEN NULL
          WHEN size({rings}) = 1 THEN transform({rings}, r -> CASE WHEN size(r) > 0 AND {_signed('r')} < 0 THEN reverse(r) ELSE r END)
          ELSE transform({rings}, (r, n) -> CASE WHEN size(r) > 0 AND ({_signed('r')} < 0) = ({depth} % 2 = 0) THEN reverse(r) ELSE r END) END"""
    )


def is_rect(rings: str = "rings") -> Column:
    """One ring of 4 corners whose edges are all axis-parallel and non-degenerate."""
    return F.expr(
        f"""size({rings}) = 1 and size({rings}[0]) = 4 and
            forall(sequence(0, 3), i -> (({rings}[0][i].x = {rings}[0][(i + 1) % 4].x) != ({rings}[0][i].y = {rings}[0][(i + 1) % 4].y)))"""
    )


TRAPEZOIDS_TYPE = "array<struct<x0:double,x1:double,b0:double,b1:double,t0:double,t1:double>>"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), then)[0]


def trapezoids(rings: str = "rings") -> Column:
    """The polygon as disjoint trapezoids with vertical sides: array of (x0, x1, bottom at x0, at x1, top at x0, at x1).

    Slabs between neighbouring vertex abscissas; in a slab the edges that span it, sorted by height, pair up (even-odd). Rings must
    not cross. A polygon without area gives its segments as flat trapezoids, so contact with it can still be seen.
    """
    none = F.array().cast(TRAPEZOIDS_TYPE)

    def edge(p: Column, q: Column) -> Column:
        lo, hi = F.when(p["x"] <= q["x"], p).otherwise(q), F.when(p["x"] <= q["x"], q).otherwise(p)
        return F.struct(lo["x"].alias("xl"), lo["y"].alias("yl"), hi["x"].alias("xr"), hi["y"].alias("yr"))

    def at(e: Column, x: Column) -> Column:
        inside = e["yl"] + (e["yr"] - e["yl"]) * ((x - e["xl"]) / (e["xr"] - e["xl"]))
        return F.when(e["xl"] == x, e["yl"]).when(e["xr"] == x, e["yr"]).otherwise(inside)

    def paired(lines: Column, x0: Column, x1: Column) -> Column:
        def piece(j: Column) -> Column:
            low, high = lines[j * 2 - 2], lines[j * 2 - 1]
            return F.struct(x0.alias("x0"), x1.alias("x1"), low["y0"].alias("b0"), low["y1"].alias("b1"), high["y0"].alias("t0"), high["y1"].alias("t1"))

        pieces = F.transform(F.sequence(F.lit(1), F.floor(F.size(lines) / 2).cast("int")), piece)
        return F.when(F.size(lines) >= 2, F.filter(pieces, lambda t: (t["b0"] != t["t0"]) | (t["b1"] != t["t1"]))).otherwise(none)

    def slab(es: Column, x0: Column, x1: Column) -> Column:
        span = F.filter(es, lambda e: (e["xl"] <= x0) & (e["xr"] >= x1))
        lines = F.array_sort(F.transform(span, lambda e: F.struct((at(e, x0) + at(e, x1)).alias("mid"), at(e, x0).alias("y0"), at(e, x1).alias("y1"))))
        return _let(lines, lambda one: paired(one, x0, x1))

    def slabs(es: Column) -> Column:
        ends = F.array_sort(F.array_distinct(F.flatten(F.transform(es, lambda e: F.array(e["xl"], e["xr"])))))
        every = lambda xs: F.flatten(F.transform(F.sequence(F.lit(1), F.size(xs) - 1), lambda k: slab(es, xs[k - 1], xs[k])))
        return _let(ends, lambda xs: F.when(F.size(xs) >= 2, every(xs)).otherwise(none))

    def flat(e: Column) -> Column:
        upright = e["xl"] == e["xr"]
        low, high = F.when(upright, F.least(e["yl"], e["yr"])), F.when(upright, F.greatest(e["yl"], e["yr"]))
        sides = (F.coalesce(low, e["yl"]).alias("b0"), F.coalesce(low, e["yr"]).alias("b1"), F.coalesce(high, e["yl"]).alias("t0"), F.coalesce(high, e["yr"]).alias("t1"))
        return F.struct(e["xl"].alias("x0"), e["xr"].alias("x1"), *sides)

    round_trip = lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - 1), lambda i: edge(r[i], r[(i + 1) % F.size(r)]))
    edges = F.flatten(F.transform(F.filter(F.col(rings), lambda r: F.size(r) >= 2), round_trip))
    cut = lambda es: _let(slabs(F.filter(es, lambda e: e["xl"] < e["xr"])), lambda t: F.when(F.size(t) > 0, t).otherwise(F.transform(es, flat)))
    return _let(edges, cut)


def trapezoids_area(pieces: Column) -> Column:
    """Area of what ``trapezoids`` gives."""
    return F.aggregate(pieces, F.lit(0.0), lambda s, t: s + (t["x1"] - t["x0"]) * (t["t0"] - t["b0"] + t["t1"] - t["b1"]) / 2)


def map_vertices(rings: Column, fx, fy) -> Column:
    """Apply ``fx(x, y)``, ``fy(x, y)`` to every vertex."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(fx(p["x"], p["y"]).alias("x"), fy(p["x"], p["y"]).alias("y"))))


def translate(rings: Column, dx: Column, dy: Column) -> Column:
    return map_vertices(rings, lambda x, y: x + dx, lambda x, y: y + dy)


# WGS84 / web-mercator sphere radius (EPSG:3857).
MERCATOR_R = 6378137.0


def to_web_mercator(rings: Column) -> Column:
    """EPSG:4326 → EPSG:3857 (spherical mercator)."""
    k = math.pi / 180.0
    return map_vertices(
        rings,
        lambda x, y: x * F.lit(MERCATOR_R * k),
        lambda x, y: F.lit(MERCATOR_R) * F.ln(F.tan(F.lit(math.pi / 4) + y * F.lit(k / 2))),
    )


# Lambert-93 (EPSG:2154) on GRS80 — conformal conic with standard parallels 44°N and 49°N,
# origin 46.5°N 3°E, false easting 700000 m, false northing 6600000 m.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
L93_LAT1, L93_LAT2, L93_LAT0, L93_LON0 = 49.0, 44.0, 46.5, 3.0
L93_X0, L93_Y0 = 700000.0, 6600000.0


def _lambert_constants():
    e = math.sqrt(GRS80_F * (2 - GRS80_F))
    r = math.radians

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = r(L93_LAT1), r(L93_LAT2), r(L93_LAT0)
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


def lambert93_to_wgs84(rings: Column, iterations: int = 6) -> Column:
    """EPSG:2154 → EPSG:4326 (inverse Lambert conformal conic, fixed-point latitude iteration)."""
    e, n, big_f, rho0 = _lambert_constants()
    lon0 = math.radians(L93_LON0)

    def lon(x, y):
        dx = x - F.lit(L93_X0)
        dy = F.lit(rho0) - (y - F.lit(L93_Y0))
        theta = F.atan2(dx, dy) if n > 0 else F.atan2(-dx, -dy)
        return F.degrees(theta / F.lit(n) + F.lit(lon0))

    def lat(x, y):
        dx = x - F.lit(L93_X0)
        dy = F.lit(rho0) - (y - F.lit(L93_Y0))
        rho = F.sqrt(dx * dx + dy * dy) * F.lit(1.0 if n > 0 else -1.0)
        t = F.pow(rho / F.lit(GRS80_A * big_f), F.lit(1.0 / n))
        phi = F.lit(math.pi / 2) - 2 * F.atan(t)
        for _ in range(iterations):
            es = F.lit(e) * F.sin(phi)
            phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2)))
        return F.degrees(phi)

    return map_vertices(rings, lon, lat)


def tile_x(lon: Column, zoom: int) -> Column:
    """Slippy-map tile column of a longitude."""
    return F.floor((lon + 180) / 360 * F.pow(F.lit(2.0), F.lit(float(zoom)))).cast("long")


def tile_y(lat: Column, zoom: int) -> Column:
    """Slippy-map tile row of a latitude."""
    r = F.radians(lat)
    return F.floor(
        (F.lit(1.0) - F.ln(F.tan(r) + F.lit(1.0) / F.cos(r)) / F.lit(math.pi)) / 2 * F.pow(F.lit(2.0), F.lit(float(zoom)))
    ).cast("long")
