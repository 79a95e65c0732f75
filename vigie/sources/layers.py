"""Geometry layers built from the fixture views (boxes and the two literal risk shapes) as Column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions import geo
from vigie.plans.cells import as_layer, box_layer

# Cell size of the fixture world (≈1,000 × 1,000 units). Deliberately not a divisor of the 200-unit commune grid or
# the risk-zone corners, so both the rectangle path and the general polygon kernel are exercised.
FIXTURE_CELL = 64.0
# Cell of feature × feature pairs (detections 6 wide, parcels 25 wide): a few feature extents, so a cell holds few
# candidates per feature while a feature spans few cells.
FIXTURE_PAIR_CELL = 24.0


def risk_rings(c=F.col) -> F.Column:
    """Box minus notch: interior notch → outer ring + hole; notch on the top-right corner → one L-shaped ring."""
    outer = F.array(geo.pt(c("minx"), c("miny")), geo.pt(c("maxx"), c("miny")), geo.pt(c("maxx"), c("maxy")), geo.pt(c("minx"), c("maxy")))
    hole_cw = F.array(geo.pt(c("hx0"), c("hy0")), geo.pt(c("hx0"), c("hy1")), geo.pt(c("hx1"), c("hy1")), geo.pt(c("hx1"), c("hy0")))
    ell = F.array(
        geo.pt(c("minx"), c("miny")), geo.pt(c("maxx"), c("miny")), geo.pt(c("maxx"), c("hy0")),
        geo.pt(c("hx0"), c("hy0")), geo.pt(c("hx0"), c("maxy")), geo.pt(c("minx"), c("maxy")),
    )
    corner = (c("hx1") == c("maxx")) & (c("hy1") == c("maxy"))
    return F.when(corner, F.array(ell)).otherwise(F.array(outer, hole_cw))


def risk_layer(fx_risk: DataFrame) -> DataFrame:
    return as_layer(fx_risk.select("zone_id", risk_rings().alias("rings")), "zone_id")


def shape_layer(fx_shape: DataFrame, side: int, half: int, keep=()) -> DataFrame:
    """Boxes, L-shapes (the box without its upper right quarter) and right triangles (corner at the lower left), by ``shape``."""
    x0, y0, x1, y1 = (F.col(c) for c in ("minx", "miny", "maxx", "maxy"))
    xm, ym = x0 + half, y0 + half
    ell = F.array(geo.pt(x0, y0), geo.pt(x1, y0), geo.pt(x1, ym), geo.pt(xm, ym), geo.pt(xm, y1), geo.pt(x0, y1))
    triangle = F.array(geo.pt(x0, y0), geo.pt(x0 + side, y0), geo.pt(x0, y0 + side))
    rings = F.when(F.col("shape") == 0, geo.box_rings(x0, y0, x1, y1)).when(F.col("shape") == 1, F.array(ell)).otherwise(F.array(triangle))
    return as_layer(fx_shape.select("id", rings.alias("rings"), *keep), "id", keep=keep)


def commune_layer(fx_commune: DataFrame) -> DataFrame:
    return box_layer(fx_commune, "geozone_id")


def detection_layer(fx_detection: DataFrame, keep=()) -> DataFrame:
    return box_layer(fx_detection, "id", keep=keep)


def parcel_layer(fx_parcel: DataFrame, keep=("id_parcellaire",)) -> DataFrame:
    return box_layer(fx_parcel, "id", keep=keep)


def zone_layer(fx_commune: DataFrame, fx_risk: DataFrame) -> DataFrame:
    """Communes and risk zones in one layer (ids do not collide)."""
    return commune_layer(fx_commune).unionByName(risk_layer(fx_risk))
