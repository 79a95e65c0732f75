"""Zone operators on zones that grow with the tables, and the entries of S1, S12 and P2 that had none."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigie.functions import geo
from vigie.operators import loads, spatial
from vigie.plans import cells as C
from vigie.plans.materialize import materialize
from vigie.registry import CELL, _within_risk, _with_rings, register
from vigie.sources import layers
from vigie.sources.fixtures import Fixtures, with_fixtures

STEP = 0.01
_GLOBE = f"select *, lon0 + {STEP} as lon1, lat0 + {STEP} as lat1 from fx_grid_zone"
_MERCATOR_Y = "6378137.0 * ln(tan(pi() / 4 + radians({}) / 2))"


def _globe(fx: Fixtures):
    c = F.col
    z = fx.fx_grid_zone.select("id", "name", c("lon0").alias("minx"), c("lat0").alias("miny"), (c("lon0") + STEP).alias("maxx"), (c("lat0") + STEP).alias("maxy"))
    return layers.box_layer(z, "id", keep=("name",))


@register("S1_in_any_zone", with_fixtures(f"""
select d.id from fx_detection d where exists (select 1 from fx_risk r where {_within_risk('d', 'r')})""", "fx_detection", "fx_risk"))
def q_in_any_zone(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return spatial.in_any_zone(layers.detection_layer(fx.fx_detection), layers.risk_layer(fx.fx_risk), CELL)


@register("S4_dissolve_grid", with_fixtures("""
select a.group_id, 4.0 * count(*) as area, 8.0 * count(*) - 4.0 * (count(r.id) + count(u.id)) as perimeter from fx_grid_zone a
left join fx_grid_zone r on r.group_id = a.group_id and r.line = a.line and r.col = a.col + 1
left join fx_grid_zone u on u.group_id = a.group_id and u.col = a.col and u.line = a.line + 1
group by a.group_id""", "fx_grid_zone"))
def q_dissolve_grid(spark, sf_dir):
    """Groups of 25 x 25 boxes united."""
    z = Fixtures(spark, sf_dir).fx_grid_zone
    boxes = z.select("id", *[(F.col(c) * 2 + k).cast("double").alias(n) for c, k, n in (("col", 0, "minx"), ("line", 0, "miny"), ("col", 2, "maxx"), ("line", 2, "maxy"))])
    layer = materialize(layers.box_layer(boxes, "id"))
    m = spatial.edge_measures(spatial.dissolve(layer, z.select("id", "group_id"), 9.0), "group_id")
    return m.select("group_id", F.round("area", 6).alias("area"), F.round("perimeter", 6).alias("perimeter"))


@register("S11_zone_surface_grid", with_fixtures(f"""
select id, round(6378137.0 * radians({STEP}) * ({_MERCATOR_Y.format('lat1')} - {_MERCATOR_Y.format('lat0')}) / 1e6, 6) as surface_km2 from ({_GLOBE}) z""", "fx_grid_zone"))
def q_zone_surface_grid(spark, sf_dir):
    return spatial.zone_surface(_globe(Fixtures(spark, sf_dir))).select("id", F.round("surface_km2", 6).alias("surface_km2"))


@register("S12_epci_centroids", with_fixtures(f"""
select id, name, round((lon0 + lon1) / 2, 9) as lon, round((lat0 + lat1) / 2, 9) as lat from ({_GLOBE}) z
where id in ({', '.join(map(str, spatial.EPCI_CENTROID_IDS))})""", "fx_grid_zone"))
def q_epci_centroids(spark, sf_dir):
    out = spatial.selected_centroids(_globe(Fixtures(spark, sf_dir)))
    return out.select("id", "name", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


@register("S15_tile_cover_grid", with_fixtures(f"""
select id, cast(floor((lon0 + 180) / 360 * pow(2, 12)) as bigint) as min_x_tile, cast(floor((lon1 + 180) / 360 * pow(2, 12)) as bigint) as max_x_tile,
  cast(floor((1 - ln(tan(radians(lat1)) + 1 / cos(radians(lat1))) / pi()) / 2 * pow(2, 12)) as bigint) as min_y_tile,
  cast(floor((1 - ln(tan(radians(lat0)) + 1 / cos(radians(lat0))) / pi()) / 2 * pow(2, 12)) as bigint) as max_y_tile from ({_GLOBE}) z""", "fx_grid_zone"))
def q_tile_cover_grid(spark, sf_dir):
    return spatial.tile_cover(_globe(Fixtures(spark, sf_dir)), zoom=12)


@register("S13_grid_rings", with_fixtures("""
select group_id, 1 as n_rings, cast(4 * count(*) as double) as area from fx_grid_zone group by group_id""", "fx_grid_zone"))
def q_grid_rings(spark, sf_dir):
    """The rings of each united group; a full group is one square, the last one may end in a half line."""
    z = Fixtures(spark, sf_dir).fx_grid_zone
    boxes = z.select("id", *[(F.col(c) * 2 + k).cast("double").alias(n) for c, k, n in (("col", 0, "minx"), ("line", 0, "miny"), ("col", 2, "maxx"), ("line", 2, "maxy"))])
    boundary = materialize(spatial.dissolve(materialize(layers.box_layer(boxes, "id")), z.select("id", "group_id"), 9.0))
    out = C.as_layer(spatial.assemble(boundary), "group_id")
    return out.select(F.col("id").alias("group_id"), F.size("rings").alias("n_rings"), F.round("area", 6).alias("area"))


@register("P2_upsert_regions", with_fixtures(f"""
with ins as (select (select max(id) from fx_zone) + row_number() over (order by code) as id, * from fx_region_src where code not in ('0', '1', '2'))
select cast(id as bigint) as geozone_ptr_id, code, round((6378137.0 * radians(maxx) - 6378137.0 * radians(minx))
  * ({_MERCATOR_Y.format('maxy')} - {_MERCATOR_Y.format('miny')}) / 1e6, 3) as surface_km2 from ins""", "fx_zone", "fx_region_src"))
def q_upsert_regions(spark, sf_dir):
    """New region rows, matched by name, with their surface."""
    fx = Fixtures(spark, sf_dir)
    zones = _with_rings(fx.fx_zone.select(F.col("id").cast("long").alias("id"), "name", "name_normalized", "zone_type", *[F.lit(0.0).alias(c) for c in ("minx", "miny", "maxx", "maxy")]))
    src = fx.fx_region_src.select("code", F.col("nom").alias("name"), F.lit(None).cast("string").alias("parent_code"), *[F.col(c).cast("double").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
    src = src.withColumn("rings", geo.box_rings(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy"))))
    child = spark.createDataFrame([(100, "0"), (101, "1"), (102, "2")], "geozone_ptr_id long, code string")
    _, rows = loads.upsert_collectivities(zones, child, src, "REGION", by="name")
    return rows.select("geozone_ptr_id", "code", F.round("surface_km2", 3).alias("surface_km2"))
