"""Named tables: declared, refreshed, replaced by key, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vigie.functions import geo
from vigie.operators import cohort, spatial
from vigie.operators.presence import PresenceStore
from vigie.operators.reload import DetectionStore
from vigie.plans import cells as C
from vigie.plans.materialize import materialize
from vigie.registry import ORACLE, ORACLE_LOADED, ORACLE_PV_COUNTS, PAIR_CELL, _parcel_stats, _pv, _stored_load, register
from vigie.session import ensure_checkpoint_dir
from vigie.sources import analytics, layers
from vigie.sources.fixtures import Fixtures, with_fixtures
from vigie.sources.named import NamedTables


def _tables(spark) -> NamedTables:
    return NamedTables(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigie-tables/{uuid.uuid4().hex}")


@register("T11_refreshed_table", with_fixtures(ORACLE_PV_COUNTS + "select * from stats_pv", "fx_pv", "fx_commune_ref"))
def q_refreshed_table(spark, sf_dir):
    """The declared tables; the report counts are refreshed with a part, then with all, and read back."""
    tables, rows = _tables(spark), _pv(Fixtures(spark, sf_dir))
    analytics.create_output_tables(tables)
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in tables.table("stats_pv_analysis").columns])
    tables.refresh("stats_pv_analysis", rows.where("year < 2022"))
    tables.refresh("stats_pv_analysis", rows)
    return tables.read("stats_pv_analysis")


@register("T15_replace_by_name", with_fixtures("""
select z.name, (z.maxx - z.minx) * (z.maxy - z.miny) * 1.0::double as area, 'old' as origin from fx_custom_zone z
where z.name not in (select name from fx_custom_staging)
union all
select s.name, (s.maxx - s.minx) * (s.maxy - s.miny) * 1.0::double, 'new' from fx_custom_staging s
join (select name, min(sid) as sid from fx_custom_staging group by name) m on m.sid = s.sid""", "fx_custom_zone", "fx_custom_staging"))
def q_replace_by_name(spark, sf_dir):
    """Zones by name, then those of the staging table in their place (the smallest staging id of each name)."""
    fx = Fixtures(spark, sf_dir)
    tables = _tables(spark)
    tables.create("zones", f"name string not null, geometry {geo.RINGS_TYPE}, origin string", key=("name",), unique=True, buckets=16)
    box = geo.box_rings(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy"))).alias("geometry")
    old = fx.fx_custom_zone.dropDuplicates(["name"]).select("name", box, F.lit("old").alias("origin"))
    new = fx.fx_custom_staging.groupBy("name").agg(*[F.min_by(c, "sid").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
    tables.refresh("zones", old)
    tables.replace("zones", new.select("name", box, F.lit("new").alias("origin")))
    out = C.as_layer(tables.read("zones").select(F.xxhash64("name").alias("id"), "geometry", "name", "origin"), "id", "geometry", keep=("name", "origin"))
    return out.select("name", "area", "origin")


@register("T16_declared_table", with_fixtures("""
select cast(t.nb_parcels as int) as nb_parcels, cast(coalesce(z.n, 0) as int) as nb_parcels_in_ze, t.commune_id::int as geozone_id
from (select commune_id, count(id_parcellaire) as nb_parcels from fx_parcel group by commune_id) t
join (select p.commune_id, count(distinct p.id_parcellaire) as n from fx_parcel p join fx_risk r
  on p.minx >= r.minx and p.maxx <= r.maxx and p.miny >= r.miny and p.maxy <= r.maxy
  and not (least(p.maxx, r.hx1) > greatest(p.minx, r.hx0) and least(p.maxy, r.hy1) > greatest(p.miny, r.hy0)) group by p.commune_id) z
on z.commune_id = t.commune_id""", "fx_parcel", "fx_risk"))
def q_declared_table(spark, sf_dir):
    """Parcel counts in a table with a primary key."""
    tables = _tables(spark)
    analytics.create_output_tables(tables)
    stats = _parcel_stats(Fixtures(spark, sf_dir), "commune")
    rows = stats.select(F.col("geozone_id").cast("int").alias("id"), *[F.col(c).cast("int").alias(c) for c in ("geozone_id", "nb_parcels", "nb_parcels_in_ze")])
    tables.refresh("stats_parcels_analysis", rows)
    return tables.read("stats_parcels_analysis").drop("id")


# ---------------------------------------------------------------- C1 with one run replaced
RUN_ZONE, RUN_SEQ, TILE_SIDE = 6, 60, 50.0


@register("C1_replaced_run", with_fixtures(ORACLE_LOADED + """
select id, score, object_type, geozone_id, batch_year, id_parcellaire, first_detection from stats_det""",
                                           "fx_detection", "fx_commune", "fx_risk", "fx_parcel"))
def q_replaced_run(spark, sf_dir):
    """The first run of one territory stored with half of its rows, then replaced by the whole run: as if loaded so at once."""
    fx = Fixtures(spark, sf_dir)
    rows = _stored_load(fx)
    mine = F.col("load_seq") == RUN_SEQ
    half = materialize(rows.where(~mine | (F.col("id") % 2 == 0)))
    flags = spatial.first_detection(spatial.spots_in_order(half), PAIR_CELL, "load_seq").select("id", "load_seq", "first_detection")
    store = DetectionStore(_tables(spark), "stats_detections_analysis", TILE_SIDE, PAIR_CELL)
    store.create()
    store.load(half.join(flags, ["id", "load_seq"]))
    territory = layers.commune_layer(fx.fx_commune).where(F.col("id") == RUN_ZONE)
    store.replace_run(rows.where(mine), RUN_SEQ, territory)
    return store.read().select("id", "score", "object_type", "geozone_id", "batch_year", "id_parcellaire", "first_detection")


# ---------------------------------------------------------------- C3 and C8 from the stored state
def _surveyed(spark, fx: Fixtures):
    """The state after the surveys came in one after the other, the third of them twice."""
    store = PresenceStore(_tables(spark))
    store.create()
    for year in (2015, 2021, 2018, 2021, 2024):
        store.add(fx.fx_det_tagged.where(F.col("batch_year") == year))
    return store.read()


@register("C3_stock_by_year_stored", ORACLE["C3_stock_by_year"])
def q_stock_by_year_stored(spark, sf_dir):
    return cohort.stock_by_year(_surveyed(spark, Fixtures(spark, sf_dir)))


@register("C8_evolution_epci_stored", ORACLE["C8_evolution_epci"])
def q_evolution_epci_stored(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.evolution_epci(_surveyed(spark, fx), fx.fx_zone, _parcel_stats(fx, "epci"))
