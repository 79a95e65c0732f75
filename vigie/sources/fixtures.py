"""Fixture views: the application tables of the studied workload, derived from the driver tables.

Each view is one portable SQL text that runs unchanged in Spark SQL and in DuckDB, so a Spark query and its DuckDB
oracle read identical inputs (see FIXTURES.md). Spark resolves them against temp views registered per scale-factor
folder; the oracle inlines them as CTEs over the driver's pre-registered views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from vigie.sources.tables import TABLES, register_tables

FIXTURE_SQL: dict[str, str] = {
    "fx_det_tagged": """
select l_orderkey*10 + l_linenumber as id, cast(l_discount*10 as double) as score,
 case when l_linestatus = 'O' then 'construction en dur' when l_returnflag = 'R' then 'piscine' else 'caravane' end as object_type,
 l_suppkey % 16 as geozone_id, 2015 + 3*cast(l_orderkey % 4 as int) as batch_year,
 case when l_partkey % 97 = 0 then null else concat('P', cast(l_partkey % 500 as string)) end as id_parcellaire
from lineitem""",
    "fx_detection": """
with s as (select *, cast(floor(event_id/4) as bigint) as g, event_id % 4 as k from events),
p as (select *, case when g % 3 = 0 then g*4 else event_id end as site from s)
select event_id as id, event_id as detection_data_id, event_id as detection_object_id,
 2015 + 3*cast(k as int) as batch_year,
 case event_type when 'view' then 'construction en dur' when 'click' then 'piscine' when 'error' then 'container' when 'signup' then 'mobil home' else 'autre' end as object_type,
 cast((event_id*37) % 100 as double)/100 as score, 1 + cast(event_id % 3 as int) as tile_set_id,
 (site*7919) % 997 + k*(g % 4) as minx, (site*6151) % 1009 as miny,
 (site*7919) % 997 + k*(g % 4) + 6 as maxx, (site*6151) % 1009 + 6 as maxy
from p""",
    "fx_commune": """
select n_nationkey as geozone_id, n_name as name, n_regionkey as epci_id,
 (n_nationkey % 5)*200 as minx, cast(floor(n_nationkey/5) as int)*200 as miny,
 (n_nationkey % 5)*200+200 as maxx, cast(floor(n_nationkey/5) as int)*200+200 as maxy
from nation""",
    "fx_risk": """
select * from (values (351,'L',0,0,600,600,300,300,600,600),(352,'O',500,500,1000,1000,650,650,850,850),
 (361,'O',100,650,450,1000,200,750,300,850))
 t(zone_id,shape,minx,miny,maxx,maxy,hx0,hy0,hx1,hy1)""",
    "fx_parcel": """
with c as (select c_custkey, c_custkey % 1600 as k from customer)
select c_custkey as id, case when c_custkey % 50 = 7 then null else concat('P', cast(c_custkey % 1400 as string)) end as id_parcellaire,
 cast(floor((k % 40)*25/200) as bigint) + 5*cast(floor(floor(k/40)*25/200) as bigint) as commune_id,
 (k % 40)*25 as minx, cast(floor(k/40) as bigint)*25 as miny, (k % 40)*25+25 as maxx, cast(floor(k/40) as bigint)*25+25 as maxy
from c""",
    "fx_detdata": """
select event_id as id,
 case event_id % 4 when 0 then 'SUSPECT' when 1 then 'LEGITIMATE' when 2 then 'INVALIDATED' else 'DETECTED_NOT_VERIFIED' end as detection_validation_status,
 case event_id % 5 when 0 then 'CONTROLLED_FIELD' when 1 then 'PRIOR_LETTER_SENT' else 'NOT_CONTROLLED' end as detection_control_status,
 case event_id % 3 when 0 then 'PRESCRIBED' when 1 then 'NOT_PRESCRIBED' else null end as detection_prescription_status,
 user_id % 20 as user_last_update_id
from events
union all select -1 - event_id, 'SUSPECT', 'NOT_CONTROLLED', null, null from events where event_id % 100 = 0""",
    "fx_object": """
select event_id as id, user_id % 5 as object_type_id, case when event_id % 11 = 0 then null else event_id % 700 end as parcel_id, user_id % 25 as commune_id from events
union all select -1 - event_id, 0, null, 0 from events where event_id % 100 = 0""",
    "fx_history": """
select event_id as history_id, cast(floor(event_id/11) as bigint) as id, ts as history_date, user_id % 20 as history_user_id,
 case when event_id % 7 = 0 then '+' else '~' end as history_type,
 case event_id % 4 when 0 then 'SUSPECT' when 1 then 'LEGITIMATE' when 2 then 'INVALIDATED' else 'DETECTED_NOT_VERIFIED' end as detection_validation_status,
 case when event_id % 6 = 0 then 'CONTROLLED_FIELD' else 'NOT_CONTROLLED' end as detection_control_status,
 case when event_id % 14 = 0 then null else 'NOT_PRESCRIBED' end as detection_prescription_status,
 case when event_id % 7 = 0 or event_id % 13 = 0 then null else concat('[{"field":"detection_validation_status","old_value":"',
  case when event_id % 2 = 0 then 'DETECTED_NOT_VERIFIED' else 'SUSPECT' end, '","new_value":"x"}',
  case when event_id % 3 = 0 then ',{"field":"detection_control_status","old_value":null,"new_value":"y"}' else '' end,
  case when event_id % 5 = 0 then ',{"field":"comment","old_value":"a","new_value":"b"}' else '' end, ']') end as changed_fields
from events""",
    "fx_hist_det": """
select cast(floor(event_id/8) as bigint)*10 + event_id % 3 as id, cast(floor(event_id/8) as bigint) as detection_data_id, cast((event_id*37) % 100 as double)/100 as score,
 18 + event_id % 2 as tile_set_id, case event_id % 3 when 0 then true when 1 then false else null end as auto_prescribed,
 event_id as version_id, cast(floor(event_id/8) as bigint) as detection_object_id,
 (event_id*7919) % 997 as minx, (event_id*6151) % 1009 as miny, (event_id*7919) % 997 + 6 as maxx, (event_id*6151) % 1009 + 6 as maxy
from events""",
    "fx_hist_object": """
select cast(floor(event_id/16) as bigint) as id, event_id as object_version, case when event_id % 4 = 0 then null else event_id % 300 end as parcel_id
from events where event_id % 8 in (1, 4)""",
    # the study territory of the review analysis (one box, like the two risk shapes)
    "fx_study": """
select * from (values (900, 0, 0, 900, 900)) t(zone_id, minx, miny, maxx, maxy)""",
    # risk zones and reported id per commune: its own three zones, some missing
    "fx_risk_config": """
select n_nationkey as geozone_id, 1000 + n_nationkey as stats_geozone_id, case when n_nationkey % 3 = 0 then null else 351 end as ze_zone_id,
 case when n_nationkey % 2 = 0 then 352 else null end as zr_zone_id, cast(null as int) as zan_zone_id from nation""",
    "fx_det_meta": """
select event_id as id, case when event_id % 6 = 0 then 'INTERFACE_DRAWN' else 'ANALYSIS' end as detection_source,
 ts as created_at, ts as updated_at from events""",
    "fx_user": """
select c_custkey as id, concat('user', cast(c_custkey as string), '@example.org') as email, concat('group', cast(c_custkey % 3 as string)) as group_name
from customer where c_custkey % 20 < 15""",
    "fx_case_log": """
select event_id as id, user_id as dossier_id, concat('V', cast(user_id % 5 as string)) as ville, ts as action_date,
 case event_type when 'view' then 'Ouverture dossier' when 'click' then 'CREATION COURRIER' when 'error' then 'Création décisions de justice ' when 'signup' then 'Clôture dossier autres raisons' else 'inconnu' end as action_type
from events""",
    "fx_pv": """
select o_orderkey as id, concat('N_', cast(o_custkey % 25 as string)) as commune,
 case when o_orderkey % 40 = 0 then null else cast(o_custkey % 25 as string) end as code_insee,
 case when o_orderkey % 3 = 0 then concat(cast(day(o_orderdate) as string),'/',cast(month(o_orderdate) as string),'/',substr(cast(year(o_orderdate) as string),3,2))
  when o_orderkey % 17 = 0 then 'sans date'
  else concat(cast(year(o_orderdate) as string),'-',cast(month(o_orderdate) as string),'-',cast(day(o_orderdate) as string),' 00:00:00') end as date_raw,
 case o_orderstatus when 'F' then 'PV dressé' else 'autre' end as status
from orders""",
    "fx_legacy_detection": """
select o_orderkey as id, o_custkey % 5 as type_id, case when o_orderkey % 3 = 0 then null else o_orderkey % 5 end as validation,
 o_orderkey % 9 = 0 as dessine_interface, case when o_orderkey % 8 = 0 then null else cast(o_orderkey % 100 as double)/100 end as score,
 case when o_orderkey % 10 = 0 then null else o_orderkey % 2 = 0 end as vrai_legitime, o_orderkey % 4 < 2 as vrai_positif, o_orderkey % 7 = 0 as faux_positif,
 o_orderkey % 6 = 0 as signale_terrain, o_orderkey % 8 as control_status_id, o_orderkey % 5 = 0 as prescrit_manuel, o_custkey % 100 as tile_id,
 (o_orderkey*7919) % 997 as minx, (o_orderkey*6151) % 1009 as miny, (o_orderkey*7919) % 997 + 6 as maxx, (o_orderkey*6151) % 1009 + 6 as maxy
from orders""",
    "fx_tile": """
select s_suppkey as id, s_suppkey % 32 as x, cast(floor(s_suppkey/32) as bigint) as y, 1 + s_suppkey % 9 as dataset_id from supplier""",
    "fx_type": """
select * from (values (0,'Piscine'),(1,'Mobil-home'),(2,'Caravane'),(3,'Construction en dur'),(4,'Container')) t(id,name_n)""",
    "fx_parcel_raw": """
select p_partkey as rid, lpad(cast(p_size as string), 4, '0') as numero, '34' as code_dep, lpad(cast(p_partkey % 30 as string), 3, '0') as code_com,
 case when p_partkey % 9 = 0 then null else p_size*10 end as contenance, concat('IDU', cast(p_partkey as string)) as idu, p_brand as section,
 p_partkey % 1000 as minx, cast(floor(p_partkey / 1000) as bigint) as miny, p_partkey % 1000 + 1 as maxx, cast(floor(p_partkey / 1000) as bigint) + 1 as maxy
from part""",
    "fx_group_zone": """
select concat('group', cast(s_suppkey % 20 as string)) as name, case when s_suppkey % 4 = 0 then 'ADMIN' else 'COLLECTIVITY' end as user_group_type,
 case when s_suppkey % 17 = 0 then null else s_nationkey end as geozone_id, case when s_nationkey % 8 = 7 then null else s_nationkey % 8 end as dep_geozone_id
from supplier""",
    # --- views added beyond FIXTURES.md (same portability rule) ---
    # zone registry (core_geozone): communes by nation, departments by region, names normalized in lower case
    "fx_zone": """
select n_nationkey as id, n_name as name, lower(n_name) as name_normalized, 'COMMUNE' as zone_type from nation
union all select 100 + r_regionkey, r_name, lower(r_name), 'DEPARTMENT' from region""",
    # department child table (core_geodepartment): insee code '3' + region key
    "fx_department": """
select 100 + r_regionkey as geozone_ptr_id, concat('3', cast(r_regionkey as string)) as insee_code, r_name as name from region""",
    # commune child table (core_geocommune) for parcel/department rollups and the PV name join
    "fx_commune_ref": """
select n_nationkey as geozone_ptr_id, n_name as name, concat('n ', cast(n_nationkey as string)) as name_normalized,
 concat('34', lpad(cast(n_nationkey as string), 3, '0')) as iso_code, 100 + n_regionkey as department_id, n_regionkey as epci_id from nation""",
    # stats_mapping_preprod_geozone_id: commune id → department name and code
    "fx_mapping": """
select n_nationkey as id, lower(r_name) as department_name, concat('34', lpad(cast(n_nationkey as string), 3, '0')) as geozone_code
from nation join region on n_regionkey = r_regionkey""",
}

_TABLE_RE = re.compile(r"\b(from|join)\s+(" + "|".join(TABLES) + r")\b", re.IGNORECASE)


def _spark_text(sql: str, prefix: str) -> str:
    return _TABLE_RE.sub(lambda m: f"{m.group(1)} {prefix}{m.group(2)}", sql)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture view ``name`` as a Spark DataFrame over the tables of ``sf_dir``."""
    prefix = register_tables(spark, sf_dir)
    return spark.sql(_spark_text(FIXTURE_SQL[name], prefix))


class Fixtures:
    """Lazy accessor: ``Fixtures(spark, sf_dir).fx_detection``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._prefix = register_tables(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            if name not in self._cache:
                self._cache[name] = self.spark.sql(_spark_text(FIXTURE_SQL[name], self._prefix))
            return self._cache[name]
        raise AttributeError(name)


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture CTEs it reads (DuckDB side)."""
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n].strip()})" for n in names)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"

FIXTURE_SQL.update({
    # custom-zone links of detection objects (orphan objects included)
    "fx_zone_link": """
select event_id as detectionobject_id, 351 + event_id % 2 as geocustomzone_id from events where event_id % 3 <> 1
union all select -1 - event_id, 351 from events where event_id % 100 = 0""",
    # detections with a batch label (for purges)
    "fx_det_batch": """
select event_id as id, concat('sia_', cast(2015 + 3 * (event_id % 4) as string)) as batch_id, event_id as detection_data_id,
 event_id as detection_object_id from events""",
})

FIXTURE_SQL.update({
    # tileset ↔ zone links: tileset 1 covers commune rows 0–2, tileset 2 rows 2–4 (tileset 3 has no zone)
    "fx_tileset_zone": """
select 1 as tileset_id, n_nationkey as geozone_id from nation where n_nationkey < 15
union all select 2, n_nationkey from nation where n_nationkey >= 10""",
    # score thresholds of reviewable detections: per commune for tileset 1, one for every commune of tileset 2
    "fx_threshold": """
select 1 as tile_set_id, iso_code, case department_id % 3 when 0 then 0.21 when 1 then 0.35 else 0.42 end as min_score from (
 select concat('34', lpad(cast(n_nationkey as string), 3, '0')) as iso_code, 100 + n_regionkey as department_id from nation) t
union all select 2, null, 0.21""",
})

FIXTURE_SQL.update({
    # source communes of a reference-data refresh: codes 34000–34039 (25 known, the rest new), accented names
    "fx_commune_src": """
select distinct concat('34', lpad(cast(s_suppkey % 40 as string), 3, '0')) as insee_com,
 concat('Saint-Étienne-d''Œuf ', cast(s_suppkey % 40 as string)) as nom, concat('3', cast((s_suppkey % 40) % 5 as string)) as insee_dep,
 ((s_suppkey % 40) % 8) * 100 as minx, cast(floor((s_suppkey % 40) / 8) as int) * 100 as miny,
 ((s_suppkey % 40) % 8) * 100 + 100 as maxx, cast(floor((s_suppkey % 40) / 8) as int) * 100 + 100 as maxy
from supplier""",
    # custom zones and a staging table of new custom geometries (duplicate staging names: smallest staging id wins)
    "fx_custom_zone": """
select s_suppkey as id, s_name as name, case when s_suppkey % 3 = 0 then 'CUSTOM' else 'COMMUNE' end as zone_type,
 s_nationkey as minx, 0 as miny, s_nationkey + 1 as maxx, 1 as maxy from supplier""",
    "fx_custom_staging": """
select p_partkey as sid, concat('Supplier#', lpad(cast(1 + p_partkey % 120 as string), 9, '0')) as name,
 p_size as minx, 0 as miny, p_size + 2 as maxx, 2 as maxy from part""",
    # departments and overseas territories for the web-map features (codes 97x for the last five communes)
    "fx_map_zone": """
select n_nationkey as id, n_name as name, lower(n_name) as name_normalized,
 case when n_nationkey >= 20 then concat('97', cast(n_nationkey - 19 as string)) else lpad(cast(n_nationkey as string), 2, '0') end as insee_code,
 (n_nationkey % 5) * 2.0 as minx, 40 + cast(floor(n_nationkey / 5) as int) * 2.0 as miny,
 (n_nationkey % 5) * 2.0 + 2 as maxx, 40 + cast(floor(n_nationkey / 5) as int) * 2.0 + 2 as maxy from nation""",
})

FIXTURE_SQL.update({
    # source layers of a custom zone: small boxes on a grid of integers that grows with the table; overlaps, shared parts of
    # edges, boxes without area, an unknown projection and files without one
    "fx_layer_box": """
select p_partkey as id, concat('layer_', cast(p_partkey % 7 as string)) as file,
 case when p_partkey % 7 = 3 then 3857 else 4326 end as srid,
 cast((p_partkey * 7) % (20 + 3 * floor(p_partkey / 10)) as int) as minx, cast((p_partkey * 13) % 60 as int) as miny,
 cast((p_partkey * 7) % (20 + 3 * floor(p_partkey / 10)) as int) + case when p_partkey % 11 = 0 then 0 else 1 + cast(p_partkey % 4 as int) end as maxx,
 cast((p_partkey * 13) % 60 as int) + 1 + cast(p_partkey % 3 as int) as maxy
from part""",
})

FIXTURE_SQL.update({
    # source departments of a reference-data refresh: codes 30–39 (five known, the rest new), on the globe
    "fx_department_src": """
select distinct concat('3', cast(s_suppkey % 10 as string)) as insee_dep, concat('Département n°', cast(s_suppkey % 10 as string)) as nom,
 (s_suppkey % 5) * 1.0 as minx, 40.0 + cast(floor((s_suppkey % 10) / 5) as int) as miny,
 (s_suppkey % 5) * 1.0 + 1 as maxx, 41.0 + cast(floor((s_suppkey % 10) / 5) as int) as maxy
from supplier""",
})

FIXTURE_SQL.update({
    # the detections as boxes (shape 0), L-shapes (1) and triangles (2) in the same places
    "fx_shape": f"""
select t.*, cast(id % 3 as int) as shape from ({FIXTURE_SQL["fx_detection"].strip()}) t""",
})

FIXTURE_SQL.update({
    # a case log whose labels are typed in several scripts, with other case, accents and trailing blanks
    "fx_case_scripts": """
select event_id as id, user_id as dossier_id, ts as action_date, cast(null as string) as ville,
 case event_id % 9 when 0 then 'ΑΝΟΙΓΜΑ ΦΑΚΕΛΟΥ' when 1 then 'άνοιγμα φακέλου  ' when 2 then 'ELEMENTS RECUS' when 3 then 'éléments reçus ' when 4 then 'ОТЧЕТ ГОТОВ'
  when 5 then 'отчёт готов' when 6 then 'CLÔTURE   ' when 7 then 'cloture' else 'άλλο' end as action_type
from events""",
})

FIXTURE_SQL.update({
    # zones that grow with the table: one box for each customer on a grid of 100 columns, on the plane (2 x 2) and on the globe
    # (a hundredth of a degree); every 25 x 25 boxes are a group
    "fx_grid_zone": """
select 36000 + c_custkey as id, c_name as name, c_custkey % 100 as col, cast(floor(c_custkey / 100) as bigint) as line,
 cast(floor((c_custkey % 100) / 25) as bigint) + 4 * cast(floor(floor(c_custkey / 100) / 25) as bigint) as group_id,
 (c_custkey % 100) * 0.01 as lon0, 40 + cast(floor(c_custkey / 100) as bigint) % 3000 * 0.01 as lat0 from customer""",
    # source regions of a reference-data refresh: codes 0–8, of which the first three are known
    "fx_region_src": """
select distinct cast(s_nationkey % 9 as string) as code, concat('Région n°', cast(s_nationkey % 9 as string)) as nom,
 (s_nationkey % 9) * 1.0 as minx, 40.0 as miny, (s_nationkey % 9) * 1.0 + 1 as maxx, 41.0 as maxy from supplier""",
})
