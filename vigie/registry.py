"""Registered queries: one per operator key, each with its DuckDB oracle where SQL can express it.

Every query reads the driver tables of ``sf_dir`` (through the fixture views) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigie.operators import cohort, loads
from vigie.sources.fixtures import Fixtures, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


# ---------------------------------------------------------------- P4 / C2: report log
ORACLE_PV_COUNTS = r"""
with pv_parsed as (
  select case when regexp_matches(date_raw, '^(\d{1,2})/(\d{1,2})/(\d{2})$')
    then '20' || regexp_extract(date_raw, '^(\d{1,2})/(\d{1,2})/(\d{2})$', 3) || '-' || regexp_extract(date_raw, '^(\d{1,2})/(\d{1,2})/(\d{2})$', 2)
         || '-' || regexp_extract(date_raw, '^(\d{1,2})/(\d{1,2})/(\d{2})$', 1) || ' 00:00:00'
    else date_raw end as d, commune, code_insee, status
  from fx_pv),
pv_keyed as (
  select replace(replace(replace(replace(upper(replace(commune, ' ', '-')), '_', '-'), '''', '-'), '-/-', '-'), '’', '-') as k0,
    code_insee, year(try_strptime(d, '%Y-%m-%d %H:%M:%S')) as year, status from pv_parsed),
pv_named as (
  select case k1 when 'VACQUERIE-ET-ST-MARTIN-DE-CASTRIES' then 'LA-VACQUERIE-ET-SAINT-MARTIN-DE-CASTRIES'
    when 'VALRAS' then 'VALRAS-PLAGE' when 'SALVETAT-SUR-AGOUT' then 'LA-SALVETAT-SUR-AGOUT' else k1 end as commune_key, code_insee, year, status
  from (select replace(replace(replace(replace(replace(replace(k0, 'CAP-D-AGDE', 'AGDE'), 'MONS-LA-TRIVALLE', 'MONS'),
    'SAINT-CHRISTOL-ENTRE-VIGNES', 'ENTRE-VIGNES'), 'VERARGUES-ENTRE-VIGNES', 'ENTRE-VIGNES'),
    'SAINT-JEAN-DU-MINERVOIS', 'SAINT-JEAN-DE-MINERVOIS'), 'SAINT-JULIEN-D-ORLARGUES', 'SAINT-JULIEN') as k1, code_insee, year, status from pv_keyed) t),
pv_grouped as (
  select commune_key, code_insee, year, count(*) as nb_pv from pv_named
  where year is not null and status = 'PV dressé' and commune_key is not null and code_insee is not null
  group by commune_key, code_insee, year),
pv_joined as (
  select g.*, c.geozone_ptr_id as geozone_id from pv_grouped g
  left join (select geozone_ptr_id, replace(upper(name_normalized), ' ', '-') as commune_key from fx_commune_ref where department_id = 102) c
  on g.commune_key = c.commune_key),
stats_pv as (
  select cast(54 + row_number() over (order by commune_key, code_insee, year, geozone_id nulls last) as bigint) as id,
    geozone_id, cast(year as integer) as year, cast(nb_pv as bigint) as nb_pv from pv_joined)
"""


def _pv(fx: Fixtures) -> DataFrame:
    return loads.pv_counts(fx.fx_pv, fx.fx_commune_ref, department_id=102, first_id=55)


def _pv_rows(fx: Fixtures) -> DataFrame:
    """The report counts without ids, for the figures that only sum them."""
    return loads.pv_grouped(fx.fx_pv, fx.fx_commune_ref, department_id=102)


@register("P4_pv_counts", with_fixtures(ORACLE_PV_COUNTS + "select * from stats_pv", "fx_pv", "fx_commune_ref"))
def q_pv_counts(spark, sf_dir):
    return _pv(Fixtures(spark, sf_dir))


@register("C2_pv_by_period", with_fixtures(ORACLE_PV_COUNTS + """
select geozone_id, cast(sum(case when year >= 2021 and year <= 2023 then nb_pv else 0 end) as bigint) as nb_pv_period
from stats_pv group by geozone_id""", "fx_pv", "fx_commune_ref"))
def q_pv_by_period(spark, sf_dir):
    return cohort.pv_by_period(_pv_rows(Fixtures(spark, sf_dir)), 2021, 2023)


# ---------------------------------------------------------------- C3–C5, C13: cohort figures on tagged detections
@register("C3_stock_by_year", with_fixtures("""
select geozone_id, batch_year, count(distinct id_parcellaire) as nb_parcels from fx_det_tagged group by geozone_id, batch_year""",
                                            "fx_det_tagged"))
def q_stock_by_year(spark, sf_dir):
    return cohort.stock_by_year(Fixtures(spark, sf_dir).fx_det_tagged)


@register("C3_stock_by_year_epci", with_fixtures("""
select geozone_id, batch_year, count(distinct id_parcellaire) as nb_parcels from fx_det_tagged
where id_parcellaire is not null and batch_year in (2015, 2018, 2021, 2024) group by geozone_id, batch_year""", "fx_det_tagged"))
def q_stock_by_year_epci(spark, sf_dir):
    return cohort.stock_by_year(Fixtures(spark, sf_dir).fx_det_tagged, years=(2015, 2018, 2021, 2024), drop_null=True)


@register("C4_new_parcels", with_fixtures("""
select geozone_id, count(*) as nb_new_parcels from (
  select distinct id_parcellaire, geozone_id from fx_det_tagged where batch_year = 2024 and id_parcellaire is not null
  except
  select distinct id_parcellaire, geozone_id from fx_det_tagged where batch_year in (2021, 2018) and id_parcellaire is not null) t
group by geozone_id""", "fx_det_tagged"))
def q_new_parcels(spark, sf_dir):
    return cohort.new_parcels(Fixtures(spark, sf_dir).fx_det_tagged, 2024, (2021, 2018))


@register("C5_cleared_parcels", with_fixtures("""
select t.geozone_id, count(distinct t.id_parcellaire) as nb_cleared_parcels from fx_det_tagged t
where t.batch_year = 2021 and t.id_parcellaire is not null and not exists (
  select 1 from fx_det_tagged u where u.batch_year = 2024 and u.id_parcellaire = t.id_parcellaire and u.geozone_id = t.geozone_id)
group by t.geozone_id""", "fx_det_tagged"))
def q_cleared_parcels(spark, sf_dir):
    return cohort.cleared_parcels(Fixtures(spark, sf_dir).fx_det_tagged, 2021, 2024)


@register("C13_class_evolution", with_fixtures("""
select batch_year, object_type, count(*) as nb_detections from fx_det_tagged where batch_year in (2018, 2021, 2024)
group by batch_year, object_type""", "fx_det_tagged"))
def q_class_evolution(spark, sf_dir):
    return cohort.class_evolution(Fixtures(spark, sf_dir).fx_det_tagged)


# ---------------------------------------------------------------- spatial: S1, S2, S3, C1, S9
from pyspark.sql import functions as F  # noqa: E402

from vigie.functions import geo as G  # noqa: E402
from vigie.operators import spatial  # noqa: E402
from vigie.plans.materialize import materialize  # noqa: E402
from vigie.sources import layers  # noqa: E402

CELL = layers.FIXTURE_CELL
PAIR_CELL = layers.FIXTURE_PAIR_CELL


def _box_wkt(minx: str, miny: str, maxx: str, maxy: str) -> str:
    """WKT of a box in the oracle, in the vertex order of ``geo.box_rings``."""
    p = lambda x, y: f"cast(cast({x} as double) as varchar) || ' ' || cast(cast({y} as double) as varchar)"
    corners = " || ', ' || ".join(p(*c) for c in ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)))
    return f"'POLYGON((' || {corners} || '))'"


def _with_rings(df: DataFrame) -> DataFrame:
    """A fixture table with its box as rings."""
    return df.withColumn("rings", G.box_rings(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy")))


def _within_box(a: str, b: str) -> str:
    return f"({a}.minx >= {b}.minx and {a}.maxx <= {b}.maxx and {a}.miny >= {b}.miny and {a}.maxy <= {b}.maxy)"


def _within_risk(a: str, r: str) -> str:
    return (f"({_within_box(a, r)} and not (least({a}.maxx, {r}.hx1) > greatest({a}.minx, {r}.hx0) "
            f"and least({a}.maxy, {r}.hy1) > greatest({a}.miny, {r}.hy0)))")


def _meets(a: str, b: str) -> str:
    return f"({a}.minx <= {b}.maxx and {b}.minx <= {a}.maxx and {a}.miny <= {b}.maxy and {b}.miny <= {a}.maxy)"


def _overlap(a: str, b: str) -> str:
    ox = f"(least({a}.maxx, {b}.maxx) - greatest({a}.minx, {b}.minx))"
    oy = f"(least({a}.maxy, {b}.maxy) - greatest({a}.miny, {b}.miny))"
    return f"(case when {ox} > 0 and {oy} > 0 then {ox} * {oy} else 0 end)"


def _area(a: str) -> str:
    return f"(({a}.maxx - {a}.minx) * ({a}.maxy - {a}.miny))"


@register("S1_zone_tag", with_fixtures(f"""
select d.id, cast(z.geozone_id as bigint) as zone_id from fx_detection d join fx_commune z on {_within_box('d', 'z')}
union all
select d.id, cast(r.zone_id as bigint) as zone_id from fx_detection d join fx_risk r on {_within_risk('d', 'r')}""",
                                        "fx_detection", "fx_commune", "fx_risk"))
def q_zone_tag(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return spatial.zone_tag(layers.detection_layer(fx.fx_detection), layers.zone_layer(fx.fx_commune, fx.fx_risk), CELL)


@register("S2_match_parcel", with_fixtures(f"""
select d.id, p2.id_parcellaire from fx_detection d
left join (select d.id, min(p.id) as pid from fx_detection d join fx_parcel p on {_meets('d', 'p')} group by d.id) m on m.id = d.id
left join fx_parcel p2 on p2.id = m.pid""", "fx_detection", "fx_parcel"))
def q_match_parcel(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection)
    return spatial.match_parcel(det, layers.parcel_layer(fx.fx_parcel), PAIR_CELL).select("id", "id_parcellaire")


@register("S3_first_detection", with_fixtures(f"""
select t.id, not exists (select 1 from fx_detection e where e.batch_year < t.batch_year and 2 * {_overlap('t', 'e')} > {_area('t')}) as first_detection
from fx_detection t""", "fx_detection"))
def q_first_detection(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection, keep=("batch_year",))
    return spatial.first_detection(det, PAIR_CELL, seq_col="batch_year").select("id", "first_detection")


def load_configs(fx_commune):
    """One configuration per commune: its four survey batches (batch id = survey year), risk zones 351/352/361."""
    batches = F.array(*[F.struct(F.lit(y).alias("batch_id"), F.lit(y).alias("batch_year"), F.lit(i).alias("idx"))
                        for i, y in enumerate((2015, 2018, 2021, 2024))])
    return fx_commune.select(F.col("geozone_id").cast("long").alias("geozone_id"), F.inline(batches)).select(
        "geozone_id", "batch_id", "batch_year",
        F.lit(351).cast("long").alias("ze_zone_id"), F.lit(352).cast("long").alias("zr_zone_id"), F.lit(361).cast("long").alias("zan_zone_id"),
        (F.col("geozone_id") * 10 + F.col("idx")).alias("load_seq"),
    )


def _load_inputs(fx: Fixtures) -> dict:
    det = fx.fx_detection.withColumnRenamed("batch_year", "batch_id")
    return {
        "inference": layers.detection_layer(det, keep=("score", "object_type", "batch_id")), "parcels": layers.parcel_layer(fx.fx_parcel),
        "zones": layers.zone_layer(fx.fx_commune, fx.fx_risk), "configs": load_configs(fx.fx_commune), "cell": CELL, "pair_cell": PAIR_CELL,
    }


def _loaded(fx: Fixtures):
    return spatial.load_detections(**_load_inputs(fx))


def _stored_load(fx: Fixtures):
    """The loaded table for operators that read it more than once and not its first-detection flag: written once."""
    return materialize(spatial.load_detections(**_load_inputs(fx), with_first=False))


ORACLE_LOADED = f"""
with cfg as (
  select cast(c.geozone_id as bigint) as geozone_id, b.batch_id, b.batch_year, cast(c.geozone_id as bigint) * 10 + b.idx as load_seq
  from fx_commune c cross join (values (2015, 2015, 0), (2018, 2018, 1), (2021, 2021, 2), (2024, 2024, 3)) b(batch_id, batch_year, idx)),
inf as (select * from fx_detection where score > 0.3 and object_type in ('construction en dur', 'piscine', 'mobil home', 'caravane',
  'construction legere yourte etc.', 'container', 'installation legere')),
cand as (
  select i.*, cfg.geozone_id, cfg.batch_year as year_cfg, cfg.load_seq from inf i
  join cfg on i.batch_year = cfg.batch_id
  join fx_commune z on cast(z.geozone_id as bigint) = cfg.geozone_id and {_within_box('i', 'z')}
  where exists (select 1 from fx_risk r where r.zone_id in (351, 352, 361) and {_within_risk('i', 'r')})),
pm as (select i.id, min(p.id) as pid from inf i join fx_parcel p on {_meets('i', 'p')} group by i.id),
loaded as (
  select cand.*, p2.id_parcellaire from cand left join pm on pm.id = cand.id left join fx_parcel p2 on p2.id = pm.pid),
stats_det as (
  select t.id, t.score,
    case when t.object_type in ('construction en dur', 'construction legere yourte etc.', 'container', 'installation legere')
      then 'construction en dur' else t.object_type end as object_type,
    t.geozone_id, t.year_cfg as batch_year, t.id_parcellaire, t.minx, t.miny, t.maxx, t.maxy,
    not exists (select 1 from loaded e where e.load_seq < t.load_seq and 2 * {_overlap('t', 'e')} > {_area('t')}) as first_detection
  from loaded t)
"""


@register("C1_load_detections", with_fixtures(ORACLE_LOADED + """
select id, score, object_type, geozone_id, batch_year, id_parcellaire, first_detection from stats_det""",
                                              "fx_detection", "fx_commune", "fx_risk", "fx_parcel"))
def q_load_detections(spark, sf_dir):
    return _loaded(Fixtures(spark, sf_dir)).select("id", "score", "object_type", "geozone_id", "batch_year", "id_parcellaire", "first_detection")


@register("S9_prescribed_by_history", with_fixtures(ORACLE_LOADED + f"""
select a.id, a.batch_year, a.id_parcellaire, a.object_type, a.geozone_id,
  cast(count(distinct b.batch_year) as bigint) as count_histo_6y_detection, count(distinct b.batch_year) >= 1 as prescripted_detection
from stats_det a left join stats_det b on a.id_parcellaire = b.id_parcellaire and a.batch_year - b.batch_year >= 6
  and {_overlap('a', 'b')} / nullif({_area('a')}, 0) >= 0.5
where a.object_type in ('construction en dur', 'piscine')
group by a.id, a.batch_year, a.id_parcellaire, a.object_type, a.geozone_id""", "fx_detection", "fx_commune", "fx_risk", "fx_parcel"))
def q_prescribed_by_history(spark, sf_dir):
    h = spatial.prescribed_by_history(_stored_load(Fixtures(spark, sf_dir)), PAIR_CELL)
    return h.select("id", "batch_year", "id_parcellaire", "object_type", "geozone_id", "count_histo_6y_detection", "prescripted_detection")


# ---------------------------------------------------------------- S8, C8, C9, C6: parcels at risk and evolution reports
def _parcel_stats(fx: Fixtures, level: str):
    return spatial.parcels_at_risk(layers.parcel_layer(fx.fx_parcel, keep=("id_parcellaire", "commune_id")), fx.fx_commune,
                                   layers.risk_layer(fx.fx_risk), CELL, level=level)


def _oracle_spa(level: str) -> str:
    inze = f"(select distinct p.id from fx_parcel p join fx_risk r on {_within_risk('p', 'r')})"
    if level == "commune":
        return f"""spa as (
  select cast(ze.geozone_id as bigint) as geozone_id, cast(tot.nb_parcels as bigint) as nb_parcels, cast(ze.nb_parcels_in_ze as bigint) as nb_parcels_in_ze
  from (select commune_id as geozone_id, count(distinct id_parcellaire) as nb_parcels_in_ze from fx_parcel where id in {inze} group by commune_id) ze
  left join (select commune_id as geozone_id, count(id_parcellaire) as nb_parcels from fx_parcel group by commune_id) tot on tot.geozone_id = ze.geozone_id)"""
    return f"""pe as (select p.*, c.epci_id from fx_parcel p join fx_commune c on c.geozone_id = p.commune_id),
spa as (
  select cast(ze.geozone_id as bigint) as geozone_id, cast(tot.nb_parcels as bigint) as nb_parcels, cast(ze.nb_parcels_in_ze as bigint) as nb_parcels_in_ze
  from (select epci_id as geozone_id, count(distinct id_parcellaire) as nb_parcels_in_ze from pe where id in {inze} group by epci_id) ze
  left join (select epci_id as geozone_id, count(distinct id_parcellaire) as nb_parcels from pe group by epci_id) tot on tot.geozone_id = ze.geozone_id)"""


@register("S8_parcels_at_risk", with_fixtures(f"with {_oracle_spa('commune')} select * from spa", "fx_parcel", "fx_risk"))
def q_parcels_at_risk(spark, sf_dir):
    return _parcel_stats(Fixtures(spark, sf_dir), "commune")


@register("S8_parcels_at_risk_epci", with_fixtures(f"with {_oracle_spa('epci')} select * from spa", "fx_parcel", "fx_risk", "fx_commune"))
def q_parcels_at_risk_epci(spark, sf_dir):
    return _parcel_stats(Fixtures(spark, sf_dir), "epci")


ORACLE_EVO_EPCI = f"""
with periods as (select * from (values ('2021-2023', 2021, 2024), ('2018-2020', 2018, 2021), ('2015-2017', 2015, 2018)) t(label, a, b)),
d as (select * from fx_det_tagged where id_parcellaire is not null),
st as (select geozone_id, batch_year, count(distinct id_parcellaire) as n from d where batch_year in (2015, 2018, 2021, 2024) group by geozone_id, batch_year),
nw as (select p.label, e.geozone_id, count(distinct e.id_parcellaire) as n from periods p join d e on e.batch_year = p.b
  where not exists (select 1 from d s where s.batch_year = p.a and s.id_parcellaire = e.id_parcellaire and s.geozone_id = e.geozone_id)
  group by p.label, e.geozone_id),
cl as (select p.label, s.geozone_id, count(distinct s.id_parcellaire) as n from periods p join d s on s.batch_year = p.a
  where not exists (select 1 from d e where e.batch_year = p.b and e.id_parcellaire = s.id_parcellaire and e.geozone_id = s.geozone_id)
  group by p.label, s.geozone_id),
{_oracle_spa('epci')},
evo as (
  select z.name_normalized, s.geozone_id,
    cast(s.n as bigint) as situation_parcelles_cabanisees_debut_periode,
    cast(coalesce(f.n, 0) as bigint) as situation_parcelles_cabanisees_fin_periode,
    cast(coalesce(nw.n, 0) as bigint) as situation_nouvelles_parcelles_cabanisees_periode,
    cast(coalesce(cl.n, 0) as bigint) as situation_parcelles_remises_en_etat_periode,
    p.label as periode,
    cast(coalesce(spa.nb_parcels, 0) as bigint) as nb_parcels, cast(coalesce(spa.nb_parcels_in_ze, 0) as bigint) as nb_parcels_in_ze
  from periods p join st s on s.batch_year = p.a
  left join st f on f.geozone_id = s.geozone_id and f.batch_year = p.b
  left join nw on nw.label = p.label and nw.geozone_id = s.geozone_id
  left join cl on cl.label = p.label and cl.geozone_id = s.geozone_id
  left join fx_zone z on z.id = s.geozone_id
  left join spa on spa.geozone_id = s.geozone_id)
"""
_EVO_FX = ("fx_det_tagged", "fx_parcel", "fx_risk", "fx_commune", "fx_zone")


def _evo_epci(fx: Fixtures):
    return cohort.evolution_epci(fx.fx_det_tagged, fx.fx_zone, _parcel_stats(fx, "epci"))


@register("C8_evolution_epci", with_fixtures(ORACLE_EVO_EPCI + "select * from evo", *_EVO_FX))
def q_evolution_epci(spark, sf_dir):
    return _evo_epci(Fixtures(spark, sf_dir))


@register("C9_corrected_estimates", with_fixtures(ORACLE_EVO_EPCI + """
select name_normalized, geozone_id,
  cast(floor(situation_parcelles_cabanisees_debut_periode * 0.705 * (1 - 0.252)) as bigint) as situation_parcelles_cabanisees_debut_periode,
  cast(floor(situation_parcelles_cabanisees_fin_periode * 0.705 * (1 - 0.252)) as bigint) as situation_parcelles_cabanisees_fin_periode,
  cast(floor(situation_nouvelles_parcelles_cabanisees_periode * 0.705 * (1 - 0.252)) as bigint) as situation_nouvelles_parcelles_cabanisees_periode,
  cast(floor(situation_parcelles_remises_en_etat_periode * 0.705 * (1 - 0.252)) as bigint) as situation_parcelles_remises_en_etat_periode,
  periode, nb_parcels, nb_parcels_in_ze
from evo""", *_EVO_FX))
def q_corrected_estimates(spark, sf_dir):
    return cohort.corrected_estimates(_evo_epci(Fixtures(spark, sf_dir)))


# ---------------------------------------------------------------- C6, C7, C17, C18: commune report and scores
def _evo_commune(fx: Fixtures):
    return cohort.evolution_commune(_pv_rows(fx), fx.fx_det_tagged, fx.fx_mapping, _parcel_stats(fx, "commune"))


def _oracle_evo_commune() -> str:
    def new(y, base):
        return f"""(select geozone_id, count(*) as n from (
    select distinct id_parcellaire, geozone_id from fx_det_tagged where batch_year = {y} and id_parcellaire is not null
    except select distinct id_parcellaire, geozone_id from fx_det_tagged where batch_year in ({base}) and id_parcellaire is not null) t group by geozone_id)"""

    def cleared(a, b):
        return f"""(select t.geozone_id, count(distinct t.id_parcellaire) as n from fx_det_tagged t where t.batch_year = {a}
    and t.id_parcellaire is not null and not exists (select 1 from fx_det_tagged u where u.batch_year = {b}
    and u.id_parcellaire = t.id_parcellaire and u.geozone_id = t.geozone_id) group by t.geozone_id)"""

    ids = ", ".join(map(str, cohort.NO_ENGAGEMENT_IDS))
    label = cohort.ENGAGEMENT_LABELS

    def part(label, pvcol, a, b, nw, cl, group):
        return f"""select m.department_name, m.geozone_code, cast(pv.geozone_id as bigint) as geozone_id, cast(pv.{pvcol} as bigint) as nb_pv_period,
    cast(s1.n as bigint) as situation_parcelles_cabanisees_debut_periode, cast(s2.n as bigint) as situation_parcelles_cabanisees_fin_periode,
    cast(nw.n as bigint) as situation_nouvelles_parcelles_cabanisees_periode, cast(cl.n as bigint) as situation_parcelles_remises_en_etat_periode,
    {group} as groupe, '{label}' as periode, spa.nb_parcels, spa.nb_parcels_in_ze
  from pvp pv left join stc s1 on s1.geozone_id = pv.geozone_id and s1.batch_year = {a}
  left join stc s2 on s2.geozone_id = pv.geozone_id and s2.batch_year = {b}
  left join {nw} nw on nw.geozone_id = pv.geozone_id left join {cl} cl on cl.geozone_id = pv.geozone_id
  left join fx_mapping m on m.id = pv.geozone_id left join spa on spa.geozone_id = pv.geozone_id
  where s1.n is not null"""

    g1 = (f"case when m.department_name = '{cohort.ENGAGEMENT_DEPARTMENT}' then '{label['department']}' "
          f"when m.id in ({ids}) then '{label['none']}' else '{label['2021-2023']}' end")
    g2 = f"case when m.id in ({ids}) then '{label['none']}' else '{label['2018-2020']}' end"
    return ORACLE_PV_COUNTS + f""",
{_oracle_spa('commune')},
pvp as (select geozone_id, sum(case when year >= 2018 and year <= 2020 then nb_pv else 0 end) as pv_a,
  sum(case when year >= 2021 and year <= 2023 then nb_pv else 0 end) as pv_b from stats_pv group by geozone_id),
stc as (select geozone_id, batch_year, count(distinct id_parcellaire) as n from fx_det_tagged group by geozone_id, batch_year),
evoc as (
{part('2021-2023', 'pv_b', 2021, 2024, new(2024, '2021, 2018'), cleared(2021, 2024), g1)}
union
{part('2018-2020', 'pv_a', 2018, 2021, new(2021, '2018'), cleared(2018, 2021), g2)})
"""


_EVOC_FX = ("fx_pv", "fx_commune_ref", "fx_det_tagged", "fx_mapping", "fx_parcel", "fx_risk")


@register("C6_evolution_commune", with_fixtures(_oracle_evo_commune() + "select * from evoc", *_EVOC_FX))
def q_evolution_commune(spark, sf_dir):
    return _evo_commune(Fixtures(spark, sf_dir))


@register("C7_engagement_group", with_fixtures(_oracle_evo_commune() + "select geozone_id, periode, groupe from evoc", *_EVOC_FX))
def q_engagement_group(spark, sf_dir):
    return _evo_commune(Fixtures(spark, sf_dir)).select("geozone_id", "periode", "groupe")


def _scores(fx: Fixtures):
    wide = cohort.commune_report_wide(_parcel_stats(fx, "commune"), _evo_commune(fx), _pv_rows(fx))
    return cohort.zone_scores(wide)


def _div(a: str, b: str) -> str:
    return f"(case when ({b}) = 0 then null else cast({a} as double) / cast({b} as double) end)"


ORACLE_SCORES = _oracle_evo_commune() + f""",
wide as (
  select spa.geozone_id, spa.nb_parcels, spa.nb_parcels_in_ze, e.situation_parcelles_cabanisees_debut_periode as s21,
    e.situation_parcelles_cabanisees_fin_periode as s24, e.situation_nouvelles_parcelles_cabanisees_periode as n24,
    e.situation_parcelles_remises_en_etat_periode as c24, pvp.pv_a, pvp.pv_b
  from spa left join (select * from evoc where periode = '2021-2023') e on e.geozone_id = spa.geozone_id
  left join pvp on pvp.geozone_id = spa.geozone_id),
scores as (
  select geozone_id,
    {_div('nb_parcels_in_ze', 'nb_parcels')} as score_commune_potentiel_cabanisation,
    {_div('pv_b + pv_a', 's21')} as score_action_cabanisation,
    {_div('pv_b + pv_a', 'nb_parcels_in_ze')} as score_action_parcel,
    {_div('s21', 'nb_parcels_in_ze')} as score_etat_cabanisation,
    {_div('n24', 'nb_parcels_in_ze')} as score_nouvelles_cabanisation,
    {_div('c24', 'nb_parcels_in_ze')} as score_remises_en_etat,
    {_div('s24 - s21', 'nb_parcels_in_ze')} as score_evolution_cabanisation
  from wide)
"""


@register("C17_zone_scores", with_fixtures(ORACLE_SCORES + "select * from scores", *_EVOC_FX))
def q_zone_scores(spark, sf_dir):
    return _scores(Fixtures(spark, sf_dir))


def _oracle_corr() -> str:
    cols = cohort.SCORE_COLUMNS
    def r(a, b):
        den = f"(stddev_pop(case when {b} is not null then {a} end) * stddev_pop(case when {a} is not null then {b} end))"
        return f"round(case when {den} = 0 then null else covar_pop({a}, {b}) / {den} end, 9)"

    parts = [f"select '{a}' as a, '{b}' as b, {r(a, b)} as r from scores" for a in cols for b in cols]
    return ORACLE_SCORES + "\n union all ".join(parts)


@register("C18_score_correlation", with_fixtures(_oracle_corr(), *_EVOC_FX))
def q_score_correlation(spark, sf_dir):
    return cohort.score_correlation(_scores(Fixtures(spark, sf_dir)))


# ---------------------------------------------------------------- C11: unprescribed parcels (over S9)
def _history(fx: Fixtures):
    return spatial.prescribed_by_history(_stored_load(fx), PAIR_CELL)


ORACLE_HISTORY = ORACLE_LOADED + f""",
hist as (
  select a.id, a.batch_year, a.id_parcellaire, cast(count(distinct b.batch_year) as bigint) as count_histo_6y_detection
  from stats_det a left join stats_det b on a.id_parcellaire = b.id_parcellaire and a.batch_year - b.batch_year >= 6
    and {_overlap('a', 'b')} / nullif({_area('a')}, 0) >= 0.5
  where a.object_type in ('construction en dur', 'piscine')
  group by a.id, a.batch_year, a.id_parcellaire, a.object_type, a.geozone_id),
per as (select batch_year, id_parcellaire, cast(sum(count_histo_6y_detection) as bigint) as nb_prescripted_detection from hist group by batch_year, id_parcellaire)
"""
_LOAD_FX = ("fx_detection", "fx_commune", "fx_risk", "fx_parcel")


@register("C11_unprescribed_parcels", with_fixtures(ORACLE_HISTORY + """
select batch_year, cast(count(distinct id_parcellaire) * 0.705 * (1 - 0.252) as bigint) as nb_unprescripted_parcels
from per where nb_prescripted_detection = 0 and batch_year > 2018 group by batch_year""", *_LOAD_FX))
def q_unprescribed_parcels(spark, sf_dir):
    return cohort.unprescribed_parcels(_history(Fixtures(spark, sf_dir)))


@register("C11_unprescribed_parcel_list", with_fixtures(ORACLE_HISTORY + """
select batch_year, id_parcellaire, nb_prescripted_detection from per where nb_prescripted_detection = 0 and batch_year = 2024""", *_LOAD_FX))
def q_unprescribed_parcel_list(spark, sf_dir):
    return cohort.unprescribed_parcels(_history(Fixtures(spark, sf_dir)), year=2024)


# ---------------------------------------------------------------- W1–W6: workflow mining (W7 seeds are their inputs)
from vigie.operators import workflow  # noqa: E402
from vigie.sources import seeds  # noqa: E402

SQL_CASE_STEPS = seeds.values_sql([(c, o, lbl, i) for i, (c, o, lbl) in enumerate(seeds.CASE_STEPS)], ["step_code", "step_order", "step_label", "ordinal"])
SQL_REVIEW_STEPS = seeds.values_sql([(c, o, lbl, i) for i, (c, o, lbl) in enumerate(seeds.REVIEW_STEPS)], ["step_code", "step_order", "step_label", "ordinal"])
SQL_MAPPING = seeds.values_sql(seeds.REVIEW_STATUS_MAPPING, ["step_code", "status_code"])
SQL_CASE_TRANS = seeds.values_sql(seeds.CASE_TRANSITIONS, ["from_step", "to_step"])
SQL_REVIEW_TRANS = seeds.values_sql(seeds.REVIEW_TRANSITIONS, ["from_step", "to_step"])


def _case_flow(spark, fx):
    return workflow.case_transitions(fx.fx_case_log, seeds.workflow_steps(spark, "case"))


ORACLE_CASE_FLOW = f"""
with ordered as (
  select *, lead(action_type) over (partition by dossier_id order by id) as next_action_type,
    lead(action_date) over (partition by dossier_id order by id) as next_action_date from fx_case_log),
case_flow as (
  select o.*, s1.step_code as source_step, s2.step_code as target_step from ordered o
  left join {SQL_CASE_STEPS} s1 on lower(strip_accents(rtrim(o.action_type))) = lower(strip_accents(rtrim(s1.step_label)))
  left join {SQL_CASE_STEPS} s2 on lower(strip_accents(rtrim(o.next_action_type))) = lower(strip_accents(rtrim(s2.step_label)))
  where o.next_action_date is not null)
"""


@register("W1_case_transitions", with_fixtures(ORACLE_CASE_FLOW + "select * from case_flow", "fx_case_log"))
def q_case_transitions(spark, sf_dir):
    return _case_flow(spark, Fixtures(spark, sf_dir))


ORACLE_REVIEW = f"""
with study as (select t.* from fx_hist_det t, fx_study s where t.tile_set_id = 19 and t.score > 0.3 and {_within_box('t', 's')}
  and exists (select 1 from fx_risk r where {_within_risk('t', 'r')})),
imp0 as (
  select t.id as detection_id, h.id as detection_data_id, h.history_id, h.history_date, c.parcel_id,
    '{workflow.IMPORT_EMAIL}' as email, '{workflow.IMPORT_GROUP}' as group_name, h.changed_fields,
    'IMPORTED' as old_pre_status, 'IMPORTED' as old_val_status, 'IMPORTED' as old_ctl_status,
    case when h.detection_prescription_status is null and t.auto_prescribed is not true then 'NOT_PRESCRIBED'
      when h.detection_prescription_status is null and t.auto_prescribed is true then 'PRESCRIBED' else h.detection_prescription_status end as new_pre_status,
    coalesce(h.detection_validation_status, 'DETECTED_NOT_VERIFIED') as new_val_status,
    coalesce(h.detection_control_status, 'NOT_CONTROLLED') as new_ctl_status
  from fx_history h join study t on h.id = t.detection_data_id left join fx_hist_object c on c.id = t.detection_object_id
  where (h.history_type = '+' or (h.history_type = '~' and h.changed_fields is null))),
imp1 as (select *, old_val_status || '.' || old_ctl_status || '.' || old_pre_status as old_status,
  new_val_status || '.' || new_ctl_status || '.' || new_pre_status as new_status from imp0),
baseline as (select * exclude (rn) from (select *, row_number() over (partition by detection_data_id, old_status
  order by history_id desc, detection_id asc, parcel_id asc nulls last, new_status asc) as rn from imp1) where rn = 1),
app0 as (
  select t.id as detection_id, h.id as detection_data_id, h.changed_fields, h.detection_validation_status, h.detection_control_status,
    h.detection_prescription_status, h.history_id, h.history_date, c.parcel_id, u.email, u.group_name
  from fx_history h join study t on h.id = t.detection_data_id join fx_user u on u.id = h.history_user_id
  left join fx_hist_object c on c.id = t.detection_object_id where h.changed_fields is not null),
app1 as (select * exclude (rn) from (select *, row_number() over (partition by detection_id, detection_data_id, history_id
  order by parcel_id desc nulls first) as rn from app0) where rn = 1),
elems as (select a.detection_id, a.detection_data_id, a.history_id, e.v ->> 'field' as field_name, e.v ->> 'old_value' as old_raw
  from app1 a, lateral (select unnest(json_extract(a.changed_fields, '$[*]')) as v) e),
olds as (select detection_id, detection_data_id, history_id,
    max(case when field_name = 'detection_validation_status' then old_raw end) as ov,
    max(case when field_name = 'detection_control_status' then old_raw end) as oc,
    max(case when field_name = 'detection_prescription_status' then old_raw end) as op
  from elems where field_name in ('detection_validation_status', 'detection_control_status', 'detection_prescription_status')
  group by detection_id, detection_data_id, history_id),
changes0 as (select a.detection_id, a.detection_data_id, a.history_id, a.history_date, a.parcel_id, a.email, a.group_name,
    '[' || array_to_string([('{{"field":"' || (v ->> 'field') || '","old":' || coalesce('"' || (v ->> 'old_value') || '"', 'null') || ',"new":'
      || coalesce('"' || (v ->> 'new_value') || '"', 'null') || '}}') for v in json_extract(a.changed_fields, '$[*]')
      if (v ->> 'field') in ('detection_validation_status', 'detection_control_status', 'detection_prescription_status')], ',') || ']' as fields,
    a.detection_validation_status as new_val_status, a.detection_control_status as new_ctl_status, a.detection_prescription_status as new_pre_status,
    coalesce(o.ov, a.detection_validation_status) as old_val_status, coalesce(o.oc, a.detection_control_status) as old_ctl_status,
    coalesce(o.op, a.detection_prescription_status) as old_pre_status
  from app1 a join olds o using (detection_id, detection_data_id, history_id)),
changes as (select *, old_val_status || '.' || old_ctl_status || '.' || old_pre_status as old_status,
  new_val_status || '.' || new_ctl_status || '.' || new_pre_status as new_status from changes0),
"""
ORACLE_FLOW = ORACLE_REVIEW + f"""
flow as (
  select c.detection_id, c.detection_data_id, c.old_status, c.new_status, mo.step_code as source_step, mn.step_code as target_step,
    c.history_date, c.parcel_id, 'app' as process
  from changes c join {SQL_MAPPING} mo on c.old_status = mo.status_code join {SQL_MAPPING} mn on c.new_status = mn.status_code
  where mo.step_code <> mn.step_code
  union
  select c.detection_id, c.detection_data_id, c.old_status, c.new_status, mo.step_code, mn.step_code, c.history_date, c.parcel_id, 'import'
  from baseline c join {SQL_MAPPING} mo on c.old_status = mo.status_code join {SQL_MAPPING} mn on c.new_status = mn.status_code
  where mo.step_code <> mn.step_code)
"""
_W_FX = ("fx_history", "fx_hist_det", "fx_hist_object", "fx_user", "fx_study", "fx_risk")


def _versions(fx):
    """Reviewed versions inside the study territory and a risk zone: filtered first, then tested against the area, once."""
    det = workflow.reviewed(fx.fx_hist_det)
    zones = layers.risk_layer(fx.fx_risk).unionByName(layers.box_layer(fx.fx_study, "zone_id"))
    scope = workflow.study_scope(layers.box_layer(det, "version_id"), zones, 900, [351, 352, 361], CELL)
    return workflow.scoped_versions(det, fx.fx_hist_object, scope)


def _baseline(fx, versions=None):
    return workflow.import_baseline(fx.fx_history, _versions(fx) if versions is None else versions)


def _changes(fx, versions=None):
    return workflow.review_changes(fx.fx_history, _versions(fx) if versions is None else versions, fx.fx_user)


def _flow(spark, fx):
    versions = materialize(_versions(fx))  # a few narrow columns; both parts read them
    return workflow.status_flow(_baseline(fx, versions), _changes(fx, versions), seeds.status_mapping(spark))


@register("W2_import_baseline", with_fixtures(ORACLE_REVIEW.rstrip().rstrip(",") + "\nselect * from baseline", *_W_FX))
def q_import_baseline(spark, sf_dir):
    return _baseline(Fixtures(spark, sf_dir))


@register("W3_review_changes", with_fixtures(ORACLE_REVIEW.rstrip().rstrip(",") + "\nselect * from changes", *_W_FX))
def q_review_changes(spark, sf_dir):
    return _changes(Fixtures(spark, sf_dir))


@register("W4_status_flow", with_fixtures(ORACLE_FLOW + "select * from flow", *_W_FX))
def q_status_flow(spark, sf_dir):
    return _flow(spark, Fixtures(spark, sf_dir))


@register("W5_unknown_transitions", with_fixtures(ORACLE_FLOW + f"""
select source_step || '_' || target_step as transition_code, old_status, new_status, count(*) as nb_transitions from flow
where source_step || '_' || target_step not in (select from_step || '_' || to_step from {SQL_REVIEW_TRANS} t)
  and source_step || '_' || target_step is not null and old_status is not null and new_status is not null
group by 1, 2, 3""", *_W_FX))
def q_unknown_transitions(spark, sf_dir):
    return workflow.unknown_transitions(_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_transitions(spark, "review"), ["old_status", "new_status"])


@register("W5_unknown_case_transitions", with_fixtures(ORACLE_CASE_FLOW + f"""
select source_step || '_' || target_step as transition_code, action_type, next_action_type, count(*) as nb_transitions from case_flow
where source_step || '_' || target_step not in (select from_step || '_' || to_step from {SQL_CASE_TRANS} t)
  and source_step || '_' || target_step is not null and action_type is not null and next_action_type is not null
group by 1, 2, 3""", "fx_case_log"))
def q_unknown_case_transitions(spark, sf_dir):
    return workflow.unknown_transitions(_case_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_transitions(spark, "case"),
                                        ["action_type", "next_action_type"], labels=("action_type", "next_action_type"))


def _oracle_links(flow: str, steps: str, trans: str, strict: bool) -> str:
    allowed = f"and source_step || '_' || target_step in (select from_step || '_' || to_step from {trans} t)" if strict else ""
    return f"""
select g.transition_code, g.source_step, g.target_step, g.nb_transitions, st.ordinal as target, ss.ordinal as source from (
  select source_step || '_' || target_step as transition_code, source_step, target_step, count(*) as nb_transitions from {flow}
  where source_step is not null and target_step is not null {allowed} group by 1, 2, 3) g
left join {steps} st on st.step_code = g.target_step left join {steps} ss on ss.step_code = g.source_step
where st.ordinal is not null"""


@register("W6_transition_flow", with_fixtures(ORACLE_FLOW + _oracle_links("flow", SQL_REVIEW_STEPS, SQL_REVIEW_TRANS, True), *_W_FX))
def q_transition_flow(spark, sf_dir):
    return workflow.transition_flow(_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_steps(spark, "review"),
                                    seeds.workflow_transitions(spark, "review"), strict=True)


@register("W6_case_transition_flow", with_fixtures(ORACLE_CASE_FLOW + _oracle_links("case_flow", SQL_CASE_STEPS, SQL_CASE_TRANS, False), "fx_case_log"))
def q_case_transition_flow(spark, sf_dir):
    return workflow.transition_flow(_case_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_steps(spark, "case"),
                                    seeds.workflow_transitions(spark, "case"), strict=False)


@register("W6_transition_flow_open", with_fixtures(ORACLE_FLOW + _oracle_links("flow", SQL_REVIEW_STEPS, SQL_REVIEW_TRANS, False), *_W_FX))
def q_transition_flow_open(spark, sf_dir):
    return workflow.transition_flow(_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_steps(spark, "review"),
                                    seeds.workflow_transitions(spark, "review"), strict=False)


@register("W6_case_transition_flow_strict", with_fixtures(ORACLE_CASE_FLOW + _oracle_links("case_flow", SQL_CASE_STEPS, SQL_CASE_TRANS, True), "fx_case_log"))
def q_case_transition_flow_strict(spark, sf_dir):
    return workflow.transition_flow(_case_flow(spark, Fixtures(spark, sf_dir)), seeds.workflow_steps(spark, "case"),
                                    seeds.workflow_transitions(spark, "case"), strict=True)


# ---------------------------------------------------------------- C10, C12, C14, C15, C16: status and deployment KPIs
def _risk_ids(fx: Fixtures):
    """Ids of detections within at least one risk zone (S1 over the risk layer)."""
    return spatial.zone_tag(layers.detection_layer(fx.fx_detection), layers.risk_layer(fx.fx_risk), CELL).select("id").distinct()


def _thresholds(spark):
    # Minimum score of a not-yet-verified detection per tileset: (1−0.3)×0.6, (1−0.3)×0.3, 0.3
    return spark.createDataFrame([(1, 0.42), (2, 0.21), (17, 0.3)], "tile_set_id int, min_score double")


@register("C10_parcel_status", with_fixtures(f"""
with inrisk as (select distinct d.id from fx_detection d join fx_risk r on {_within_risk('d', 'r')}),
th as (select * from (values (1, 0.42), (2, 0.21), (17, 0.3)) t(tile_set_id, min_score)),
base as (
  select d.tile_set_id, o.commune_id, o.parcel_id, dd.detection_validation_status as v from fx_detection d
  join th on th.tile_set_id = d.tile_set_id
  left join fx_detdata dd on d.detection_data_id = dd.id left join fx_object o on d.detection_object_id = o.id
  left join fx_type ty on o.object_type_id = ty.id
  where d.id in (select id from inrisk) and ty.name_n in ('Construction en dur', 'Piscine', 'Mobil-home', 'Caravane', 'Installation Legere')
    and (dd.detection_validation_status in ('SUSPECT', 'LEGITIMATE') or (dd.detection_validation_status = 'DETECTED_NOT_VERIFIED'
      and d.score > th.min_score and (dd.detection_prescription_status is null or dd.detection_prescription_status <> 'PRESCRIBED')))),
flags as (select tile_set_id, commune_id, parcel_id, bool_or(v = 'SUSPECT') as has_suspect, bool_or(v = 'LEGITIMATE') as has_legitimate,
  bool_or(v = 'DETECTED_NOT_VERIFIED') as has_dnv from base group by tile_set_id, commune_id, parcel_id)
select z.name as commune_name, f.tile_set_id, f.commune_id,
  count(distinct f.parcel_id) filter (where has_suspect) as parcels_with_suspect,
  count(distinct f.parcel_id) filter (where has_dnv) as parcels_with_dnv,
  count(distinct f.parcel_id) filter (where has_legitimate) as parcels_with_legit,
  count(distinct f.parcel_id) filter (where not has_suspect and (has_legitimate or has_dnv)) as parcels_with_legit_and_dnv_no_suspect
from flags f left join fx_zone z on z.id = f.commune_id group by z.name, f.tile_set_id, f.commune_id""",
                                          "fx_detection", "fx_risk", "fx_detdata", "fx_object", "fx_type", "fx_zone"))
def q_parcel_status(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.parcel_status(fx.fx_detection, fx.fx_detdata, fx.fx_object, fx.fx_type, fx.fx_zone, _risk_ids(fx), _thresholds(spark))


def _oracle_yearly(column, value, tileset, year, name):
    return f"""
select cast(o.commune_id as bigint) as geozone_id, {year} as year, cast(count(*) // 3 as bigint) as {name}
from fx_detection d join fx_detdata dd on d.detection_data_id = dd.id join fx_object o on d.detection_object_id = o.id
where d.tile_set_id = {tileset} and dd.{column} = '{value}' and o.commune_id in (select geozone_ptr_id from fx_commune_ref)
group by o.commune_id"""


@register("C12_yearly_legitimate", with_fixtures(_oracle_yearly("detection_validation_status", "LEGITIMATE", 2, 2021, "nb_status_updates"),
                                                 "fx_detection", "fx_detdata", "fx_object", "fx_commune_ref"))
def q_yearly_legitimate(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.yearly_average_status(fx.fx_detection, fx.fx_detdata, fx.fx_object, fx.fx_commune_ref,
                                        "detection_validation_status", "LEGITIMATE", tileset=2, year=2021)


@register("C12_yearly_controls", with_fixtures(_oracle_yearly("detection_control_status", "CONTROLLED_FIELD", 1, 2021, "nb_controls"),
                                               "fx_detection", "fx_detdata", "fx_object", "fx_commune_ref"))
def q_yearly_controls(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.yearly_average_status(fx.fx_detection, fx.fx_detdata, fx.fx_object, fx.fx_commune_ref,
                                        "detection_control_status", "CONTROLLED_FIELD", tileset=1, year=2021, name="nb_controls")


@register("C14_parcels_per_department", with_fixtures("""
select z.name, d.insee_code, count(*) as nb_parcels from fx_parcel p
join fx_commune_ref c on c.geozone_ptr_id = p.commune_id join fx_department d on d.geozone_ptr_id = c.department_id
join fx_zone z on z.id = d.geozone_ptr_id group by z.name, d.insee_code""", "fx_parcel", "fx_commune_ref", "fx_department", "fx_zone"))
def q_parcels_per_department(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.parcels_per_department(fx.fx_parcel, fx.fx_commune_ref, fx.fx_department, fx.fx_zone)


def _planned(spark):
    return spark.createDataFrame([(d, 0) for d in cohort.PLANNED_DEPARTMENTS], "dep_geozone_id long, nb_collectivity long")


def _groups_via_communes(fx: Fixtures):
    """User groups → their zones → the zones' departments (the left-join chain of the deployment report)."""
    return fx.fx_group_zone.select("name", "user_group_type", "geozone_id").join(
        fx.fx_commune_ref.select(F.col("geozone_ptr_id").alias("geozone_id"), F.col("department_id").alias("dep_geozone_id")), "geozone_id", "left")


def _oracle_deploy(groups: str) -> str:
    return f"""
with dep as (select name, case when name = 'Cabanisation Pic Saint Loup' then 2 else dep_geozone_id end as dep_geozone_id
  from {groups} where geozone_id is not null and user_group_type = 'COLLECTIVITY' and geozone_id <> 1613),
agg as (select cast(dep_geozone_id as bigint) as dep_geozone_id, cast(count(distinct name) as bigint) as nb_collectivity from dep group by dep_geozone_id),
syn as (select * from (values (1540, 0), (1547, 0), (1551, 0), (1580, 0), (36156, 0)) s(dep_geozone_id, nb_collectivity)),
deployment as (select * from agg union all
  select cast(dep_geozone_id as bigint), cast(nb_collectivity as bigint) from syn where dep_geozone_id not in (select dep_geozone_id from agg))
"""


_GROUPS_VIA = "(select g.name, g.user_group_type, g.geozone_id, c.department_id as dep_geozone_id from fx_group_zone g left join fx_commune_ref c on c.geozone_ptr_id = g.geozone_id)"


@register("C15_deployment_by_department", with_fixtures(_oracle_deploy(_GROUPS_VIA) + "select * from deployment", "fx_group_zone", "fx_commune_ref"))
def q_deployment(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.deployment_by_department(_groups_via_communes(fx), _planned(spark))


@register("C15_deployment_null_department", with_fixtures(_oracle_deploy("fx_group_zone") + "select * from deployment", "fx_group_zone"))
def q_deployment_null(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return cohort.deployment_by_department(fx.fx_group_zone, _planned(spark))


# ---------------------------------------------------------------- S4, S11, S12, S15, C16: edge-table operators
def _departments(fx: Fixtures):
    """Department boundaries: communes dissolved by department (S4), keyed by the department zone id."""
    groups = fx.fx_commune_ref.select(F.col("geozone_ptr_id").cast("long").alias("id"), F.col("department_id").cast("long").alias("group_id"))
    return spatial.dissolve(layers.commune_layer(fx.fx_commune), groups, CELL).withColumnRenamed("group_id", "id")


@register("S4_dissolve", with_fixtures("""
with c as (select n.*, r.department_id from fx_commune n join fx_commune_ref r on r.geozone_ptr_id = n.geozone_id),
shared as (select a.department_id, count(*) * 200 as len from c a join c b on a.department_id = b.department_id
  and ((a.maxx = b.minx and a.miny = b.miny) or (a.maxy = b.miny and a.minx = b.minx)) group by a.department_id)
select cast(c.department_id as bigint) as id, cast(sum((maxx - minx) * (maxy - miny)) as double) as area,
  cast(sum(2 * (maxx - minx) + 2 * (maxy - miny)) - 2 * coalesce(max(s.len), 0) as double) as perimeter
from c left join shared s on s.department_id = c.department_id group by c.department_id""", "fx_commune", "fx_commune_ref"))
def q_dissolve(spark, sf_dir):
    m = spatial.edge_measures(_departments(Fixtures(spark, sf_dir)), "id")
    return m.select(F.col("id").cast("long").alias("id"), "area", "perimeter")


def _lonlat_communes(fx: Fixtures):
    """Communes placed on the globe: lon = x/100, lat = 40 + y/100 (fixture convention)."""
    c = fx.fx_commune.select("geozone_id", (F.col("minx") / 100).alias("minx"), (F.col("miny") / 100 + 40).alias("miny"),
                             (F.col("maxx") / 100).alias("maxx"), (F.col("maxy") / 100 + 40).alias("maxy"))
    return layers.box_layer(c, "geozone_id")


@register("S11_zone_surface", with_fixtures("""
with b as (select geozone_id, minx / 100 as x0, miny / 100 + 40 as y0, maxx / 100 as x1, maxy / 100 + 40 as y1 from fx_commune)
select cast(geozone_id as bigint) as id, round((6378137.0 * radians(x1) - 6378137.0 * radians(x0))
  * (6378137.0 * ln(tan(pi() / 4 + radians(y1) / 2)) - 6378137.0 * ln(tan(pi() / 4 + radians(y0) / 2))) / 1e6, 3) as surface_km2
from b""", "fx_commune"))
def q_zone_surface(spark, sf_dir):
    s = spatial.zone_surface(_lonlat_communes(Fixtures(spark, sf_dir)))
    return s.select("id", F.round("surface_km2", 3).alias("surface_km2"))


ORACLE_CENTROIDS = """
with c as (select n.*, r.department_id from fx_commune n join fx_commune_ref r on r.geozone_ptr_id = n.geozone_id),
cen as (select department_id as id, sum((minx + maxx) / 2.0 * (maxx - minx) * (maxy - miny)) / sum((maxx - minx) * (maxy - miny)) as cx,
  sum((miny + maxy) / 2.0 * (maxx - minx) * (maxy - miny)) / sum((maxx - minx) * (maxy - miny)) as cy from c group by department_id),
ov as (select * from (values (36155, 51.0), (36156, 49.0), (36160, 45.0), (36161, 43.0)) t(id, o_lat)),
coords as (select cast(z.id as bigint) as id, z.name, case when ov.id is not null then -7.223655 else cen.cx end as lon,
  coalesce(ov.o_lat, cen.cy) as lat
  from fx_zone z join cen on cen.id = z.id left join ov on ov.id = z.id
  where z.id in (select geozone_ptr_id from fx_department) and z.name <> 'Guyane')
"""


def _centroids(fx: Fixtures):
    sel = fx.fx_department.select(F.col("geozone_ptr_id").alias("id"))
    return spatial.zone_centroids(_departments(fx), fx.fx_zone, sel)


@register("S12_zone_centroids", with_fixtures(ORACLE_CENTROIDS + "select * from coords", "fx_commune", "fx_commune_ref", "fx_zone", "fx_department"))
def q_zone_centroids(spark, sf_dir):
    return _centroids(Fixtures(spark, sf_dir))


@register("S15_tile_cover", with_fixtures("""
with b as (select geozone_id, minx / 100 as x0, miny / 100 + 40 as y0, maxx / 100 as x1, maxy / 100 + 40 as y1 from fx_commune)
select cast(geozone_id as bigint) as id,
  cast(floor((x0 + 180) / 360 * pow(2, 19)) as bigint) as min_x_tile,
  cast(floor((1 - ln(tan(radians(y1)) + 1 / cos(radians(y1))) / pi()) / 2 * pow(2, 19)) as bigint) as min_y_tile,
  cast(floor((x1 + 180) / 360 * pow(2, 19)) as bigint) as max_x_tile,
  cast(floor((1 - ln(tan(radians(y0)) + 1 / cos(radians(y0))) / pi()) / 2 * pow(2, 19)) as bigint) as max_y_tile
from b""", "fx_commune"))
def q_tile_cover(spark, sf_dir):
    return spatial.tile_cover(_lonlat_communes(Fixtures(spark, sf_dir)), zoom=19)


@register("C16_deployment_state", with_fixtures(ORACLE_CENTROIDS + "," + _oracle_deploy(_GROUPS_VIA).strip()[5:] + """,
st as (select c.id as dep_geozone_id, d.nb_collectivity as n, c.lat, c.lon from coords c left join deployment d on d.dep_geozone_id = c.id)
select f.geozone_ptr_id as dep_geozone_id, z.name, cast(coalesce(n, -1) as bigint) as nb_collectivity,
  case when n is null then 'Non planifié' when n = 0 then 'Déploiements à venir' when n > 0 and n < 3 then 'Communes pilotes'
    when n >= 3 and n <= 5 then 'Généralisation en cours' else 'Généralisation avancée' end as deployment_state,
  case when n is null then '#f0f0f0' when n = 0 then '#ffcc99' when n > 0 and n < 3 then '#cceeff' when n >= 3 and n <= 5 then '#99ddff' else '#3399ff' end as color,
  st.lat, st.lon,
  case when coalesce(n, -1) > -1 then case when n = 0 then z.name else z.name || ' : ' || cast(n as varchar) end else '' end as label
from fx_department f join fx_zone z on z.id = f.geozone_ptr_id join st on st.dep_geozone_id = f.geozone_ptr_id""",
                                             "fx_commune", "fx_commune_ref", "fx_zone", "fx_department", "fx_group_zone"))
def q_deployment_state(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    deployment = cohort.deployment_by_department(_groups_via_communes(fx), _planned(spark))
    feats = fx.fx_department.select(F.col("geozone_ptr_id").cast("long").alias("id")).join(fx.fx_zone.select("id", "name"), "id")
    return cohort.deployment_state(_centroids(fx), deployment, feats)


# ---------------------------------------------------------------- P1, P3, P6, P7: loads and retention
@register("P1_legacy_detections", with_fixtures("""
select l.id, case when l.dessine_interface then 1.0 when l.score is null then 1.0 else l.score end as score, cast(null as varchar) as address,
  t.name_n as object_type, case when l.dessine_interface then 'INTERFACE_DRAWN' else 'ANALYSIS' end as detection_source,
  case when l.signale_terrain then 'CONTROLLED_FIELD' when l.control_status_id = 1 then 'NOT_CONTROLLED' when l.control_status_id = 2 then 'SIGNALED_COMMUNE'
    when l.control_status_id = 3 then 'SIGNALED_COLLECTIVITY' when l.control_status_id = 4 then 'CONTROLLED_FIELD'
    when l.control_status_id = 5 then 'REHABILITATED' when l.control_status_id = 6 then 'VERBALIZED' end as detection_control_status,
  case when l.validation = 0 then 'INVALIDATED' when l.vrai_legitime and l.vrai_positif and not l.faux_positif then 'LEGITIMATE'
    when not l.vrai_legitime and l.vrai_positif and not l.faux_positif then 'SUSPECT'
    when not l.vrai_legitime and not l.vrai_positif and l.faux_positif then 'INVALIDATED'
    when not l.vrai_legitime and not l.vrai_positif and not l.faux_positif then 'DETECTED_NOT_VERIFIED' else 'DETECTED_NOT_VERIFIED' end as detection_validation_status,
  case when l.prescrit_manuel then 'PRESCRIBED' else 'NOT_PRESCRIBED' end as detection_prescription_status,
  l.validation is not null as user_reviewed, cast(null as bigint) as tile_x, cast(null as bigint) as tile_y,
  case when ti.dataset_id = 7 then 'sia_2012' when ti.dataset_id = 4 then 'sia_2015' when ti.dataset_id = 5 then 'sia_2018' when ti.dataset_id = 8 then 'sia_2021' end as batch_id,
  """ + _box_wkt("l.minx", "l.miny", "l.maxx", "l.maxy") + """ as geometry
from fx_legacy_detection l join fx_type t on (case when l.validation is null or l.validation = 0 then l.type_id else l.validation end) = t.id
join fx_tile ti on ti.id = l.tile_id where ti.dataset_id in (4, 5, 7, 8)""", "fx_legacy_detection", "fx_type", "fx_tile"))
def q_legacy_detections(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = loads.legacy_detections(_with_rings(fx.fx_legacy_detection), fx.fx_type, fx.fx_tile)
    return out.withColumn("geometry", G.wkt("geometry"))


@register("P3_load_parcels", with_fixtures("""
select false as arpente, c.geozone_ptr_id as commune_id, cast(coalesce(r.contenance, 0) as bigint) as contenance, false as deleted,
  r.idu as id_parcellaire, cast(ltrim(r.numero, '0') as integer) as num_parcel, cast(null as varchar) as prefix,
  cast(date '2025-01-01' as varchar) as refreshed_at, r.section, """ + _box_wkt("r.minx", "r.miny", "r.maxx", "r.maxy") + """ as geometry
from fx_parcel_raw r join fx_commune_ref c on c.iso_code = r.code_dep || r.code_com""", "fx_parcel_raw", "fx_commune_ref"))
def q_load_parcels(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = loads.load_parcels(_with_rings(fx.fx_parcel_raw), fx.fx_commune_ref).drop("created_at", "updated_at", "uuid", "deleted_at")
    return out.withColumn("refreshed_at", F.col("refreshed_at").cast("string")).withColumn("geometry", G.wkt("geometry"))


def _purged(fx: Fixtures):
    return loads.purge_batch(fx.fx_det_batch, fx.fx_detdata, fx.fx_object, fx.fx_zone_link, "sia_2021")


_PURGE_SQL = """
with det as (select * from fx_det_batch where batch_id is distinct from 'sia_2021'),
orphan_obj as (select o.id from fx_object o left join det d on o.id = d.detection_object_id where d.detection_object_id is null)
"""
_PURGE_FX = ("fx_det_batch", "fx_detdata", "fx_object", "fx_zone_link")


@register("P6_purge_batch", with_fixtures(_PURGE_SQL + "select id, batch_id from det", *_PURGE_FX))
def q_purge_batch(spark, sf_dir):
    return _purged(Fixtures(spark, sf_dir))["detection"].select("id", "batch_id")


@register("P7_orphan_data", with_fixtures(_PURGE_SQL + """
select * from fx_detdata where id not in (select dd.id from fx_detdata dd left join det d on dd.id = d.detection_data_id where d.detection_data_id is null)""",
                                          *_PURGE_FX))
def q_orphan_data(spark, sf_dir):
    return _purged(Fixtures(spark, sf_dir))["detectiondata"]


@register("P7_orphan_links", with_fixtures(_PURGE_SQL + """
select * from fx_zone_link where not coalesce(detectionobject_id in (select id from orphan_obj), false)""", *_PURGE_FX))
def q_orphan_links(spark, sf_dir):
    return _purged(Fixtures(spark, sf_dir))["detectionobject_geo_custom_zones"]


@register("P7_orphan_objects", with_fixtures(_PURGE_SQL + "select * from fx_object where id not in (select id from orphan_obj)", *_PURGE_FX))
def q_orphan_objects(spark, sf_dir):
    return _purged(Fixtures(spark, sf_dir))["detectionobject"]


# ---------------------------------------------------------------- S5, S6, S7, S10, S16
@register("S5_outside_bounds", with_fixtures(f"""
with cov as (select d.id, sum({_overlap('d', 'c')}) as covered from fx_detection d
  join fx_tileset_zone tz on tz.tileset_id = d.tile_set_id join fx_commune c on c.geozone_id = tz.geozone_id group by d.id)
select d.id from fx_detection d where d.tile_set_id not in (select tileset_id from fx_tileset_zone)
union all
select d.id from fx_detection d left join cov on cov.id = d.id
where d.tile_set_id in (select tileset_id from fx_tileset_zone) and coalesce(cov.covered, 0) < {_area('d')}""",
                                              "fx_detection", "fx_tileset_zone", "fx_commune"))
def q_outside_bounds(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection, keep=("tile_set_id",))
    return spatial.outside_bounds(det, fx.fx_tileset_zone, layers.commune_layer(fx.fx_commune), CELL)


@register("S6_extract_in_collectivities", with_fixtures(r"""
with named as (select c.* from fx_commune c where c.name in (select name from fx_commune_ref where department_id = 102)),
hit as (select distinct d.id from fx_detection d join named c on d.minx <= c.maxx and c.minx <= d.maxx and d.miny <= c.maxy and c.miny <= d.maxy)
select cast(null as varchar) as address, 'preprod_import' as batch_id, dd.detection_control_status, dd.detection_prescription_status,
  dd.detection_validation_status, d.id,
  regexp_replace(lower(regexp_replace(strip_accents(t.name_n), '[^a-zA-Z0-9\n. ]', ' ', 'g')), '\s+', ' ', 'g') as object_type,
  d.score, ti.x as tile_x, ti.y as tile_y, true as user_reviewed, """ + _box_wkt("d.minx", "d.miny", "d.maxx", "d.maxy") + """ as geometry,
  m.detection_source, cast(m.created_at as varchar) as created_at, cast(m.updated_at as varchar) as updated_at
from fx_detection d join fx_det_meta m on m.id = d.id join fx_detdata dd on dd.id = d.detection_data_id join fx_object o on o.id = d.detection_object_id
join fx_type t on t.id = o.object_type_id join fx_user u on u.id = dd.user_last_update_id join fx_tile ti on ti.id = 1 + d.id % 10
where d.id in (select id from hit) and u.email <> 'user3@example.org'""",
                                                         "fx_detection", "fx_commune", "fx_commune_ref", "fx_detdata", "fx_object", "fx_type", "fx_user", "fx_tile", "fx_det_meta"))
def q_extract_in_collectivities(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection.join(fx.fx_det_meta, "id").withColumn("tile_id", 1 + F.col("id") % 10),
                                 keep=("detection_data_id", "detection_object_id", "score", "tile_id", "detection_source", "created_at", "updated_at"))
    communes = layers.box_layer(fx.fx_commune, "geozone_id", keep=("name",))
    names = fx.fx_commune_ref.where(F.col("department_id") == 102).select("name")
    out = spatial.extract_in_collectivities(det, fx.fx_detdata, fx.fx_object, fx.fx_type, fx.fx_user, fx.fx_tile, communes, names,
                                            "preprod_import", "user3@example.org", CELL)
    return out.withColumns({"geometry": G.wkt("geometry"), **{c: F.col(c).cast("string") for c in ("created_at", "updated_at")}})


@register("S8_parcels_at_risk_by_config", with_fixtures(f"""
with inside as (select distinct p.commune_id, p.id_parcellaire from fx_parcel p join fx_risk_config c on c.geozone_id = p.commune_id
  join fx_risk r on r.zone_id in (c.ze_zone_id, c.zr_zone_id, c.zan_zone_id) and {_within_risk('p', 'r')})
select cast(c.stats_geozone_id as bigint) as geozone_id, (select count(id_parcellaire) from fx_parcel p where p.commune_id = c.geozone_id) as nb_parcels,
  (select count(distinct id_parcellaire) from inside i where i.commune_id = c.geozone_id) as nb_parcels_in_ze
from fx_risk_config c where c.geozone_id in (select commune_id from inside)""", "fx_parcel", "fx_risk_config", "fx_risk"))
def q_parcels_at_risk_by_config(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    parcels = layers.parcel_layer(fx.fx_parcel.withColumn("territory_id", F.col("commune_id")), keep=("id_parcellaire", "territory_id"))
    return spatial.parcels_at_risk_by_config(parcels, layers.risk_layer(fx.fx_risk), fx.fx_risk_config, CELL)


@register("S1_zone_tag_clockwise", with_fixtures(f"""
select d.id, cast(r.zone_id as bigint) as zone_id from fx_detection d join fx_risk r on {_within_risk('d', 'r')}""", "fx_detection", "fx_risk"))
def q_zone_tag_clockwise(spark, sf_dir):
    """S1 with every ring reversed on both sides, as shapefiles have them."""
    from vigie.plans.cells import as_layer

    fx = Fixtures(spark, sf_dir)
    turned = lambda rings: F.transform(rings, lambda r: F.reverse(r))
    det = as_layer(_with_rings(fx.fx_detection), "id", turned(F.col("rings")))
    risk = as_layer(fx.fx_risk.select("zone_id", turned(layers.risk_rings()).alias("rings")), "zone_id")
    return spatial.zone_tag(det, risk, CELL)


@register("S7_sync_zone_links", with_fixtures(f"""
select distinct d.detection_object_id as detectionobject_id, cast(r.zone_id as bigint) as geocustomzone_id
from fx_detection d join fx_risk r on {_within_risk('d', 'r')}
except select detectionobject_id, geocustomzone_id from fx_zone_link""", "fx_detection", "fx_risk", "fx_zone_link"))
def q_sync_zone_links(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection, keep=("detection_object_id",))
    return spatial.sync_zone_links(fx.fx_zone_link, det, layers.risk_layer(fx.fx_risk), CELL)


S10_ZONES = {"parcels_in_zan": 351, "parcels_in_zrf": 352, "parcels_in_zfee": 361}


@register("S10_parcel_zone_flags", with_fixtures(ORACLE_LOADED + f""",
refs as (select distinct id_parcellaire from stats_det where batch_year = 2024 and object_type in ('construction en dur', 'piscine')),
pf as (select p.id_parcellaire,
  max(case when exists (select 1 from fx_risk r where r.zone_id = 351 and {_within_risk('p', 'r')}) then 1 else 0 end) as zan,
  max(case when exists (select 1 from fx_risk r where r.zone_id = 352 and {_within_risk('p', 'r')}) then 1 else 0 end) as zrf,
  max(case when exists (select 1 from fx_risk r where r.zone_id = 361 and {_within_risk('p', 'r')}) then 1 else 0 end) as zfee
  from fx_parcel p where p.id_parcellaire in (select id_parcellaire from refs) group by p.id_parcellaire)
select cast(sum(zan) * 0.705 * (1 - 0.252) as integer) as parcels_in_zan, cast(sum(zrf) * 0.705 * (1 - 0.252) as integer) as parcels_in_zrf,
  cast(sum(zfee) * 0.705 * (1 - 0.252) as integer) as parcels_in_zfee from pf""", *_LOAD_FX))
def q_parcel_zone_flags(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = _stored_load(fx).where(F.col("object_type").isin(spatial.HISTORY_CLASSES))
    return spatial.parcel_zone_flags(layers.parcel_layer(fx.fx_parcel), det, layers.risk_layer(fx.fx_risk), S10_ZONES, 2024, CELL)


@register("S16_detections_in_risk", with_fixtures(f"""
with inrisk as (select distinct d.id from fx_detection d join fx_risk r on {_within_risk('d', 'r')}),
base as (select d.*, dd.detection_validation_status as v, dd.detection_prescription_status as pres, o.commune_id, o.parcel_id, c.iso_code
  from fx_detection d left join fx_detdata dd on dd.id = d.detection_data_id left join fx_object o on o.id = d.detection_object_id
  left join fx_type t on t.id = o.object_type_id left join fx_commune_ref c on c.geozone_ptr_id = o.commune_id
  where d.id in (select id from inrisk) and t.name_n in ('Construction en dur', 'Piscine', 'Mobil-home', 'Caravane', 'Installation Legere')),
ok as (select distinct b.id from base b join fx_threshold th on th.tile_set_id = b.tile_set_id and (th.iso_code is null or th.iso_code = b.iso_code)
  where b.v in ('SUSPECT', 'LEGITIMATE') or (b.v = 'DETECTED_NOT_VERIFIED' and b.score > th.min_score and (b.pres is null or b.pres <> 'PRESCRIBED')))
select b.id, b.tile_set_id, b.commune_id, b.parcel_id, (b.minx + b.maxx) / 2.0 as cx, (b.miny + b.maxy) / 2.0 as cy, b.v as detection_validation_status,
  {_box_wkt("b.minx", "b.miny", "b.maxx", "b.maxy")} as geometry
from base b where b.id in (select id from ok)""",
                                                   "fx_detection", "fx_risk", "fx_detdata", "fx_object", "fx_type", "fx_commune_ref", "fx_threshold"))
def q_detections_in_risk(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = layers.detection_layer(fx.fx_detection, keep=("tile_set_id", "score", "detection_data_id", "detection_object_id"))
    out = spatial.detections_in_risk(det, fx.fx_detdata, fx.fx_object, fx.fx_type, fx.fx_commune_ref, layers.risk_layer(fx.fx_risk),
                                     fx.fx_threshold, CELL)
    return out.withColumn("geometry", G.wkt("geometry"))


# ---------------------------------------------------------------- P2, S17, P5, Q1, S13, S14
from vigie.operators import quality  # noqa: E402


def _upsert(fx: Fixtures):
    zl = layers.commune_layer(fx.fx_commune).select("id", "rings", "minx", "miny", "maxx", "maxy")
    zones = fx.fx_zone.select(F.col("id").cast("long").alias("id"), "name", "name_normalized", "zone_type").join(zl, "id", "left")
    child = fx.fx_commune_ref.select(F.col("geozone_ptr_id").cast("long").alias("geozone_ptr_id"), F.col("iso_code").alias("code"))
    src = layers.box_layer(fx.fx_commune_src, "minx", keep=("insee_com", "nom", "insee_dep")).select(
        F.col("insee_com").alias("code"), F.col("nom").alias("name"), F.col("insee_dep").alias("parent_code"), "rings", "minx", "miny", "maxx", "maxy")
    return loads.upsert_collectivities(zones, child, src, "COMMUNE", parents=fx.fx_department)


_UPSERT_SQL = r"""
with src as (select * from fx_commune_src),
zgeo as (select z.id, z.name, z.name_normalized, z.zone_type, c.minx, c.miny, c.maxx, c.maxy from fx_zone z left join fx_commune c on c.geozone_id = z.id),
refreshed as (select z.id, z.name, z.name_normalized, z.zone_type, coalesce(s.minx, z.minx) as minx, coalesce(s.miny, z.miny) as miny,
  coalesce(s.maxx, z.maxx) as maxx, coalesce(s.maxy, z.maxy) as maxy
  from zgeo z left join fx_commune_ref r on r.geozone_ptr_id = z.id left join src s on s.insee_com = r.iso_code),
ins as (select (select max(id) from fx_zone) + row_number() over (order by insee_com) as id, nom as name,
  regexp_replace(lower(regexp_replace(replace(replace(strip_accents(nom), 'Œ', 'OE'), 'œ', 'oe'), '[^a-zA-Z0-9\n. ]', ' ', 'g')), '\s+', ' ', 'g') as name_normalized,
  'COMMUNE' as zone_type, minx, miny, maxx, maxy, insee_com, insee_dep
  from src where insee_com not in (select iso_code from fx_commune_ref)),
upserted as (select cast(id as bigint) as id, name, name_normalized, zone_type, cast(minx as double) as minx, cast(miny as double) as miny,
  cast(maxx as double) as maxx, cast(maxy as double) as maxy from refreshed
  union all select cast(id as bigint), name, name_normalized, zone_type, cast(minx as double), cast(miny as double), cast(maxx as double), cast(maxy as double) from ins)
"""
_UPSERT_FX = ("fx_commune_src", "fx_zone", "fx_commune", "fx_commune_ref", "fx_department")


@register("P2_upsert_collectivities", with_fixtures(_UPSERT_SQL + "select * from upserted", *_UPSERT_FX))
def q_upsert(spark, sf_dir):
    zones, _ = _upsert(Fixtures(spark, sf_dir))
    return zones.select("id", "name", "name_normalized", "zone_type", "minx", "miny", "maxx", "maxy")


@register("S17_geometry_match_new", with_fixtures(_UPSERT_SQL + """
select cast(u.id as bigint) as geozone_ptr_id, s.insee_com as code, d.geozone_ptr_id as parent_id
from upserted u join src s on s.minx = u.minx and s.miny = u.miny and s.maxx = u.maxx and s.maxy = u.maxy
left join fx_department d on d.insee_code = s.insee_dep
where u.zone_type = 'COMMUNE' and u.id not in (select geozone_ptr_id from fx_commune_ref)""", *_UPSERT_FX))
def q_geometry_match(spark, sf_dir):
    _, child = _upsert(Fixtures(spark, sf_dir))
    return child


@register("P2_upsert_departments", with_fixtures("""
with ins as (select (select max(id) from fx_zone) + row_number() over (order by insee_dep) as id, * from fx_department_src
  where insee_dep not in (select insee_code from fx_department))
select cast(id as bigint) as geozone_ptr_id, insee_dep as code, round((6378137.0 * radians(maxx) - 6378137.0 * radians(minx))
  * (6378137.0 * ln(tan(pi() / 4 + radians(maxy) / 2)) - 6378137.0 * ln(tan(pi() / 4 + radians(miny) / 2))) / 1e6, 3) as surface_km2
from ins""", "fx_zone", "fx_department", "fx_department_src"))
def q_upsert_departments(spark, sf_dir):
    """New department rows, matched by name, with their surface."""
    fx = Fixtures(spark, sf_dir)
    zones = _with_rings(fx.fx_zone.select(F.col("id").cast("long").alias("id"), "name", "name_normalized", "zone_type", *[F.lit(0.0).alias(c) for c in ("minx", "miny", "maxx", "maxy")]))
    src = _with_rings(fx.fx_department_src).select(F.col("insee_dep").alias("code"), F.col("nom").alias("name"), F.lit(None).cast("string").alias("parent_code"), "rings",
                                                   *[F.col(c).cast("double").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
    child = fx.fx_department.select(F.col("geozone_ptr_id").cast("long").alias("geozone_ptr_id"), F.col("insee_code").alias("code"))
    _, rows = loads.upsert_collectivities(zones, child, src, "DEPARTMENT", by="name")
    return rows.select("geozone_ptr_id", "code", F.round("surface_km2", 3).alias("surface_km2"))


def _custom(fx: Fixtures):
    zones = layers.box_layer(fx.fx_custom_zone, "id", keep=("name", "zone_type"))
    staging = layers.box_layer(fx.fx_custom_staging, "sid", keep=("name",)).withColumnRenamed("id", "sid")
    return loads.refresh_custom_geometry(zones, staging)


@register("P5_refresh_custom_geometry", with_fixtures("""
with st as (select * from (select *, row_number() over (partition by name order by sid) as rn from fx_custom_staging) where rn = 1)
select cast(z.id as bigint) as id, z.name, z.zone_type,
  cast(case when z.zone_type = 'CUSTOM' and st.sid is not null then st.minx else z.minx end as double) as minx,
  cast(case when z.zone_type = 'CUSTOM' and st.sid is not null then st.miny else z.miny end as double) as miny,
  cast(case when z.zone_type = 'CUSTOM' and st.sid is not null then st.maxx else z.maxx end as double) as maxx,
  cast(case when z.zone_type = 'CUSTOM' and st.sid is not null then st.maxy else z.maxy end as double) as maxy
from fx_custom_zone z left join st on st.name = z.name""", "fx_custom_zone", "fx_custom_staging"))
def q_refresh_custom(spark, sf_dir):
    return _custom(Fixtures(spark, sf_dir)).select("id", "name", "zone_type", "minx", "miny", "maxx", "maxy")


@register("P5_find_zones", with_fixtures("""
select name, cast(id as bigint) as id from fx_custom_zone where name ilike '%supplier#0000000_1%' and zone_type = 'CUSTOM'""", "fx_custom_zone"))
def q_find_zones(spark, sf_dir):
    return loads.find_zones(_custom(Fixtures(spark, sf_dir)), "%supplier#0000000_1%")


_Q1_FX = ("fx_detection", "fx_det_tagged", "fx_history", "fx_object", "fx_parcel", "fx_detdata", "fx_hist_object", "fx_custom_staging", "fx_custom_zone")


@register("Q1_constraint_report", with_fixtures(f"""
select 'fx_detection' as table_name, 'pk(id)' as rule, cast(count(*) - count(distinct id) + count(*) filter (where id is null) as bigint) as violations from fx_detection
union all select 'fx_det_tagged', 'pk(id)', cast((select count(*) from (select id from fx_det_tagged group by id having count(*) > 1)) as bigint)
union all select 'fx_history', 'pk(history_id)', cast((select count(*) from (select history_id from fx_history group by history_id having count(*) > 1)) as bigint)
union all select 'fx_object', 'fk(parcel_id -> fx_parcel.id)', cast(count(*) as bigint) from fx_object o where o.parcel_id is not null and o.parcel_id not in (select id from fx_parcel)
union all select 'fx_detdata', 'not_null(user_last_update_id)', cast(count(*) filter (where user_last_update_id is null) as bigint) from fx_detdata
union all select 'fx_hist_object', 'not_null(parcel_id)', cast(count(*) filter (where parcel_id is null) as bigint) from fx_hist_object
union all select 'fx_custom_staging', 'duplicates(name)', cast((select count(*) from (select name from fx_custom_staging group by name having count(*) > 1)) as bigint)
union all select 'fx_custom_staging', 'fk(name -> fx_custom_zone.name)', cast(count(*) as bigint) from fx_custom_staging where name not in (select name from fx_custom_zone)
union all select 'workflow_steps', 'unmapped(step_code -> workflow_mapping.step_code)', cast(count(*) as bigint) from {SQL_REVIEW_STEPS} s
  where s.step_code not in (select step_code from {SQL_MAPPING} m)
union all select 'workflow_steps', 'pk(step_code)', 0""", *_Q1_FX))
def q_constraint_report(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    rule = quality.Rule
    rules = [
        rule("pk", "fx_detection", ("id",)), rule("pk", "fx_det_tagged", ("id",)), rule("pk", "fx_history", ("history_id",)),
        rule("fk", "fx_object", ("parcel_id",), "fx_parcel", ("id",)), rule("not_null", "fx_detdata", ("user_last_update_id",)),
        rule("not_null", "fx_hist_object", ("parcel_id",)), rule("duplicates", "fx_custom_staging", ("name",)),
        rule("fk", "fx_custom_staging", ("name",), "fx_custom_zone", ("name",)),
        rule("unmapped", "workflow_steps", ("step_code",), "workflow_mapping", ("step_code",)), rule("pk", "workflow_steps", ("step_code",)),
    ]
    tables = {name: getattr(fx, name) for name in _Q1_FX}
    return quality.constraint_report(tables | {"workflow_steps": seeds.workflow_steps(spark), "workflow_mapping": seeds.status_mapping(spark)}, rules)


@register("S13_ingest_layer", with_fixtures("""
with good as (select * from fx_layer_box where srid = 4326 and maxx > minx and maxy > miny),
units as (select distinct x, y from good, lateral (select unnest(range(minx, maxx)) as x) a, lateral (select unnest(range(miny, maxy)) as y) b),
sides as (select x, y, dx, dy from units, (values (1, 0), (-1, 0), (0, 1), (0, -1)) d(dx, dy)),
open_sides as (select count(*) as n from sides s left join units u on u.x = s.x + dx and u.y = s.y + dy where u.x is null)
select 'study area' as name, cast(count(*) as double) as area, cast((select n from open_sides) as double) as perimeter,
  cast(min(x) as double) as minx, cast(min(y) as double) as miny, cast(max(x) + 1 as double) as maxx, cast(max(y) + 1 as double) as maxy,
  cast(count(*) as double) as ring_area from units""", "fx_layer_box"))
def q_ingest_layer(spark, sf_dir):
    """Overlapping boxes in both orientations, some without area; ``ring_area`` is measured on the assembled rings."""
    zone, _ = spatial.ingest_layer(_box_layers(Fixtures(spark, sf_dir)), "study area", cell=16.0)
    cols = ["area", "perimeter", "minx", "miny", "maxx", "maxy"]
    return zone.select("name", *[F.round(c, 6).alias(c) for c in cols], F.round(G.area("rings"), 6).alias("ring_area"))


@register("S13_quarantine", with_fixtures("""
select file, case when srid not in (4326, 0) then 'unsupported srid' when least(maxx - minx, maxy - miny) = 0 then 'invalid ring' end as reason
from fx_layer_box where srid not in (4326, 0) or least(maxx - minx, maxy - miny) = 0""", "fx_layer_box"))
def q_quarantine(spark, sf_dir):
    return spatial.ingest_layer(_box_layers(Fixtures(spark, sf_dir)), "study area", cell=16.0)[1]


def _box_layers(fx: Fixtures):
    """Every other box clockwise, as shapefiles have them."""
    rings = G.box_rings(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    return fx.fx_layer_box.select("file", "srid", F.when(F.col("id") % 2 == 0, rings).otherwise(F.transform(rings, lambda r: F.reverse(r))).alias("rings"))


@register("S14_zone_features", with_fixtures("""
with anchors as (select * from (values ('971', 51.0, -7.223655), ('972', 49.0, -7.223655), ('973', 47.0, -7.223655),
  ('974', 45.0, -7.223655), ('976', 43.0, -7.223655)) t(insee_code, lat, lon))
select cast(id as bigint) as id, name, insee_code, round(minx, 9) as minx, round(miny, 9) as miny, round(maxx, 9) as maxx, round(maxy, 9) as maxy
from fx_map_zone where insee_code not like '97%'
union all
select cast(z.id as bigint), z.name, z.insee_code, round(z.minx + (a.lon - (z.minx + z.maxx) / 2), 9), round(z.miny + (a.lat - (z.miny + z.maxy) / 2), 9),
  round(z.maxx + (a.lon - (z.minx + z.maxx) / 2), 9), round(z.maxy + (a.lat - (z.miny + z.maxy) / 2), 9)
from fx_map_zone z join anchors a on a.insee_code = z.insee_code where z.insee_code like '97%' and z.insee_code <> '973'""", "fx_map_zone"))
def q_zone_features(spark, sf_dir):
    f = _map_features(Fixtures(spark, sf_dir))
    return f.select(F.col("id").cast("long").alias("id"), "name", "insee_code", *[F.round(c, 9).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


def _map_features(fx: Fixtures):
    layer = layers.box_layer(fx.fx_map_zone, "id", keep=("name", "name_normalized", "insee_code"))
    return spatial.zone_features(layer.select("id", "name", "name_normalized", "insee_code", "rings"))


@register("S14_zone_features_geojson", with_fixtures("""
with anchors as (select * from (values ('971', 51.0, -7.223655), ('972', 49.0, -7.223655), ('973', 47.0, -7.223655),
  ('974', 45.0, -7.223655), ('976', 43.0, -7.223655)) t(insee_code, lat, lon)),
f as (select id, name, insee_code, minx as x0, miny as y0, maxx as x1, maxy as y1 from fx_map_zone where insee_code not like '97%'
  union all select z.id, z.name, z.insee_code, z.minx + (a.lon - (z.minx + z.maxx) / 2), z.miny + (a.lat - (z.miny + z.maxy) / 2),
    z.maxx + (a.lon - (z.minx + z.maxx) / 2), z.maxy + (a.lat - (z.miny + z.maxy) / 2)
  from fx_map_zone z join anchors a on a.insee_code = z.insee_code where z.insee_code like '97%' and z.insee_code <> '973')
select cast(id as bigint) as feature_id, cast(id as bigint) as prop_id, name, insee_code, 'Polygon' as kind, cast(1 as int) as n_rings, cast(5 as int) as n_points,
  round(x0, 6) as minx, round(y0, 6) as miny, round(x1, 6) as maxx, round(y1, 6) as maxy from f""", "fx_map_zone"))
def q_zone_features_geojson(spark, sf_dir):
    """The GeoJSON text read back."""
    doc = F.from_json("geojson", "struct<id:long,geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<id:long,name:string,insee_code:string>>")
    f = _map_features(Fixtures(spark, sf_dir)).select(doc.alias("d"))
    ring = F.col("d.geometry.coordinates")[0]
    side = lambda agg, k: F.round(agg(F.transform(ring, lambda p: p[k])), 6)
    return f.select(
        F.col("d.id").alias("feature_id"), F.col("d.properties.id").alias("prop_id"), F.col("d.properties.name").alias("name"),
        F.col("d.properties.insee_code").alias("insee_code"), F.col("d.geometry.type").alias("kind"),
        F.size("d.geometry.coordinates").alias("n_rings"), F.size(ring).alias("n_points"),
        side(F.array_min, 0).alias("minx"), side(F.array_min, 1).alias("miny"), side(F.array_max, 0).alias("maxx"), side(F.array_max, 1).alias("maxy"),
    )


# ---------------------------------------------------------------- queries kept by theme
from vigie.registered import cases, shapes, tables, zones  # noqa: E402, F401
