"""Cohort statistics and KPIs over tagged detections.

Design: the reference computes each (zone, year) stock, new and cleared count in its own CTE, i.e. one scan and often a
self join per figure. Here every figure comes from one *presence* table: ``groupBy(zone, parcel)`` with one flag per
survey year (one shuffle, map-side partial aggregation), followed by one ``groupBy(zone)`` that derives all stocks,
new and cleared counts of every period at once. A hot zone or hot parcel is absorbed by the partial aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.plans.nulls import not_in

# Fixed values of the studied reports (must equal the reference's for equal results):
# estimate correction: model precision 0.705, bias 0.252
CORRECTION_PRECISION = "0.705"
CORRECTION_BIAS = "0.252"
# survey periods of the EPCI report: (label, start year, end year)
EPCI_PERIODS = [("2021-2023", 2021, 2024), ("2018-2020", 2018, 2021), ("2015-2017", 2015, 2018)]
# survey periods of the commune report: (label, start, end, baseline years of "new", PV year range)
COMMUNE_PERIODS = [
    ("2021-2023", 2021, 2024, (2021, 2018), (2021, 2023)),
    ("2018-2020", 2018, 2021, (2018,), (2018, 2020)),
]

ZONE = "geozone_id"
YEAR = "batch_year"
PARCEL = "id_parcellaire"


def _flag(year: int) -> str:
    return f"in_{year}"


#: Column of a stored state (``presence``) in which bit ``year - BASE_YEAR`` says whether the parcel was seen in that survey.
MASK, BASE_YEAR, LAST_YEAR = "survey_mask", 2000, 2062


def survey_bit(year: int) -> int:
    if not BASE_YEAR <= year <= LAST_YEAR:
        raise ValueError(f"survey years lie between {BASE_YEAR} and {LAST_YEAR}, not {year}")
    return 1 << (year - BASE_YEAR)


def _seen(year: int) -> Column:
    return F.col(MASK).bitwiseAND(F.lit(survey_bit(year)).cast("long")) != 0


def parcel_presence(det: DataFrame, years, keep_null_parcels: bool = False) -> DataFrame:
    """One row per (zone, parcel) with an int flag per survey year; the only shuffle of the cohort reports.

    ``det`` is the detections, or a stored state of them (``presence.presence_state``), which needs no shuffle.
    """
    years = sorted(set(years))
    if MASK in det.columns:
        rows = det.where(F.col(MASK).bitwiseAND(F.lit(sum(survey_bit(y) for y in years)).cast("long")) != 0)
        if not keep_null_parcels:
            rows = rows.where(F.col(PARCEL).isNotNull())
        return rows.select(ZONE, PARCEL, *[_seen(y).cast("int").alias(_flag(y)) for y in years])
    d = det.select(ZONE, YEAR, PARCEL).where(F.col(YEAR).isin(years))
    if not keep_null_parcels:
        d = d.where(F.col(PARCEL).isNotNull())
    return d.groupBy(ZONE, PARCEL).agg(*[F.max((F.col(YEAR) == y).cast("int")).alias(_flag(y)) for y in years])


def _none_of(years) -> Column:
    """No presence flag set among ``years``."""
    cond = F.lit(True)
    for y in years:
        cond = cond & (F.col(_flag(y)) == 0)
    return cond


def _count_parcels(cond: Column) -> Column:
    """Distinct non-null parcels of a zone meeting ``cond`` (rows are already distinct per parcel)."""
    return F.sum(F.when(F.col(PARCEL).isNotNull() & cond, 1).otherwise(0)).cast("long")


def stock_by_year(det: DataFrame, years=None, drop_null: bool = False) -> DataFrame:
    """Distinct parcels per (zone, year).

    drop_null=False (commune variant): a zone whose rows of a year all lack a parcel yields 0.
    drop_null=True (EPCI variant): NULL parcels are dropped first, so such a zone yields no row.
    """
    if MASK in det.columns:
        every = range(BASE_YEAR, LAST_YEAR + 1) if years is None else sorted(set(years))
        seen = F.filter(F.array(*[F.when(_seen(y), F.lit(y)) for y in every]), lambda y: y.isNotNull())
        det = det.select(ZONE, PARCEL, F.explode(seen).alias(YEAR))
    d = det.select(ZONE, YEAR, PARCEL)
    if years is not None:
        d = d.where(F.col(YEAR).isin(list(years)))
    if drop_null:
        d = d.where(F.col(PARCEL).isNotNull())
    return d.groupBy(ZONE, YEAR).agg(F.countDistinct(PARCEL).alias("nb_parcels"))


def new_parcels(det: DataFrame, year: int, baseline) -> DataFrame:
    """C4: parcels present in ``year`` and absent from every baseline year, per zone (NULL parcels never count)."""
    baseline = list(baseline)
    p = parcel_presence(det, [year, *baseline])
    absent = _none_of(baseline)
    return (
        p.groupBy(ZONE)
        .agg(_count_parcels((F.col(_flag(year)) == 1) & absent).alias("nb_new_parcels"))
        .where(F.col("nb_new_parcels") > 0)
    )


def cleared_parcels(det: DataFrame, start: int, end: int) -> DataFrame:
    """Parcels present in ``start`` and absent in ``end`` in the same zone."""
    p = parcel_presence(det, [start, end])
    return (
        p.groupBy(ZONE)
        .agg(_count_parcels((F.col(_flag(start)) == 1) & (F.col(_flag(end)) == 0)).alias("nb_cleared_parcels"))
        .where(F.col("nb_cleared_parcels") > 0)
    )


def _period_rows(per_zone: DataFrame, periods: list[tuple], cols: dict[str, callable]) -> DataFrame:
    """Turn one wide row per zone into one row per (zone, period) with ``inline`` (no join, no extra scan)."""
    structs = []
    for p in periods:
        structs.append(F.struct(*[fn(p).alias(name) for name, fn in cols.items()]))
    return per_zone.select(ZONE, F.inline(F.array(*structs)))


def evolution_epci(det: DataFrame, zones: DataFrame, parcel_stats: DataFrame, periods=EPCI_PERIODS) -> DataFrame:
    """Per zone and period, start stock, end stock, new and cleared parcels (coalesced to 0), plus parcel totals.

    Driven by the start-year stock: zones with no non-null parcel in the start year give no row (UNION ALL of periods).
    ``zones``: (id, name_normalized); ``parcel_stats``: output of ``parcels_at_risk`` (geozone_id, nb_parcels, nb_parcels_in_ze).
    """
    years = sorted({y for _, a, b in periods for y in (a, b)})
    p = parcel_presence(det, years)
    aggs = [F.sum(F.col(_flag(y))).cast("long").alias(f"stock_{y}") for y in years]
    for _, a, b in periods:
        aggs.append(F.sum(F.when((F.col(_flag(b)) == 1) & (F.col(_flag(a)) == 0), 1).otherwise(0)).cast("long").alias(f"new_{a}_{b}"))
        aggs.append(F.sum(F.when((F.col(_flag(a)) == 1) & (F.col(_flag(b)) == 0), 1).otherwise(0)).cast("long").alias(f"clr_{a}_{b}"))
    per_zone = p.groupBy(ZONE).agg(*aggs)
    rows = _period_rows(
        per_zone,
        periods,
        {
            "situation_parcelles_cabanisees_debut_periode": lambda p: F.col(f"stock_{p[1]}"),
            "situation_parcelles_cabanisees_fin_periode": lambda p: F.col(f"stock_{p[2]}"),
            "situation_nouvelles_parcelles_cabanisees_periode": lambda p: F.col(f"new_{p[1]}_{p[2]}"),
            "situation_parcelles_remises_en_etat_periode": lambda p: F.col(f"clr_{p[1]}_{p[2]}"),
            "periode": lambda p: F.lit(p[0]),
        },
    ).where(F.col("situation_parcelles_cabanisees_debut_periode") > 0)
    names = zones.select(F.col("id").alias(ZONE), "name_normalized")
    spa = parcel_stats.select(ZONE, "nb_parcels", "nb_parcels_in_ze")
    return (
        rows.join(names, ZONE, "left")
        .join(spa, ZONE, "left")
        .select(
            "name_normalized",
            ZONE,
            "situation_parcelles_cabanisees_debut_periode",
            "situation_parcelles_cabanisees_fin_periode",
            "situation_nouvelles_parcelles_cabanisees_periode",
            "situation_parcelles_remises_en_etat_periode",
            "periode",
            F.coalesce("nb_parcels", F.lit(0)).cast("long").alias("nb_parcels"),
            F.coalesce("nb_parcels_in_ze", F.lit(0)).cast("long").alias("nb_parcels_in_ze"),
        )
    )


COUNT_COLUMNS = (
    "situation_parcelles_cabanisees_debut_periode",
    "situation_parcelles_cabanisees_fin_periode",
    "situation_nouvelles_parcelles_cabanisees_periode",
    "situation_parcelles_remises_en_etat_periode",
)


def corrected_count(c: Column, precision: str = CORRECTION_PRECISION, bias: str = CORRECTION_BIAS) -> Column:
    """floor(n × precision × (1 − bias)) in exact decimal arithmetic, as bigint."""
    factor = F.lit(Decimal(precision)) * (F.lit(Decimal(1)) - F.lit(Decimal(bias)))
    return F.floor(c.cast("decimal(20,0)") * factor).cast("long")


def corrected_estimates(evo: DataFrame, precision: str = CORRECTION_PRECISION, bias: str = CORRECTION_BIAS,
                        columns=COUNT_COLUMNS) -> DataFrame:
    """Apply the estimate correction to the four counts of an evolution report (other columns unchanged)."""
    return evo.select(*[corrected_count(F.col(c), precision, bias).alias(c) if c in columns else F.col(c) for c in evo.columns])


def pv_by_period(pv: DataFrame, start: int, end: int, name: str = "nb_pv_period") -> DataFrame:
    """Sum of reports per zone over [start, end]; zones with reports only outside the range give 0."""
    return pv.groupBy(ZONE).agg(
        F.sum(F.when(F.col("year").between(start, end), F.col("nb_pv")).otherwise(0)).cast("long").alias(name)
    )


# Zone ids of the commune report with no engagement, and the department with its own label.
NO_ENGAGEMENT_IDS = [278, 171, 259, 195, 261, 138, 313, 281, 330, 118, 255, 111, 288, 226, 248]
ENGAGEMENT_DEPARTMENT = "gard"
# Labels of the report; pass your own to ``engagement_group``.
ENGAGEMENT_LABELS = {
    "department": "suivi départemental",
    "none": "sans engagement",
    "2021-2023": "suivi outillé",
    "2018-2020": "suivi sans outil",
}


def engagement_group(department_name: Column, zone_id: Column, period: str, check_department: bool,
                     no_engagement_ids=NO_ENGAGEMENT_IDS, labels: dict[str, str] = ENGAGEMENT_LABELS) -> Column:
    """Engagement label of a commune for one report period."""
    expr = F.when(zone_id.isin(list(no_engagement_ids)), F.lit(labels["none"])).otherwise(F.lit(labels[period]))
    if check_department:
        expr = F.when(department_name == ENGAGEMENT_DEPARTMENT, F.lit(labels["department"])).otherwise(expr)
    return expr


def evolution_commune(pv: DataFrame, det: DataFrame, mapping: DataFrame, parcel_stats: DataFrame,
                      periods=COMMUNE_PERIODS) -> DataFrame:
    """Commune report per period, driven by the zones of the report log (``pv``: geozone_id, year, nb_pv).

    Start/end stocks count distinct parcels of zones having rows that year (NULL-only → 0, no rows → NULL);
    new/cleared are NULL when there are none; rows without a start stock are removed; periods are UNION-ed distinct.
    """
    years = sorted({y for p in periods for y in (p[1], p[2], *p[3])})
    p = parcel_presence(det, years, keep_null_parcels=True)
    aggs = []
    for y in years:
        aggs.append(F.max(F.col(_flag(y))).alias(f"rows_{y}"))
        aggs.append(_count_parcels(F.col(_flag(y)) == 1).alias(f"cnt_{y}"))
    for label, a, b, base, _ in periods:
        absent = _none_of(base)
        aggs.append(_count_parcels((F.col(_flag(b)) == 1) & absent).alias(f"new_{label}"))
        aggs.append(_count_parcels((F.col(_flag(a)) == 1) & (F.col(_flag(b)) == 0)).alias(f"clr_{label}"))
    per_zone = p.groupBy(ZONE).agg(*aggs)

    def stock(y):
        return F.when(F.col(f"rows_{y}") == 1, F.col(f"cnt_{y}"))

    def nonzero(c):
        return F.when(F.col(c) > 0, F.col(c))

    pv_sums = pv.groupBy(ZONE).agg(
        *[F.sum(F.when(F.col("year").between(r[0], r[1]), F.col("nb_pv")).otherwise(0)).cast("long").alias(f"pv_{label}")
          for label, _, _, _, r in periods]
    )
    m = mapping.select(F.col("id").alias(ZONE), F.col("id").alias("_map_id"), "department_name", "geozone_code")
    spa = parcel_stats.select(ZONE, "nb_parcels", "nb_parcels_in_ze")
    base = pv_sums.join(per_zone, ZONE, "left").join(m, ZONE, "left").join(spa, ZONE, "left")
    # one row per period from one pass over ``base``
    rows = F.inline(F.array(*[
        F.struct(
            F.col(f"pv_{label}").alias("nb_pv_period"),
            stock(a).alias("situation_parcelles_cabanisees_debut_periode"),
            stock(b).alias("situation_parcelles_cabanisees_fin_periode"),
            nonzero(f"new_{label}").alias("situation_nouvelles_parcelles_cabanisees_periode"),
            nonzero(f"clr_{label}").alias("situation_parcelles_remises_en_etat_periode"),
            engagement_group(F.col("department_name"), F.col("_map_id"), label, check_department=(i == 0)).alias("groupe"),
            F.lit(label).alias("periode"),
        )
        for i, (label, a, b, _, _) in enumerate(periods)
    ]))
    out = base.select(
        "department_name", "geozone_code", F.col(ZONE).cast("long").alias(ZONE),
        F.col("nb_parcels").cast("long").alias("nb_parcels"), F.col("nb_parcels_in_ze").cast("long").alias("nb_parcels_in_ze"), rows,
    )
    return out.where(F.col("situation_parcelles_cabanisees_debut_periode").isNotNull()).distinct()


def class_evolution(det: DataFrame, years=(2018, 2021, 2024)) -> DataFrame:
    """Detections per (year, class) for the selected survey years."""
    return det.where(F.col(YEAR).isin(list(years))).groupBy(YEAR, "object_type").agg(F.count(F.lit(1)).alias("nb_detections"))


def unprescribed_parcels(hist: DataFrame, year: int | None = None, min_year: int = 2018,
                         precision: str = CORRECTION_PRECISION, bias: str = CORRECTION_BIAS) -> DataFrame:
    """C11 over ``prescribed_by_history`` output.

    year given: the list of (year, parcel) with no ≥6-year history in that year (the spot-check list);
    year None: per survey year > ``min_year``, the corrected count of such parcels, rounded half away from zero.
    """
    per = hist.groupBy(YEAR, PARCEL).agg(F.sum("count_histo_6y_detection").cast("long").alias("nb_prescripted_detection"))
    zero = per.where(F.col("nb_prescripted_detection") == 0)
    if year is not None:
        return zero.where(F.col(YEAR) == year).select(YEAR, PARCEL, "nb_prescripted_detection")
    factor = F.lit(Decimal(precision)) * (F.lit(Decimal(1)) - F.lit(Decimal(bias)))
    return (
        zero.where(F.col(YEAR) > min_year)
        .groupBy(YEAR)
        .agg(F.round(F.countDistinct(PARCEL).cast("decimal(20,0)") * factor, 0).cast("long").alias("nb_unprescripted_parcels"))
    )


SCORE_COLUMNS = [
    "score_commune_potentiel_cabanisation",
    "score_action_cabanisation",
    "score_action_parcel",
    "score_etat_cabanisation",
    "score_nouvelles_cabanisation",
    "score_remises_en_etat",
    "score_evolution_cabanisation",
]


def zone_scores(wide: DataFrame) -> DataFrame:
    """C17: the seven ratios per zone. Division by zero or NULL gives NULL (``try_divide``), not inf/NaN.

    ``wide``: geozone_id, nb_parcels, nb_parcels_in_ze, nb_pv_2018_2020, nb_pv_2021_2023, stock_2021, stock_2024,
    new_2024, cleared_2024 (the commune report pivoted by period).
    """
    d = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    c = F.col
    pv = c("nb_pv_2021_2023") + c("nb_pv_2018_2020")
    return wide.select(
        ZONE,
        d(c("nb_parcels_in_ze"), c("nb_parcels")).alias(SCORE_COLUMNS[0]),
        d(pv, c("stock_2021")).alias(SCORE_COLUMNS[1]),
        d(pv, c("nb_parcels_in_ze")).alias(SCORE_COLUMNS[2]),
        d(c("stock_2021"), c("nb_parcels_in_ze")).alias(SCORE_COLUMNS[3]),
        d(c("new_2024"), c("nb_parcels_in_ze")).alias(SCORE_COLUMNS[4]),
        d(c("cleared_2024"), c("nb_parcels_in_ze")).alias(SCORE_COLUMNS[5]),
        d(c("stock_2024") - c("stock_2021"), c("nb_parcels_in_ze")).alias(SCORE_COLUMNS[6]),
    )


def commune_report_wide(parcel_stats: DataFrame, evo_commune: DataFrame, pv: DataFrame) -> DataFrame:
    """Input of C17: parcel statistics left-joined to the commune report's 2021-2023 row and both PV period sums."""
    late = evo_commune.where(F.col("periode") == "2021-2023").select(
        ZONE,
        F.col("situation_parcelles_cabanisees_debut_periode").alias("stock_2021"),
        F.col("situation_parcelles_cabanisees_fin_periode").alias("stock_2024"),
        F.col("situation_nouvelles_parcelles_cabanisees_periode").alias("new_2024"),
        F.col("situation_parcelles_remises_en_etat_periode").alias("cleared_2024"),
    )
    sums = pv.groupBy(ZONE).agg(
        F.sum(F.when(F.col("year").between(2018, 2020), F.col("nb_pv")).otherwise(0)).cast("long").alias("nb_pv_2018_2020"),
        F.sum(F.when(F.col("year").between(2021, 2023), F.col("nb_pv")).otherwise(0)).cast("long").alias("nb_pv_2021_2023"),
    )
    return parcel_stats.select(ZONE, "nb_parcels", "nb_parcels_in_ze").join(late, ZONE, "left").join(sums, ZONE, "left")


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r; NULL (not an ANSI error) when a column has no variance."""
    sa = F.stddev_pop(F.when(b.isNotNull(), a))
    sb = F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), sa * sb)


def score_correlation(scores: DataFrame, cols=SCORE_COLUMNS) -> DataFrame:
    """Pairwise-complete Pearson matrix as (a, b, r); one ``agg`` holds every pair, ``stack`` makes rows.

    NaN/inf cannot occur (scores use ``try_divide``); NULL pairs are skipped by ``corr``.
    """
    cols = list(cols)
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [F.round(pearson(F.col(a), F.col(b)), 9).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = scores.agg(*aggs)
    stack = "stack({n}, {items}) as (a, b, r)".format(
        n=len(pairs), items=", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    )
    return wide.selectExpr(stack)


# ---------------------------------------------------------------- review status KPIs
# Review statuses and the validity rule of reviewable detections.
SUSPECT, LEGITIMATE, DNV, PRESCRIBED = "SUSPECT", "LEGITIMATE", "DETECTED_NOT_VERIFIED", "PRESCRIBED"
STATUS_CLASSES = ["Construction en dur", "Piscine", "Mobil-home", "Caravane", "Installation Legere"]


def reviewable(score: Column, validation: Column, prescription: Column, min_score: Column) -> Column:
    """SUSPECT, or LEGITIMATE, or (DETECTED_NOT_VERIFIED and score > threshold and not PRESCRIBED)."""
    not_prescribed = prescription.isNull() | (prescription != PRESCRIBED)
    return (validation == SUSPECT) | (validation == LEGITIMATE) | ((validation == DNV) & (score > min_score) & not_prescribed)


def parcel_status(detections: DataFrame, data: DataFrame, objects: DataFrame, types: DataFrame, zone_names: DataFrame,
                  in_risk: DataFrame, thresholds: DataFrame, classes=STATUS_CLASSES) -> DataFrame:
    """Per (tileset, commune), distinct parcels having suspect / not-verified / legitimate reviewable detections,
    and parcels without suspect but with one of the other two.

    ``in_risk``: ids of detections within at least one risk zone (S1 filter form). ``thresholds``: (tile_set_id,
    min_score) — a tileset absent from it is not reported.
    """
    d = (
        detections.select("id", "tile_set_id", "score", "detection_data_id", "detection_object_id")
        .join(thresholds, "tile_set_id")
        .join(in_risk, "id", "left_semi")
        .join(data.select(F.col("id").alias("detection_data_id"), "detection_validation_status", "detection_prescription_status"),
              "detection_data_id", "left")
        .join(objects.select(F.col("id").alias("detection_object_id"), "object_type_id", "parcel_id", "commune_id"), "detection_object_id", "left")
        .join(types.select(F.col("id").alias("object_type_id"), F.col("name_n").alias("type_name")), "object_type_id", "left")
        .where(F.col("type_name").isin(list(classes)))
        .where(reviewable(F.col("score"), F.col("detection_validation_status"), F.col("detection_prescription_status"), F.col("min_score")))
    )
    v = F.col("detection_validation_status")
    flags = d.groupBy("tile_set_id", "commune_id", "parcel_id").agg(
        F.bool_or(v == SUSPECT).alias("has_suspect"), F.bool_or(v == LEGITIMATE).alias("has_legitimate"), F.bool_or(v == DNV).alias("has_dnv")
    )
    names = zone_names.select(F.col("id").alias("commune_id"), F.col("name").alias("commune_name"))

    def cnt(cond):  # ``flags`` has one row per parcel, so counting rows counts parcels
        return F.sum((cond & F.col("parcel_id").isNotNull()).cast("long")).alias

    return flags.join(names, "commune_id", "left").groupBy("commune_name", "tile_set_id", "commune_id").agg(
        cnt(F.col("has_suspect"))("parcels_with_suspect"),
        cnt(F.col("has_dnv"))("parcels_with_dnv"),
        cnt(F.col("has_legitimate"))("parcels_with_legit"),
        cnt(~F.col("has_suspect") & (F.col("has_legitimate") | F.col("has_dnv")))("parcels_with_legit_and_dnv_no_suspect"),
    )


def yearly_average_status(detections: DataFrame, data: DataFrame, objects: DataFrame, communes: DataFrame, column: str,
                          value: str, tileset: int, year: int, span: int = 3, name: str = "nb_status_updates") -> DataFrame:
    """Detections per commune of one tileset whose ``column`` equals ``value``, integer-divided by the survey
    interval ``span`` and stamped with ``year``. ``communes``: the selected communes (geozone_ptr_id)."""
    d = (
        detections.where(F.col("tile_set_id") == tileset)
        .join(data.select(F.col("id").alias("detection_data_id"), column), "detection_data_id")
        .where(F.col(column) == value)
        .join(objects.select(F.col("id").alias("detection_object_id"), "commune_id"), "detection_object_id")
        .join(communes.select(F.col("geozone_ptr_id").alias("commune_id")), "commune_id", "left_semi")
    )
    return d.groupBy(F.col("commune_id").alias("geozone_id")).agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("geozone_id").cast("long").alias("geozone_id"), F.lit(year).alias("year"), F.floor(F.col("_n") / span).cast("long").alias(name)
    )


def parcels_per_department(parcels: DataFrame, communes: DataFrame, departments: DataFrame, zones: DataFrame) -> DataFrame:
    """C14: parcels per department (name, insee code) through parcel → commune → department → zone."""
    return (
        parcels.select("commune_id")
        .join(communes.select(F.col("geozone_ptr_id").alias("commune_id"), "department_id"), "commune_id")
        .join(departments.select(F.col("geozone_ptr_id").alias("department_id"), "insee_code"), "department_id")
        .join(zones.select(F.col("id").alias("department_id"), "name"), "department_id")
        .groupBy("name", "insee_code")
        .agg(F.count(F.lit(1)).alias("nb_parcels"))
    )


# Fixed values of the deployment report: a group re-assigned to a department by name, an excluded zone, planned
# departments reported with 0 when absent.
REASSIGNED_GROUP = ("Cabanisation Pic Saint Loup", "34", 2)
EXCLUDED_ZONE = 1613
PLANNED_DEPARTMENTS = [1540, 1547, 1551, 1580, 36156]


def deployment_by_department(groups: DataFrame, planned: DataFrame) -> DataFrame:
    """Distinct collectivity groups per department, plus planned departments with 0 that are NOT IN the result.

    ``groups``: (name, user_group_type, geozone_id, dep_geozone_id) — user groups left-joined to their zones and the
    zones' departments. The NOT IN is null-aware (SQL semantics): one NULL department in the aggregate removes every
    planned row (``plans.nulls.not_in``).
    """
    name, _, dep_id = REASSIGNED_GROUP
    deployed = groups.where(
        F.col("geozone_id").isNotNull() & (F.col("user_group_type") == "COLLECTIVITY") & (F.col("geozone_id") != EXCLUDED_ZONE)
    ).select("name", F.when(F.col("name") == name, F.lit(dep_id)).otherwise(F.col("dep_geozone_id")).cast("long").alias("dep_geozone_id"))
    agg = deployed.groupBy("dep_geozone_id").agg(F.countDistinct("name").alias("nb_collectivity"))
    extra = not_in(planned.select(F.col("dep_geozone_id").cast("long").alias("dep_geozone_id"), F.col("nb_collectivity").cast("long").alias("nb_collectivity")),
                   "dep_geozone_id", agg, "dep_geozone_id")
    return agg.select("dep_geozone_id", F.col("nb_collectivity").cast("long")).unionByName(extra)


# Deployment state buckets and their map colours.
STATE_COLORS = {
    "Non planifié": "#f0f0f0",
    "Déploiements à venir": "#ffcc99",
    "Communes pilotes": "#cceeff",
    "Généralisation en cours": "#99ddff",
    "Généralisation avancée": "#3399ff",
}
DEFAULT_COLOR = "#ffffff"


def deployment_state(coords: DataFrame, deployment: DataFrame, features: DataFrame) -> DataFrame:
    """Per department feature: deployed count (−1 when not planned), state bucket, colour and label text.

    ``coords``: (id, lat, lon) from ``zone_centroids``; ``deployment``: C15 output; ``features``: (id, name), inner join.
    """
    n = F.col("nb_collectivity")
    state = (
        F.when(n.isNull(), "Non planifié").when(n == 0, "Déploiements à venir").when((n > 0) & (n < 3), "Communes pilotes")
        .when((n >= 3) & (n <= 5), "Généralisation en cours").otherwise("Généralisation avancée")
    )
    color = F.coalesce(F.create_map(*[x for kv in STATE_COLORS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[state], F.lit(DEFAULT_COLOR))
    nb = F.coalesce(n, F.lit(-1)).cast("long")
    d = coords.select(F.col("id").alias("dep_geozone_id"), "lat", "lon").join(deployment, "dep_geozone_id", "left")
    d = d.select("dep_geozone_id", nb.alias("nb_collectivity"), state.alias("deployment_state"), color.alias("color"), "lat", "lon")
    f = features.select(F.col("id").alias("dep_geozone_id"), "name")
    out = f.join(d, "dep_geozone_id")
    label = F.when(F.col("nb_collectivity") > -1, F.when(F.col("nb_collectivity") == 0, F.col("name"))
                   .otherwise(F.concat(F.col("name"), F.lit(" : "), F.col("nb_collectivity").cast("string")))).otherwise(F.lit(""))
    return out.withColumn("label", label)
