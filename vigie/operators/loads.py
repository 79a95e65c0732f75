"""Reference-data loads and retention jobs (P1–P7) as idempotent DataFrame transformations.

Each function returns the rows to write; sinks live in ``vigie.sources.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.functions.geo import RINGS_TYPE
from vigie.functions.text import canonical_commune, parse_strict_timestamp, repair_short_date, upper_dash
from vigie.plans.ids import surrogate_ids

PV_STATUS = "PV dressé"


def pv_grouped(log: DataFrame, communes: DataFrame, department_id: int = 2, status: str = PV_STATUS) -> DataFrame:
    """P4 before numbering: (commune_key, code_insee, year, nb_pv, geozone_id) of the enforcement-report log.

    ``log``: commune, code_insee, date_raw, status. ``communes``: geozone_ptr_id, name_normalized, department_id.
    Dates ``d/m/yy`` are repaired, unparsable ones dropped; names canonicalized; only ``status`` rows counted by
    (commune, code, year) with NULL keys dropped (pandas ``groupby`` semantics); left join to the communes of one
    department on the upper-dash normalized name.
    """
    ts = parse_strict_timestamp(repair_short_date(F.col("date_raw")))
    rows = (
        log.select(canonical_commune(F.col("commune")).alias("commune_key"), "code_insee", F.year(ts).alias("year"), "status")
        .where(F.col("year").isNotNull() & (F.col("status") == status))
        .where(F.col("commune_key").isNotNull() & F.col("code_insee").isNotNull())
        .groupBy("commune_key", "code_insee", "year")
        .agg(F.count(F.lit(1)).alias("nb_pv"))
    )
    dep = communes.where(F.col("department_id") == department_id).select(
        F.col("geozone_ptr_id").alias("geozone_id"), upper_dash(F.col("name_normalized")).alias("commune_key")
    )
    joined = rows.join(dep, "commune_key", "left")
    return joined.select("commune_key", "code_insee", F.col("year").cast("int").alias("year"), F.col("nb_pv").cast("long").alias("nb_pv"), "geozone_id")


def pv_counts(log: DataFrame, communes: DataFrame, department_id: int = 2, first_id: int = 55, status: str = PV_STATUS) -> DataFrame:
    """The rows of ``pv_grouped`` numbered from ``first_id`` in key order: (id, geozone_id, year, nb_pv)."""
    with_ids = surrogate_ids(
        pv_grouped(log, communes, department_id, status),
        [F.col("commune_key"), F.col("code_insee"), F.col("year"), F.col("geozone_id").asc_nulls_last()],
        name="id", offset=first_id,
    )
    return with_ids.select("id", "geozone_id", "year", "nb_pv")


# ---------------------------------------------------------------- P1: legacy extract
# Control status codes, dataset → batch label of the legacy database.
LEGACY_CONTROL = {1: "NOT_CONTROLLED", 2: "SIGNALED_COMMUNE", 3: "SIGNALED_COLLECTIVITY", 4: "CONTROLLED_FIELD", 5: "REHABILITATED", 6: "VERBALIZED"}
LEGACY_BATCH = {7: "sia_2012", 4: "sia_2015", 5: "sia_2018", 8: "sia_2021"}


def legacy_detections(det: DataFrame, types: DataFrame, tiles: DataFrame) -> DataFrame:
    """Legacy detections → application detection rows, sorted by score descending (NULLs first), then id (most scores
    are 1.0, so the id lets the sort split them).

    score 1 when drawn by hand or missing; control: field flag wins, then codes 1–6, else NULL; validation by ordered
    three-valued rules; class from the type id, or from the validation id when validated; dataset → batch label;
    only the four known datasets.
    """
    c = F.col
    control = F.when(c("signale_terrain"), "CONTROLLED_FIELD")
    for code, label in LEGACY_CONTROL.items():
        control = control.when(c("control_status_id") == code, label)
    vl, vp, fp = c("vrai_legitime"), c("vrai_positif"), c("faux_positif")
    real = vp & ~fp
    validation = (
        F.when((c("validation") == 0) | (~vl & ~vp & fp), "INVALIDATED")
        .when(real & vl, "LEGITIMATE")
        .when(real & ~vl, "SUSPECT")
        .otherwise("DETECTED_NOT_VERIFIED")
    )
    batch = None
    for ds, label in LEGACY_BATCH.items():
        batch = (F.when if batch is None else batch.when)(c("dataset_id") == ds, label)
    type_key = F.when(c("validation").isNull() | (c("validation") == 0), c("type_id")).otherwise(c("validation"))
    d = det.withColumn("_type", type_key).join(types.select(F.col("id").alias("_type"), "name_n"), "_type") \
        .join(tiles.select(F.col("id").alias("tile_id"), "dataset_id"), "tile_id").where(c("dataset_id").isin(list(LEGACY_BATCH)))
    out = d.select(
        "id",
        F.when(c("dessine_interface"), F.lit(1.0)).when(c("score").isNull(), F.lit(1.0)).otherwise(c("score")).alias("score"),
        F.lit(None).cast("string").alias("address"),
        c("name_n").alias("object_type"),
        F.when(c("dessine_interface"), "INTERFACE_DRAWN").otherwise("ANALYSIS").alias("detection_source"),
        control.alias("detection_control_status"),
        validation.alias("detection_validation_status"),
        F.when(c("prescrit_manuel"), "PRESCRIBED").otherwise("NOT_PRESCRIBED").alias("detection_prescription_status"),
        c("validation").isNotNull().alias("user_reviewed"),
        F.lit(None).cast("long").alias("tile_x"),
        F.lit(None).cast("long").alias("tile_y"),
        batch.alias("batch_id"),
        (c("rings") if "rings" in det.columns else F.lit(None).cast(RINGS_TYPE)).alias("geometry"),
    )
    return out.orderBy(F.col("score").desc_nulls_first(), "id")


# ---------------------------------------------------------------- P3: parcel load
def load_parcels(raw: DataFrame, communes: DataFrame, refreshed_at: str = "2025-01-01") -> DataFrame:
    """Department parcel rows → parcel table rows.

    Commune by ``code_dep || code_com`` = commune iso code (unmatched rows dropped); number without leading zeros as
    int; contenance defaults to 0; constant flags and refresh date; ``created_at``/``uuid`` are generated per run.
    """
    c = F.col
    key = F.concat(c("code_dep"), c("code_com"))
    d = raw.join(communes.select(c("iso_code"), c("geozone_ptr_id").alias("commune_id")), key == c("iso_code"))
    return d.select(
        F.lit(False).alias("arpente"),
        "commune_id",
        F.coalesce(c("contenance"), F.lit(0)).cast("long").alias("contenance"),
        F.current_timestamp().alias("created_at"),
        F.lit(False).alias("deleted"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        (c("rings") if "rings" in raw.columns else F.lit(None).cast(RINGS_TYPE)).alias("geometry"),
        c("idu").alias("id_parcellaire"),
        F.expr("cast(trim(leading '0' from numero) as int)").alias("num_parcel"),
        (c("com_abs") if "com_abs" in raw.columns else F.lit(None).cast("string")).alias("prefix"),
        F.to_date(F.lit(refreshed_at)).alias("refreshed_at"),
        "section",
        F.current_timestamp().alias("updated_at"),
        F.expr("uuid()").alias("uuid"),
    )


# ---------------------------------------------------------------- P6 / P7: batch purge and orphan cascade
def orphan_cascade(detections: DataFrame, data: DataFrame, objects: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """Survivors after detections were removed, in the reference order: data rows without a detection, zone links
    of existing objects without a detection, then objects without a detection. Links to unknown objects or with a NULL
    object id are kept (the reference deletes by ``IN`` over existing orphan objects)."""
    det_data = detections.select(F.col("detection_data_id").alias("id")).where(F.col("id").isNotNull())
    det_obj = detections.select(F.col("detection_object_id").alias("id")).where(F.col("id").isNotNull())
    data_s = data.join(det_data, "id", "left_semi")
    orphan_obj = objects.select("id").join(det_obj, "id", "left_anti")
    links_s = links.join(orphan_obj.withColumnRenamed("id", "detectionobject_id"), "detectionobject_id", "left_anti")
    objects_s = objects.join(det_obj, "id", "left_semi")
    return {"detection": detections, "detectiondata": data_s, "detectionobject_geo_custom_zones": links_s, "detectionobject": objects_s}


def purge_batch(detections: DataFrame, data: DataFrame, objects: DataFrame, links: DataFrame, batch_id: str) -> dict[str, DataFrame]:
    """Remove the detections of one batch (NULL batch ids are kept), then cascade."""
    kept = detections.where(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))
    return orphan_cascade(kept, data, objects, links)


# ---------------------------------------------------------------- P5: custom-zone geometry refresh
def refresh_custom_geometry(zones: DataFrame, staging: DataFrame, zone_type: str = "CUSTOM") -> DataFrame:
    """P5: replace the geometry of zones of ``zone_type`` by the staging row of the same name (several staging rows of
    one name: the smallest staging id wins); other zones unchanged. ``zones``/``staging``: name + geometry columns
    (``rings`` and bbox); staging has a ``sid`` order key."""
    geo_cols = [c for c in ("rings", "minx", "miny", "maxx", "maxy") if c in staging.columns]
    w = Window.partitionBy("name").orderBy("sid")
    st = staging.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select("name", *[F.col(c).alias("_s_" + c) for c in geo_cols])
    j = zones.join(st, "name", "left")
    hit = (F.col("zone_type") == zone_type) & F.col("_s_" + geo_cols[0]).isNotNull()
    return j.select(*[F.when(hit, F.col("_s_" + c)).otherwise(F.col(c)).alias(c) if c in geo_cols else F.col(c) for c in zones.columns])


def find_zones(zones: DataFrame, pattern: str, zone_type: str = "CUSTOM") -> DataFrame:
    """P5 lookup: zones of a type whose name matches a case-insensitive LIKE pattern."""
    return zones.where(F.col("name").ilike(pattern) & (F.col("zone_type") == zone_type)).select("name", "id")


# ---------------------------------------------------------------- P2 / S17: collectivity upsert
def geometry_match(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Pairs (a_key, b_key) of rows with equal geometry: equi-join on a hash of the rings, exact ring equality as
    the residual (no spatial predicate needed)."""
    ah = a.select(F.col(a_key), F.col("rings").alias("_ra"), F.xxhash64("rings").alias("_h"))
    bh = b.select(F.col(b_key), F.col("rings").alias("_rb"), F.xxhash64("rings").alias("_h"))
    return ah.join(bh, "_h").where(F.col("_ra") == F.col("_rb")).select(a_key, b_key)


def upsert_collectivities(zones: DataFrame, child: DataFrame, source: DataFrame, level: str, parents: DataFrame | None = None, by: str = "geometry"):
    """P2 for one level: refresh geometries of known codes, insert zones for unknown codes (null-aware NOT IN) with a
    normalized name, then create child rows for zones of the level that have none, matched to the source by geometry
    equality (S17; ``by="geometry"``, as for communes) or by name (``by="name"``, as for regions and departments), with the
    parent id looked up by code and the surface (S11) of the zone. New zones have ``uuid``, ``created_at``, ``updated_at`` and
    ``deleted`` if ``zones`` has these columns.

    zones: id, name, name_normalized, zone_type, rings, minx..maxy; child: geozone_ptr_id, code;
    source: code, name, parent_code, rings, minx..maxy; parents: geozone_ptr_id, insee_code.
    Returns (zones, new_child_rows).
    """
    from vigie.functions import geo
    from vigie.functions.text import normalize_text
    from vigie.plans.nulls import not_in

    geo_cols = ["rings", "minx", "miny", "maxx", "maxy"]
    # a code that occurs twice must not multiply zones: the row with the smallest name stands for it
    first = Window.partitionBy("code").orderBy("name", F.xxhash64("rings"))
    source = source.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    src_by_code = source.select("code", *[F.col(c).alias("_s_" + c) for c in geo_cols])
    known = child.select(F.col("geozone_ptr_id").alias("id"), "code").join(src_by_code, "code")
    refreshed = zones.join(known.drop("code"), "id", "left").select(
        *[F.coalesce(F.col("_s_" + c), F.col(c)).alias(c) if c in geo_cols else F.col(c) for c in zones.columns]
    )
    new_src = not_in(source, "code", child, "code")
    numbered = surrogate_ids(new_src, [F.col("code")], name="_rank", offset=1).withColumn("_m", zones.agg(F.coalesce(F.max("id"), F.lit(0))).scalar())
    inserted = numbered.select(
        (F.col("_m") + F.col("_rank")).cast(zones.schema["id"].dataType).alias("id"), F.col("name"),
        normalize_text(F.col("name")).alias("name_normalized"), F.lit(level).alias("zone_type"), *geo_cols,
        F.expr("uuid()").alias("uuid"), F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"), F.lit(False).alias("deleted"),
    )
    all_zones = refreshed.unionByName(inserted.select(*zones.columns))
    orphans = all_zones.where(F.col("zone_type") == level).join(child.select(F.col("geozone_ptr_id").alias("id")), "id", "left_anti")
    if by == "geometry":
        pairs = geometry_match(orphans, source, "id", "code")
    else:
        pairs = orphans.select("id", "name").join(source.select("name", "code"), "name").select("id", "code")
    surface = orphans.select("id", geo.to_web_mercator(F.col("rings")).alias("_m")).select("id", (geo.area("_m") / 1e6).alias("surface_km2")) if by == "name" else None
    new_child = pairs.join(source.select("code", "parent_code"), "code")
    if parents is not None:
        new_child = new_child.join(parents.select(F.col("insee_code").alias("parent_code"), F.col("geozone_ptr_id").alias("parent_id")),
                                   "parent_code", "left")
    out = ["code", *(["parent_id"] if parents is not None else [])]
    if surface is not None:
        new_child, out = new_child.join(surface, "id"), [*out, "surface_km2"]
    return all_zones, new_child.select(F.col("id").alias("geozone_ptr_id"), *out)
