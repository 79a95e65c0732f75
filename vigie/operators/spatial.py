"""Spatial operators (S1–S17) as Spark jobs over layers (see ``vigie.plans.cells``)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.operators import rings
from vigie.plans import cells as C
from vigie.plans.materialize import materialize

FIRST_RATIO = 0.5       # first detection: earlier overlap must be strictly greater than this share
HISTORY_RATIO = 0.5     # prescription history: overlap share must be at least this
HISTORY_MIN_GAP = 6     # years between a detection and its history
HISTORY_CLASSES = ["construction en dur", "piscine"]  # fixed values, like the ratios and the gap


def zone_tag(features: DataFrame, zones: DataFrame, cell: float, zone_ids=None) -> DataFrame:
    """(id, zone_id) for every zone that fully contains the feature (boundary contact allowed)."""
    z = zones if zone_ids is None else zones.where(F.col("id").isin(list(zone_ids)))
    return C.within_pairs(features, z, cell).select(F.col("fid").alias("id"), "zone_id")


def in_any_zone(features: DataFrame, zones: DataFrame, cell: float, zone_ids=None) -> DataFrame:
    """Ids of the features that at least one zone fully contains, once each."""
    return zone_tag(features, zones, cell, zone_ids).select("id").distinct()


def match_parcel(det: DataFrame, parcels: DataFrame, cell: float, id_col: str = "id_parcellaire") -> DataFrame:
    """Left-outer intersects join keeping the parcel with the smallest parcel id (NULL when none).

    Equal geometries are collapsed on both sides before pairing: of equal parcels the one with the smallest id can be the
    answer, and equal detections have equal answers. Cells that hold many of them are split (``cells.cell_tree``).
    """
    places = materialize(C.by_geometry(parcels, **{id_col: F.min_by(id_col, "id")}))
    spots = materialize(C.by_geometry(det))
    pairs = C.feature_pairs(spots, places, cell, with_touch=True, b_keep=(id_col,), tree=C.cell_tree([spots, places], cell))
    best = pairs.groupBy(F.col("a_id").alias("id")).agg(F.min_by(F.col("b_" + id_col), F.col("b_id")).alias(id_col))
    return C.join_geometry(det, spots.join(best, "id"), (), [id_col])


def first_detection(det: DataFrame, cell: float, seq_col: str = "load_seq", ratio: float = FIRST_RATIO) -> DataFrame:
    """S3: flag rows that no already-loaded detection covers by more than ``ratio`` of their area.

    "Already loaded" = rows of a strictly smaller ``seq_col`` (earlier (config, batch) runs, any zone); rows of the same
    run do not see each other. One set-based pass: identical geometries are collapsed first (a copy loaded later is
    covered 100% by its earlier twin), then earlier/later representatives are paired through the cell index. A geometry
    is identified by the smallest id that has it, and rows find theirs by the geometry itself, so no hash can mix two up.
    A zero-area row has an undefined ratio and stays first. Cells that hold many geometries are split (``cells.cell_tree``).
    """
    reps = materialize(C.with_gap(C.by_geometry(det, seq=F.min(seq_col))))
    covered = C.covered(reps, reps, cell, ratio, a_keep=("seq",), b_keep=("seq",), condition=F.col("b_seq") < F.col("a_seq"),
                        tree=C.cell_tree([reps], cell)).select("id").distinct()
    flags = reps.join(covered.withColumn("_cov", F.lit(True)), "id", "left").withColumnRenamed("seq", "_first_seq")
    out = C.join_geometry(det, flags, (), ["_first_seq", "_cov"])
    later_copy = (F.col(seq_col) > F.col("_first_seq")) & (F.col("area") > 0)
    first = ~(F.coalesce(later_copy, F.lit(False)) | F.coalesce(F.col("_cov"), F.lit(False)))
    return out.withColumn("first_detection", first).drop("_first_seq", "_cov")


def prescribed_by_history(det: DataFrame, cell: float, min_gap: int = HISTORY_MIN_GAP, ratio: float = HISTORY_RATIO,
                          classes=HISTORY_CLASSES) -> DataFrame:
    """Per detection of the given classes, distinct survey years ≥ ``min_gap`` earlier on the same parcel whose
    detection overlaps it by at least ``ratio`` of its area (0-area → NULL ratio → no match); flag = count ≥ 1.

    A detection asks once for each earlier year of its parcel whether a detection of that year covers it (``cells.covered``: parcel
    and year are keys of the cell join, and the search ends at the first one found), so a parcel holding many detections does not
    emit its pairs; copies (same parcel, year, geometry) are collapsed first and stand under their smallest id.
    """
    a = det.where(F.col("object_type").isin(list(classes)))
    keys = ("id_parcellaire", "batch_year")
    a_rep = materialize(C.with_gap(C.by_geometry(a, *keys)))
    b_rep = materialize(C.with_gap(C.by_geometry(det.where(F.col("id_parcellaire").isNotNull()), *keys)))
    years = b_rep.select("id_parcellaire", F.col("batch_year").alias("earlier")).distinct()
    asked = materialize(a_rep.join(years, "id_parcellaire").where(F.col("batch_year") - F.col("earlier") >= min_gap))
    hits = C.covered(asked, b_rep, cell, ratio, at_least=True, a_keep=(*keys, "earlier"), b_keep=keys,
                     match=(("id_parcellaire", "id_parcellaire"), ("earlier", "batch_year")), tree=C.cell_tree([b_rep], cell))
    # an id may stand for several (parcel, year) rows when runs overlap, so the keys go along
    counts = hits.groupBy("id", *keys).agg(F.countDistinct("earlier").cast("long").alias("count_histo_6y_detection"))
    out = C.join_geometry(a, a_rep.join(counts, ["id", *keys]), keys, ["count_histo_6y_detection"])
    out = out.withColumn("count_histo_6y_detection", F.coalesce("count_histo_6y_detection", F.lit(0)).cast("long"))
    return out.withColumn("prescripted_detection", F.col("count_histo_6y_detection") >= 1)


# Fixed values of the detection load: minimum model score, accepted classes, classes merged into one.
LOAD_MIN_SCORE = 0.3
LOAD_CLASSES = [
    "construction en dur",
    "piscine",
    "mobil home",
    "caravane",
    "construction legere yourte etc.",
    "container",
    "installation legere",
]
MERGED_CLASSES = ["construction en dur", "construction legere yourte etc.", "container", "installation legere"]
MERGED_INTO = "construction en dur"


def load_detections(inference: DataFrame, parcels: DataFrame, zones: DataFrame, configs: DataFrame, cell: float,
                    min_score: float = LOAD_MIN_SCORE, classes=LOAD_CLASSES, pair_cell: float | None = None,
                    existing: DataFrame | None = None, with_first: bool = True) -> DataFrame:
    """The detection load for every (territory, batch) configuration in one plan.

    ``inference``: layer with keep columns score, object_type, batch_id. ``configs``: geozone_id, batch_id, batch_year,
    ze_zone_id, zr_zone_id, zan_zone_id, load_seq (the order the runs are committed in). A detection is loaded for a
    config when it has the config's batch, score > min_score, an accepted class, lies within the territory AND within
    at least one of the three risk zones (each tested separately). Detections are tagged with zones first (S1), so each
    meets only the configs of zones it lies in, never all territories of its batch. Then the parcel is matched once per
    geometry (S2), and ``first_detection`` (S3) runs over all loaded rows by load order.

    ``existing``: rows stored by earlier loads (a layer); a row one of them covers is no first detection. Loading surveys one
    after another, each with the rows of those before as ``existing``, gives the flags of one pass over all. Without
    ``with_first`` S3 is not run and there is no column ``first_detection``.
    """
    from vigie.streaming.incremental import first_detection_increment

    inf = inference.where((F.col("score") > min_score) & F.col("object_type").isin(list(classes)))
    risk_cols = ["ze_zone_id", "zr_zone_id", "zan_zone_id"]
    zone_ids = configs.select(F.explode(F.array("geozone_id", *risk_cols)).alias("id")).where("id is not null").distinct()
    tags = materialize(zone_tag(inf, zones.join(zone_ids, "id", "left_semi"), cell))
    pair_cell = pair_cell or cell
    loaded = materialize(_load_rows(inf, tags, configs, risk_cols))
    spots = loaded.select("id", "rings", "minx", "miny", "maxx", "maxy", "is_rect", "area").dropDuplicates(["id"])
    parcel = match_parcel(spots, parcels, pair_cell).select("id", "id_parcellaire")
    rows = loaded.join(parcel, "id", "left").withColumn(
        "object_type", F.when(F.col("object_type").isin(MERGED_CLASSES), F.lit(MERGED_INTO)).otherwise(F.col("object_type"))
    )
    columns = ["id", "score", "object_type", F.col("geozone_id").cast("long").alias("geozone_id"), "batch_year", "id_parcellaire",
               "load_seq", "rings", "minx", "miny", "maxx", "maxy", "is_rect", "area"]
    if not with_first:
        return rows.select(*columns)
    flags = first_detection(spots_in_order(loaded), pair_cell, seq_col="load_seq").select("id", "load_seq", "first_detection")
    if existing is not None:
        fresh = first_detection_increment(spots, existing, pair_cell).select("id", F.col("first_detection").alias("_fresh"))
        flags = flags.join(fresh, "id").select("id", "load_seq", (F.col("first_detection") & F.col("_fresh")).alias("first_detection"))
    return rows.join(flags, ["id", "load_seq"]).select(*columns[:6], "first_detection", *columns[6:])


def spots_in_order(loaded: DataFrame) -> DataFrame:
    """What S3 needs of loaded rows, one per (id, load_seq)."""
    return loaded.select("id", "load_seq", "rings", "minx", "miny", "maxx", "maxy", "is_rect", "area").dropDuplicates(["id", "load_seq"])


def _load_rows(inf: DataFrame, tags: DataFrame, configs: DataFrame, risk_cols: list[str]) -> DataFrame:
    """Detections × the configs of their batch whose territory and whose risk zones they lie in.

    Rows in flight: one per detection and containing territory, times its risk zones, whatever the number of configs is.
    """
    cfg = configs.withColumn("geozone_id", F.col("geozone_id").cast("long"))
    mine = inf.select("id", "batch_id").join(tags, "id").withColumnRenamed("zone_id", "geozone_id").join(cfg, ["batch_id", "geozone_id"])
    risk = mine.select("id", "load_seq", F.explode(F.array_distinct(F.array(*[F.col(c).cast("long") for c in risk_cols]))).alias("zone_id"))
    keep = risk.join(tags, ["id", "zone_id"], "left_semi").select("id", "load_seq").distinct()
    chosen = mine.drop("batch_id").join(keep, ["id", "load_seq"], "left_semi")
    return inf.join(chosen, "id")


RISK_COLUMNS = ("ze_zone_id", "zr_zone_id", "zan_zone_id")


def parcels_at_risk_by_config(parcels: DataFrame, zones: DataFrame, configs: DataFrame, cell: float, distinct_total: bool = False) -> DataFrame:
    """S8 as configured: per territory, its parcels and those within one of its own three risk zones, under the id it is
    reported by.

    ``parcels``: layer with keep columns territory_id, id_parcellaire. ``configs``: geozone_id (the territory), stats_geozone_id
    (the id reported), ze_zone_id, zr_zone_id, zan_zone_id (NULL: no such zone). A parcel within another territory's risk
    zone only does not count. ``distinct_total`` counts distinct references instead of rows. A territory without a parcel in
    a risk zone gives no row. Equal geometries are tagged once.
    """
    pairs = configs.select(F.col("geozone_id").cast("long").alias("territory_id"), F.explode(F.array_distinct(F.array(*[F.col(c).cast("long") for c in RISK_COLUMNS]))).alias("zone_id"))
    pairs = pairs.where("zone_id is not null").distinct()
    spots = C.by_geometry(parcels)
    tags = zone_tag(spots, zones.join(pairs.select(F.col("zone_id").alias("id")).distinct(), "id", "left_semi"), cell)
    places = spots.join(tags.groupBy("id").agg(F.collect_set("zone_id").alias("zone_ids")), "id")  # at most one entry per zone
    p = C.join_geometry(parcels, places, (), ["zone_ids"])
    mine = pairs.groupBy("territory_id").agg(F.collect_set("zone_id").alias("mine"))
    p = p.select(F.col("territory_id").cast("long").alias("territory_id"), "id_parcellaire", "zone_ids").join(mine, "territory_id")
    hit = F.coalesce(F.arrays_overlap("zone_ids", "mine"), F.lit(False))
    total = F.countDistinct("id_parcellaire") if distinct_total else F.count("id_parcellaire")
    counts = p.groupBy("territory_id").agg(total.alias("nb_parcels"), F.countDistinct(F.when(hit, F.col("id_parcellaire"))).alias("nb_parcels_in_ze"), F.max(hit).alias("_any"))
    reported = configs.select(F.col("geozone_id").cast("long").alias("territory_id"), F.col("stats_geozone_id").cast("long").alias("geozone_id")).distinct()
    return counts.where("_any").join(reported, "territory_id").select("geozone_id", "nb_parcels", "nb_parcels_in_ze")


def parcels_at_risk(parcels: DataFrame, communes: DataFrame, risk: DataFrame, cell: float, level: str = "commune") -> DataFrame:
    """Per territory, parcel count and parcels within at least one risk zone.

    ``parcels``: layer with keep columns commune_id, id_parcellaire. ``communes``: geozone_id, epci_id.
    level 'commune': group = commune, nb_parcels = count(id_parcellaire) (NULLs not counted, repeats counted);
    level 'epci': group = the commune's EPCI, nb_parcels = count(distinct id_parcellaire).
    nb_parcels_in_ze = distinct parcel references within any risk zone. Driven by the risk side: a territory
    without any parcel row inside a risk zone gives no row.
    """
    c = F.col
    spots = C.by_geometry(parcels)  # equal geometries are tested once
    found = C.within_pairs(spots, risk, cell).select(c("fid").alias("id")).distinct()
    p = C.join_geometry(parcels, spots.join(found.withColumn("_in", F.lit(True)), "id"), (), ["_in"])
    p = p.select("commune_id", "id_parcellaire", F.coalesce("_in", F.lit(False)).alias("_in"))
    if level == "commune":
        p = p.withColumnRenamed("commune_id", "geozone_id")
    elif level == "epci":
        p = p.join(communes.select(c("geozone_id").alias("commune_id"), c("epci_id").alias("geozone_id")), "commune_id")
    else:
        raise ValueError(level)
    # one row for each reference of a territory, then plain sums
    refs = p.groupBy("geozone_id", "id_parcellaire").agg(F.count("id_parcellaire").alias("_n"), F.max("_in").alias("_in"))
    known = c("id_parcellaire").isNotNull()
    total = F.sum("_n") if level == "commune" else F.count("id_parcellaire")
    out = refs.groupBy("geozone_id").agg(total.alias("nb_parcels"), F.sum((known & c("_in")).cast("long")).alias("nb_parcels_in_ze"), F.max("_in").alias("_any"))
    return out.where("_any").select(c("geozone_id").cast("long").alias("geozone_id"), c("nb_parcels").cast("long").alias("nb_parcels"), "nb_parcels_in_ze")


# ---------------------------------------------------------------- edge-table operators
def edges(layer: DataFrame, keep=()) -> DataFrame:
    """Directed ring edges (id, ring_no, x1, y1, x2, y2): one row per edge, so a very large zone spreads over tasks."""
    r = layer.select("id", *keep, F.posexplode("rings").alias("ring_no", "ring"))
    e = r.select("id", *keep, "ring_no", "ring", F.explode(F.sequence(F.lit(0), F.size("ring") - 1)).alias("i"))
    a = F.col("ring")[F.col("i")]
    b = F.col("ring")[(F.col("i") + 1) % F.size("ring")]
    return e.select("id", *keep, "ring_no", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


#: A polygon's part of a cell: a box, or rings; ``segs`` are its boundary there, four numbers each.
PART = ["x0", "y0", "x1", "y1", "rings", "segs"]
PART_SCHEMA = f"group_id long, cx long, cy long, x0 double, y0 double, x1 double, y1 double, rings {C.geo.RINGS_TYPE}, segs array<double>"


def _box_cells(x0: float, y0: float, x1: float, y1: float, cell: float):
    """(cx, cy, clip box, boundary) for every closed cell a box meets, as ``kernel.decompose`` gives them; the clip may have no area."""
    for cx in range(math.floor(x0 / cell), math.floor(x1 / cell) + 1):
        left, right = max(x0, cx * cell), min(x1, (cx + 1) * cell)
        for cy in range(math.floor(y0 / cell), math.floor(y1 / cell) + 1):
            low, high = max(y0, cy * cell), min(y1, (cy + 1) * cell)
            segs: list[float] = []
            if low == y0:
                segs += (left, y0, right, y0)
            if right == x1:
                segs += (x1, low, x1, high)
            if high == y1:
                segs += (right, y1, left, y1)
            if left == x0:
                segs += (x0, high, x0, low)
            yield cx, cy, (left, low, right, high), segs


def _polygon_batches(cell: float):
    from vigie.functions import kernel as K

    def rows(batches):
        for pdf in batches:
            for gid, rings, *box in zip(pdf["group_id"].to_numpy(), pdf["rings"], *(pdf[x].to_numpy() for x in ("minx", "miny", "maxx", "maxy"))):
                if rings is None:
                    for cx, cy, clip, segs in _box_cells(*map(float, box), cell):
                        yield gid, cx, cy, *clip, None, segs
                    continue
                for cx, cy, _, clip, segs in K.decompose(K.to_rings(rings), cell, borders=True):
                    if clip is None:
                        yield gid, cx, cy, cx * cell, cy * cell, (cx + 1) * cell, (cy + 1) * cell, None, []
                    else:
                        yield gid, cx, cy, None, None, None, None, K.from_rings(clip), segs.ravel().tolist()

    return lambda batches: C._frames(rows(batches), ["group_id", "cx", "cy", *PART], 5000)


def _union_cell(cell: float):
    import numpy as np
    import pandas as pd

    from vigie.functions import kernel as K
    from vigie.functions import overlay

    def part(x0, y0, x1, y1, rings, segs):
        box = [K.box_ring(x0, y0, x1, y1)] if x1 > x0 and y1 > y0 else []
        return (box if rings is None else K.to_rings(rings)), np.asarray(segs, float).reshape(-1, 4)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        gid, cx, cy = (int(group[c].iloc[0]) for c in ("group_id", "cx", "cy"))
        pieces = [part(*row) for row in zip(*(group[x].to_numpy() for x in PART))]
        out = pd.DataFrame(overlay.union_edges(pieces, (cx * cell, cy * cell, (cx + 1) * cell, (cy + 1) * cell)), columns=["x1", "y1", "x2", "y2"])
        out.insert(0, "group_id", gid)
        return out

    return run


EDGE_SCHEMA = "group_id long, x1 double, y1 double, x2 double, y2 double"


def dissolve(layer: DataFrame, groups: DataFrame | None = None, cell: float | None = None) -> DataFrame:
    """Union of member polygons per group as its directed boundary edges (interior on the left).

    ``groups``: (id, group_id); None = one global group 0. Members may overlap, share parts of edges (T-junctions) or lie inside
    each other. Polygons are cut by cells of side ``cell``, and the boundary is worked out cell by cell: a task holds the
    members that meet in one cell, never a whole group. Without ``cell`` it is taken from the data: about the mean
    extent of a member. Geometries without area do not count; an empty group gives no row.
    """
    members = layer.where(F.col("area") > 0) if "area" in layer.columns else layer
    if cell is None:
        side = members.agg(F.avg(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")))).first()[0]
        cell = float(side) if side else 1.0
    g = members.select("id", "rings")
    g = g.join(groups.select("id", F.col("group_id").cast("long").alias("group_id")), "id") if groups is not None else g.withColumn("group_id", F.lit(0).cast("long"))
    # a box goes to Python as four numbers
    box = C.geo.is_rect("rings") & (C.geo.area("rings") > 0)
    g = g.select("id", "group_id", F.when(~F.coalesce(box, F.lit(False)), F.col("rings")).alias("rings"), *C.geo.bbox_cols("rings"))
    g = g.repartition("id", "minx", "miny").drop("id")  # a small file is few tasks, and cutting is the work
    cut = g.mapInPandas(_polygon_batches(float(cell)), PART_SCHEMA)
    return cut.groupBy("group_id", "cx", "cy").applyInPandas(_union_cell(float(cell)), EDGE_SCHEMA)


def assemble(boundary: DataFrame) -> DataFrame:
    """(group_id, rings) from ``dissolve`` output; edges stay rows until each knows its ring and place (``rings.ring_vertices``)."""
    return rings.as_rings(rings.ring_vertices(boundary))


def edge_measures(e: DataFrame, key: str) -> DataFrame:
    """Area, centroid and perimeter per key from directed boundary edges (shoelace sums as a plain groupBy)."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    m = F.col("mult") if "mult" in e.columns else F.lit(1)
    agg = e.groupBy(key).agg(
        (F.sum(cross * m) / 2).alias("area"),
        F.sum((F.col("x1") + F.col("x2")) * cross * m).alias("_sx"),
        F.sum((F.col("y1") + F.col("y2")) * cross * m).alias("_sy"),
        F.sum(F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2) * m).alias("perimeter"),
    )
    return agg.select(key, "area", (F.col("_sx") / (F.col("area") * 6)).alias("cx"), (F.col("_sy") / (F.col("area") * 6)).alias("cy"), "perimeter")


def zone_surface(layer: DataFrame) -> DataFrame:
    """km² of each zone measured in projected web-mercator metres (latitude inflation reproduced as is)."""
    from vigie.functions import geo

    merc = layer.select("id", geo.to_web_mercator(F.col("rings")).alias("rings"))
    m = edge_measures(edges(merc), "id")
    return m.select(F.col("id"), (F.col("area") / 1e6).alias("surface_km2"))


# Centroid overrides of four overseas departments (lat per id, one shared lon), excluded name.
CENTROID_OVERRIDE_LAT = {36155: 51.0, 36156: 49.0, 36160: 45.0, 36161: 43.0}
CENTROID_OVERRIDE_LON = -7.223655
CENTROID_EXCLUDED_NAME = "Guyane"


def zone_centroids(boundary_edges: DataFrame, zones: DataFrame, selected: DataFrame) -> DataFrame:
    """Centroid (lon, lat) per selected zone from boundary edges (id-keyed, e.g. ``dissolve`` output renamed),
    with the fixed per-id overrides, excluding the fixed name (a NULL name is excluded too).

    ``zones``: (id, name); ``selected``: (id) of the zones to report (e.g. the department child table).
    """
    from vigie.plans.broadcast import seed

    spark = zones.sparkSession
    ov = seed(spark.createDataFrame([(k, v, CENTROID_OVERRIDE_LON) for k, v in CENTROID_OVERRIDE_LAT.items()], "id long, o_lat double, o_lon double"))
    keep = zones.select("id", "name").where(F.col("name") != CENTROID_EXCLUDED_NAME).join(selected.select("id"), "id", "left_semi")
    m = edge_measures(boundary_edges, "id")
    return keep.join(m, "id").join(ov, "id", "left").select(
        F.col("id").cast("long").alias("id"), "name",
        F.coalesce(F.col("o_lon"), F.col("cx")).alias("lon"), F.coalesce(F.col("o_lat"), F.col("cy")).alias("lat"),
    )


# The EPCI whose centroids are reported.
EPCI_CENTROID_IDS = [37087, 36513, 37374, 37380, 36519, 37373, 37378, 37375, 37377, 37376, 36802, 36803, 37379, 37372, 36717, 36716]


def selected_centroids(zones: DataFrame, ids=EPCI_CENTROID_IDS) -> DataFrame:
    """S12, EPCI view: (id, name, lon, lat) of the chosen zones' own geometries (id, name, rings)."""
    from vigie.functions import geo

    chosen = zones.where(F.col("id").isin(list(ids))).withColumn("rings", geo.oriented("rings"))
    lon, lat = geo.centroid("rings")
    return chosen.select(F.col("id").cast("long").alias("id"), "name", lon.alias("lon"), lat.alias("lat"))


def tile_cover(layer: DataFrame, zoom: int = 19, explode: bool = False) -> DataFrame:
    """Slippy-map tile range of each zone's bbox (min_y from max_lat); optionally one row per tile."""
    from vigie.functions import geo

    t = layer.select(
        "id",
        geo.tile_x(F.col("minx"), zoom).alias("min_x_tile"), geo.tile_y(F.col("maxy"), zoom).alias("min_y_tile"),
        geo.tile_x(F.col("maxx"), zoom).alias("max_x_tile"), geo.tile_y(F.col("miny"), zoom).alias("max_y_tile"),
    )
    if not explode:
        return t
    return t.select("id", F.explode(F.sequence("min_x_tile", "max_x_tile")).alias("x"), "min_y_tile", "max_y_tile").select(
        "id", "x", F.explode(F.sequence("min_y_tile", "max_y_tile")).alias("y"))


# ---------------------------------------------------------------- S5: containment in the union of a tileset's zones
def outside_bounds(det: DataFrame, tileset_zones: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """Detections to remove — their tileset has no zones, or they are not contained in the union of the tileset's
    zones (a straddler of two adjacent zones is inside). With a zoned tileset a NULL geometry is kept; with an
    un-zoned one it is removed.

    ``det``: layer with keep column tile_set_id. ``tileset_zones``: (tileset_id, geozone_id). The zones of a tileset are united cell by
    cell into disjoint pieces, and a detection meets those of its own tileset only, so the parts covered simply add up; only
    cells shared by several zones are worked out in Python, once for each cell and never for a detection.
    """
    links = tileset_zones.select(F.col("tileset_id").alias("tile_set_id"), F.col("geozone_id").cast("long").alias("zone_id")).distinct()
    zoned = links.select("tile_set_id").distinct()
    no_zone = det.join(zoned, "tile_set_id", "left_anti").select("id")
    d = det.join(zoned, "tile_set_id", "left_semi").where(F.col("rings").isNotNull())
    pieces = C.zone_cells(zones.join(links.select(F.col("zone_id").alias("id")).distinct(), "id", "left_semi"), cell)
    pieces = materialize(C.union_pieces(pieces.join(links, "zone_id"), "tile_set_id"))
    overlaps = C.piece_overlaps(d, pieces, cell, (), ("tile_set_id",), with_touch=False)
    covered = overlaps.groupBy(F.col("fid").alias("id")).agg(F.sum("area_in").alias("covered"))
    inside = d.join(covered, "id").where(F.col("covered") >= F.col("area") * (1 - 1e-9)).select("id")
    outside = d.select("id").join(inside, "id", "left_anti")
    return no_zone.unionByName(outside)


# ---------------------------------------------------------------- S6, S7, S10, S16
def extract_in_collectivities(det: DataFrame, data: DataFrame, objects: DataFrame, types: DataFrame, users: DataFrame,
                              tiles: DataFrame, communes: DataFrame, names: DataFrame, batch_id: str, excluded_email: str,
                              cell: float) -> DataFrame:
    """Review extract of detections intersecting the union of the named communes (= intersecting any of them),
    joined to data/object/type/user/tile; the default reviewer (and a NULL e-mail) is excluded; type name normalized.

    ``det`` may carry ``detection_source``, ``created_at`` and ``updated_at``; the geometry goes along as ``rings``."""
    from vigie.functions.text import normalize_text
    from vigie.plans import cells as C

    named = communes.join(names.select(F.col("name").alias("_n")), F.col("name") == F.col("_n"), "left_semi")
    hit = C.intersect_pairs(det, named, cell).select(F.col("fid").alias("id")).distinct()
    d = (
        det.join(hit, "id", "left_semi")
        .join(data.select(F.col("id").alias("detection_data_id"), "detection_control_status", "detection_prescription_status",
                          "detection_validation_status", "user_last_update_id"), "detection_data_id")
        .join(objects.select(F.col("id").alias("detection_object_id"), "object_type_id", *(["address"] if "address" in objects.columns else [])),
              "detection_object_id")
        .join(types.select(F.col("id").alias("object_type_id"), "name_n"), "object_type_id")
        .join(users.select(F.col("id").alias("user_last_update_id"), "email"), "user_last_update_id")
        .join(tiles.select(F.col("id").alias("tile_id"), F.col("x").alias("tile_x"), F.col("y").alias("tile_y")), "tile_id")
        .where(F.col("email") != excluded_email)
    )
    return d.select(
        (F.col("address") if "address" in d.columns else F.lit(None).cast("string")).alias("address"),
        F.lit(batch_id).alias("batch_id"), "detection_control_status", "detection_prescription_status", "detection_validation_status",
        "id", normalize_text(F.col("name_n")).alias("object_type"), "score", "tile_x", "tile_y", F.lit(True).alias("user_reviewed"),
        F.col("rings").alias("geometry"), *[c for c in ("detection_source", "created_at", "updated_at") if c in d.columns],
    )


def sync_zone_links(links: DataFrame, det: DataFrame, custom_zones: DataFrame, cell: float) -> DataFrame:
    """(object, custom zone) pairs for objects having a detection within the zone, minus the existing links
    (existing pairs untouched: an append-only, idempotent sync)."""
    tagged = zone_tag(det.select("id", "rings", "minx", "miny", "maxx", "maxy", "is_rect", "area"), custom_zones, cell)
    pairs = tagged.join(det.select("id", "detection_object_id"), "id").select(
        F.col("detection_object_id").alias("detectionobject_id"), F.col("zone_id").alias("geocustomzone_id")).distinct()
    return pairs.join(links, ["detectionobject_id", "geocustomzone_id"], "left_anti")


def parcel_zone_flags(parcels: DataFrame, det: DataFrame, zones: DataFrame, zone_cols: dict, year: int, cell: float,
                      precision: str = "0.705", bias: str = "0.252") -> DataFrame:
    """Parcels referenced by detections of ``year``: one flag per risk zone (bool_or over the parcel's
    geometries), then per zone the corrected count of flagged parcels, rounded half away from zero. Zones may overlap,
    so the per-zone totals need not add up."""
    from decimal import Decimal

    refs = det.where(F.col("batch_year") == year).select("id_parcellaire").distinct()
    p = parcels.join(refs, "id_parcellaire", "left_semi")
    tags = zone_tag(p, zones.where(F.col("id").isin(list(zone_cols.values()))), cell)
    flags = p.select("id", "id_parcellaire").join(tags, "id", "left").groupBy("id_parcellaire").agg(
        *[F.max((F.col("zone_id") == z).cast("int")).alias(name) for name, z in zone_cols.items()]
    )
    factor = F.lit(Decimal(precision)) * (F.lit(Decimal(1)) - F.lit(Decimal(bias)))
    return flags.agg(*[
        F.round(F.sum(F.coalesce(F.col(name), F.lit(0))).cast("decimal(20,0)") * factor, 0).cast("int").alias(name)
        for name in zone_cols
    ])


def detections_in_risk(det: DataFrame, data: DataFrame, objects: DataFrame, types: DataFrame, communes: DataFrame,
                       risk: DataFrame, thresholds: DataFrame, cell: float, classes=None) -> DataFrame:
    """Reviewable detections within a risk zone, with their centroid.

    ``thresholds``: (tile_set_id, iso_code, min_score) with iso_code NULL meaning every commune of the tileset; the
    reviewable rule is SUSPECT, LEGITIMATE, or DETECTED_NOT_VERIFIED above the matching threshold and not prescribed.
    Detections of tilesets/communes without a threshold row are not reported.
    """
    from vigie.functions import geo
    from vigie.operators.cohort import STATUS_CLASSES, reviewable
    classes = classes or STATUS_CLASSES
    inrisk = zone_tag(det.select("id", "rings", "minx", "miny", "maxx", "maxy", "is_rect", "area"), risk, cell).select("id").distinct()
    d = (
        det.join(inrisk, "id", "left_semi")
        .join(data.select(F.col("id").alias("detection_data_id"), "detection_validation_status", "detection_prescription_status"), "detection_data_id", "left")
        .join(objects.select(F.col("id").alias("detection_object_id"), "object_type_id", "parcel_id", "commune_id"), "detection_object_id", "left")
        .join(types.select(F.col("id").alias("object_type_id"), "name_n"), "object_type_id", "left")
        .where(F.col("name_n").isin(list(classes)))
        .join(communes.select(F.col("geozone_ptr_id").alias("commune_id"), "iso_code"), "commune_id", "left")
    )
    th = thresholds.select("tile_set_id", F.col("iso_code").alias("th_iso"), "min_score")
    m = d.join(th, (d["tile_set_id"] == th["tile_set_id"]) & (th["th_iso"].isNull() | (th["th_iso"] == d["iso_code"]))).drop(th["tile_set_id"])
    ok = m.where(reviewable(F.col("score"), F.col("detection_validation_status"), F.col("detection_prescription_status"), F.col("min_score")))
    ok = ok.select("id").distinct()
    cx, cy = geo.centroid("rings")
    return d.join(ok, "id", "left_semi").select("id", "tile_set_id", "commune_id", "parcel_id", cx.alias("cx"), cy.alias("cy"),
                                                "detection_validation_status", F.col("rings").alias("geometry"))


# ---------------------------------------------------------------- S13: layer ingest
def ingest_layer(layers_df: DataFrame, name: str, default_srid: int = 2154, cell: float | None = None) -> tuple[DataFrame, DataFrame]:
    """A folder of decoded source layers (file, srid, rings) → one named zone with the union of its polygons.

    The SRID is probed per file (its smallest known one; 0 or absent → ``default_srid``); Lambert-93 rows are reprojected to
    lon/lat with vertex-wise Column math, lon/lat rows pass as is. Rings may come in either orientation. Rows with another
    SRID, without three different vertices in every ring, or without area go to the quarantine with a reason; nothing is
    repaired and nothing is dropped unreported. The rest are dissolved (S4), overlaps and T-junctions included.
    Returns (zone: name, rings, area, perimeter, n_rings, bbox; quarantine: file, reason). Store the zone
    with ``NamedTables.replace`` on the name.
    """
    from vigie.functions import geo
    srid = layers_df.groupBy("file").agg(F.min(F.when(F.col("srid") != 0, F.col("srid"))).alias("_srid")).select(
        "file", F.coalesce("_srid", F.lit(default_srid)).alias("layer_srid"))
    d = layers_df.join(srid, "file")
    valid_ring = F.forall("rings", lambda r: F.size(F.array_distinct(r)) >= 3)
    proj = F.when(F.col("layer_srid") == 2154, geo.lambert93_to_wgs84(F.col("rings"))).when(F.col("layer_srid") == 4326, F.col("rings"))
    d = d.select("file", F.col("rings").isNull().alias("_missing"), geo.oriented("rings").alias("rings"), "layer_srid").withColumn("rings", proj)
    d = d.withColumn("_a", geo.area("rings"))
    reason = (
        F.when(F.col("_missing"), F.lit("no geometry")).when(F.col("rings").isNull(), F.lit("unsupported srid"))
        .when((F.size("rings") == 0) | ~valid_ring, F.lit("invalid ring")).when(~(F.abs("_a") > 0), F.lit("no area"))
    )
    d = materialize(d.withColumn("reason", reason).withColumn("id", F.monotonically_increasing_id()))
    bad = d.where("reason is not null").select("file", "reason")
    # orientation again: a projection may not keep it
    good = C.as_layer(d.where("reason is null"), "id")
    boundary = materialize(dissolve(good, cell=cell))
    bbox = [f(a).alias(n) for n, f, a in (("minx", F.min, F.least("x1", "x2")), ("miny", F.min, F.least("y1", "y2")),
                                          ("maxx", F.max, F.greatest("x1", "x2")), ("maxy", F.max, F.greatest("y1", "y2")))]
    measures = edge_measures(boundary, "group_id").join(boundary.groupBy("group_id").agg(*bbox), "group_id")
    zone = assemble(boundary).join(measures, "group_id").select(
        F.lit(name).alias("name"), "rings", "area", "perimeter", F.size("rings").alias("n_rings"), "minx", "miny", "maxx", "maxy")
    return zone, bad


# ---------------------------------------------------------------- S14: web-map features
# Anchor points of overseas departments on the map (code, lat, lon).
OVERSEAS_ANCHORS = [("971", 51.0, -7.223655), ("972", 49.0, -7.223655), ("973", 47.0, -7.223655), ("974", 45.0, -7.223655), ("976", 43.0, -7.223655)]
OVERSEAS_PREFIX, OVERSEAS_SKIPPED = "97", "973"


def _geojson_batches(tol: float):
    import json

    import numpy as np
    import pandas as pd

    from vigie.functions import kernel as K

    def feature(row) -> str:
        polys = []
        for r in K.to_rings(row.rings):
            s = K.simplify_ring(r, tol)
            ring = np.vstack([s, s[:1]]).round(9).tolist()
            if K.signed_area(s) >= 0 or not polys:
                polys.append([ring])
            else:
                polys[-1].append(ring)
        geom = {"type": "Polygon", "coordinates": polys[0]} if len(polys) == 1 else {"type": "MultiPolygon", "coordinates": polys}
        return json.dumps({"type": "Feature", "id": int(row.feature_id), "geometry": geom,
                           "properties": {"id": None if pd.isna(row.id) else int(row.id), "name": row.name,
                                          "name_normalized": row.name_normalized, "insee_code": row.insee_code}}, ensure_ascii=False)

    def run(batches):
        for pdf in batches:
            out = pdf.drop(columns="rings")
            out["geojson"] = [feature(row) for row in pdf.itertuples(index=False)]
            yield out

    return run


def zone_features(layer: DataFrame, anchors: DataFrame | None = None, tol: float = 0.01) -> DataFrame:
    """Department features for a web map, one GeoJSON Feature per row (the FeatureCollection is the file of
    lines, never one aggregated document). Metropolitan codes as is; overseas codes (97x except 973) translated so
    their centroid sits on the anchor (codes without an anchor are dropped); rings simplified (Douglas–Peucker, ``tol``).

    ``layer``: id, name, name_normalized, insee_code, rings. ``feature_id`` is the id; rows without one get numbers above the
    largest. Returns feature_id, id, name, name_normalized, insee_code, translated bbox, geojson.
    """
    from vigie.functions import geo
    spark = layer.sparkSession
    anchors = anchors if anchors is not None else spark.createDataFrame(OVERSEAS_ANCHORS, "insee_code string, a_lat double, a_lon double")
    layer = layer.withColumn("rings", geo.oriented("rings"))
    code = F.col("insee_code")
    metro = layer.where(~code.like(OVERSEAS_PREFIX + "%"))
    cx, cy = geo.centroid("rings")
    over = layer.where(code.like(OVERSEAS_PREFIX + "%") & ~(code == OVERSEAS_SKIPPED)).join(anchors, "insee_code") \
        .withColumn("rings", geo.translate(F.col("rings"), F.col("a_lon") - cx, F.col("a_lat") - cy)).drop("a_lat", "a_lon")
    cols = ["id", "name", "name_normalized", "insee_code", "rings"]
    allz = metro.select(*cols).unionByName(over.select(*cols))
    # numbered once, in the stored copy; the numbers of rows without an id start above the largest id
    allz = materialize(allz.withColumn("id", F.col("id").cast("long")).withColumn("_n", F.monotonically_increasing_id()))
    top = allz.agg(F.max("id")).first()[0] or 0
    out = allz.select(F.coalesce("id", F.col("_n") + 1 + top).alias("feature_id"), *cols, *geo.bbox_cols("rings"))
    schema = out.drop("rings").withColumn("geojson", F.lit("")).schema
    return out.mapInPandas(_geojson_batches(tol), schema)
