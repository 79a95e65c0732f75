"""Cell index and spatial candidate joins.

Spark has no spatial predicates, so a spatial join becomes an equi-join on grid cells followed by an exact test on the
candidate pairs only (never a nested-loop or cartesian join):

* features (detections, parcels: the large side) explode to the closed cells of their bbox with ``sequence``;
* zones (the reference side) are cut by ``decompose`` in Arrow batches, first into blocks, which spread over tasks, then into
  cells; the zone's part of a cell becomes trapezoids with vertical sides (a full cell is one);
* the join key is (cx, cy); features that are no rectangles are cut into trapezoids too, once per feature. The area of a
  rectangle or trapezoid in a trapezoid, and whether they meet, is Column math in the JVM, so no pair ever reaches Python; areas
  are summed by ``groupBy(feature, zone)``. A cell with very many features is one key of a plain shuffle join, which Spark splits
  when it is skewed.

Feature–feature pairs (detection vs earlier detection, detection vs parcel) use both sides exploded to cells and keep
a pair only in the cell holding the low corner of the two bboxes' intersection, so each pair is tested once without a
``distinct`` shuffle. There the work in a cell grows with the square of what it holds, so cells that hold much are split: a
``CellTree`` halves them until each leaf holds few features, and both sides are addressed by the leaves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.functions import geo
from vigie.functions import kernel as K
from vigie.plans.materialize import materialize

#: One trapezoid with vertical sides per row: kind 0 a full cell, 1 a rectangle, 2 general; b and t are its bottom and top.
ZONE_CELL_SCHEMA = (
    "zone_id long, cx long, cy long, kind int, q_minx double, q_miny double, q_maxx double, q_maxy double, "
    "b0 double, b1 double, t0 double, t1 double"
)
BLOCK_SCHEMA = f"zone_id long, bx long, by long, rings {geo.RINGS_TYPE}, segs array<array<double>>"
#: Cells in a block, along one side: a zone is cut into blocks first, which then spread over tasks.
BLOCK = 16
PIECE = ["kind", "q_minx", "q_miny", "q_maxx", "q_maxy", "b0", "b1", "t0", "t1"]
#: A feature's piece: left and right end, bottom at both, top at both. Columns of these names, with a prefix.
SIDES = ("x0", "x1", "b0", "b1", "t0", "t1")
#: Contact of slanted sides is seen within this share of the coordinates' size.
TOUCH_SLACK = 1e-12
#: Features a leaf of a cell tree may hold, the deepest leaf (halvings of a cell), and the most splits that are broadcast.
MOST_IN_LEAF = 256
DEEPEST = 8
MOST_SPLITS_SENT = 20_000


# ------------------------------------------------------------------ layers
def as_layer(df: DataFrame, id_col: str, rings: Column | str = "rings", keep=()) -> DataFrame:
    """Normalize a geometry table to (id, rings, bbox, is_rect, area, *keep).

    Rings may come in either orientation. A geometry without area (a line, a point, a collapsed ring) stays in the layer
    with area 0: it can touch and be touched, but lies within nothing and covers nothing; ``degenerate`` lists such rows.
    """
    base = df.select(F.col(id_col).cast("long").alias("id"), (F.col(rings) if isinstance(rings, str) else rings).alias("rings"), *keep)
    # an array of one, exploded: a filter on the columns below is not pushed under it, where it would turn the rings once for each time it names them
    base = base.select("id", F.explode(F.array(geo.oriented("rings"))).alias("rings"), *keep)
    return base.select("*", *geo.bbox_cols("rings"), geo.is_rect("rings").alias("is_rect"), geo.area("rings").alias("area"))


def degenerate(layer: DataFrame) -> DataFrame:
    """Ids of geometries that are missing or have no area."""
    return layer.where(F.col("area").isNull() | ~(F.col("area") > 0)).select("id")


def box_layer(df: DataFrame, id_col: str, keep=(), minx="minx", miny="miny", maxx="maxx", maxy="maxy") -> DataFrame:
    """Layer from stored box columns (bbox known, rectangle by construction)."""
    c = F.col
    return df.select(
        c(id_col).cast("long").alias("id"),
        geo.box_rings(c(minx), c(miny), c(maxx), c(maxy)).alias("rings"),
        *keep,
        c(minx).cast("double").alias("minx"), c(miny).cast("double").alias("miny"),
        c(maxx).cast("double").alias("maxx"), c(maxy).cast("double").alias("maxy"),
        F.lit(True).alias("is_rect"),
        ((c(maxx) - c(minx)) * (c(maxy) - c(miny))).cast("double").alias("area"),
    )


def cells_of(layer: DataFrame, cell: float) -> DataFrame:
    """Explode a layer to the closed grid cells of each bbox."""
    s = F.lit(float(cell))
    return layer.withColumn("cx", F.explode(F.sequence(F.floor(F.col("minx") / s), F.floor(F.col("maxx") / s)))).withColumn(
        "cy", F.explode(F.sequence(F.floor(F.col("miny") / s), F.floor(F.col("maxy") / s)))
    )


# ------------------------------------------------------------------ cell tree
@dataclass
class CellTree:
    """Which cells are split. ``splits``: (level, lx, ly) of the split cells, level 0 being the grid; ``depth`` levels at most."""

    cell: float
    depth: int
    splits: DataFrame
    n_splits: int

    def side(self, level: Column) -> Column:
        return F.lit(float(self.cell)) / F.pow(F.lit(2.0), level)


def cell_tree(layers: list[DataFrame], cell: float, most: int = MOST_IN_LEAF) -> CellTree | None:
    """Quadtree of the cells in which more than ``most`` features of ``layers`` begin; None if there is no such cell.

    A feature counts where its bbox has its low corner; all features are counted. The first pass counts on the grid itself; only if a
    cell holds too many, a second counts all levels at once, combined before its shuffle. Cells are halved until a leaf holds at most
    ``most``, but not below the mean extent of the layer whose features are smallest: smaller leaves would only repeat every
    feature. Copies of one geometry may count, so layers need not be collapsed first; they cost a split more, no pair.
    """
    c = F.col
    extent = F.greatest(c("maxx") - c("minx"), c("maxy") - c("miny"))
    rows = reduce(DataFrame.unionByName, [x.select(F.lit(i).alias("layer"), "minx", "miny", extent.alias("extent")) for i, x in enumerate(layers)])
    rows = rows.where(c("minx").isNotNull())
    at = lambda level: [F.floor(c(v) / (F.lit(float(cell)) / F.pow(F.lit(2.0), level))).alias(k) for v, k in (("minx", "lx"), ("miny", "ly"))]
    sizes = [F.sum(F.when(c("layer") == i, c("extent"))).alias(f"e{i}") for i in range(len(layers))] + [F.count(F.when(c("layer") == i, c("extent"))).alias(f"n{i}") for i in range(len(layers))]
    whole = rows.groupBy(*at(F.lit(0))).agg(F.count("*").alias("n"), *sizes).agg(F.max("n"), *[(F.sum(f"e{i}") / F.sum(f"n{i}")) for i in range(len(layers))]).first()
    means = [m for m in whole[1:] if m]
    depth = max(0, min(DEEPEST, math.floor(math.log2(cell / min(means))))) if means else DEEPEST
    if (whole[0] or 0) <= most or not depth:
        return None
    deep = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))))
    splits = materialize(deep.groupBy("level", *at(c("level"))).agg(F.count("*").alias("n")).where(c("n") > most).select("level", "lx", "ly"))
    return CellTree(float(cell), depth, splits, splits.count())


def leaves_of(layer: DataFrame, cell: float, tree: CellTree | None) -> DataFrame:
    """Explode a layer to the leaves (level, lx, ly) its bbox meets; without a tree, to the cells of the grid (level 0)."""
    c = F.col
    rows = cells_of(layer, cell).withColumn("level", F.lit(0)).withColumnsRenamed({"cx": "lx", "cy": "ly"})
    if tree is None:
        return rows
    split = tree.splits.withColumn("_split", F.lit(True))
    if tree.n_splits <= MOST_SPLITS_SENT:
        split = F.broadcast(split)  # counted: at most this many rows of three numbers
    for _ in range(tree.depth):
        half = tree.side(c("level") + 1)
        span = lambda axis: F.sequence(F.greatest(c(f"l{axis}") * 2, F.floor(c(f"min{axis}") / half)), F.least(c(f"l{axis}") * 2 + 1, F.floor(c(f"max{axis}") / half)))
        rows = rows.join(split, ["level", "lx", "ly"], "left")
        inside = F.flatten(F.transform(span("x"), lambda x: F.transform(span("y"), lambda y: F.struct((c("level") + 1).alias("level"), x.alias("lx"), y.alias("ly")))))
        leaf = F.when(c("_split"), inside).otherwise(F.array(F.struct("level", "lx", "ly")))
        rows = rows.withColumn("_leaf", F.explode(leaf)).drop("_split", "level", "lx", "ly").select("*", "_leaf.level", "_leaf.lx", "_leaf.ly").drop("_leaf")
    return rows


# ------------------------------------------------------------------ features as trapezoids
def _whole_pieces(layer: DataFrame, prefix: str) -> DataFrame:
    """The rectangles of ``layer``, one piece each."""
    c = F.col
    keep = [x for x in layer.columns if x not in ("rings", "minx", "miny", "maxx", "maxy")]
    whole = {"x0": "minx", "x1": "maxx", "b0": "miny", "b1": "miny", "t0": "maxy", "t1": "maxy"}
    return layer.where(c("is_rect")).select(*keep, *[c(v).alias(prefix + k) for k, v in whole.items()], "minx", "miny", "maxx", "maxy")


def _cut_pieces(layer: DataFrame, prefix: str) -> DataFrame:
    """The features of ``layer`` that are no rectangles, cut into trapezoids."""
    c = F.col
    keep = [x for x in layer.columns if x not in ("rings", "minx", "miny", "maxx", "maxy")]
    cut = layer.where(~c("is_rect")).select(*keep, F.explode(geo.trapezoids("rings")).alias("_t")).select(*keep, *[c("_t")[k].alias(prefix + k) for k in SIDES])
    side = lambda k: c(prefix + k)
    return cut.withColumns({"minx": side("x0"), "miny": F.least(side("b0"), side("b1")), "maxx": side("x1"), "maxy": F.greatest(side("t0"), side("t1"))})


def feature_pieces(layer: DataFrame, prefix: str = "") -> DataFrame:
    """``layer`` without its rings, one row per piece: a rectangle is one piece, other features are cut into trapezoids.

    minx … maxy become the bbox of the piece; ``prefix`` + ``SIDES`` hold the trapezoid. A feature without area gives its segments.
    Features without geometry give no row. For a layer of boxes the second branch is planned away.
    """
    return _whole_pieces(layer, prefix).unionByName(_cut_pieces(layer, prefix))


def with_overlap(df: DataFrame, a: dict[str, str], b: dict[str, str]) -> DataFrame:
    """``df`` with ``area_ab`` and ``touch`` of the trapezoids named by ``a`` and ``b`` (``SIDES`` → column).

    Both lie over [xa, xb] between straight lines. The lower of the two tops changes at most once there, and so does the higher
    of the two bottoms; between these places the height in common is linear, so its positive part has a closed area. The sets
    meet if it is not below zero everywhere.
    """
    c = F.col

    def at(t: dict[str, str], lo: str, hi: str, x: Column) -> Column:
        width = c(t["x1"]) - c(t["x0"])
        inside = c(t[lo]) + (c(t[hi]) - c(t[lo])) * ((x - c(t["x0"])) / width)
        return F.when(x <= c(t["x0"]), c(t[lo])).when(x >= c(t["x1"]), c(t[hi])).otherwise(inside)

    def crossing(u: str) -> Column:
        """Share of [xa, xb] at which the difference ``u`` of two lines changes sign, 0 if it doesn't."""
        return F.when(c(u + "0") * c(u + "1") < 0, c(u + "0") / (c(u + "0") - c(u + "1"))).otherwise(F.lit(0.0))

    def height(s: Column) -> Column:
        line = lambda u: c(u + "0") + (c(u + "1") - c(u + "0")) * s
        return F.least(line("_ta"), line("_tb")) - F.greatest(line("_ba"), line("_bb"))

    def positive(u: Column, v: Column, share: Column) -> Column:
        hi, lo = F.greatest(u, v), F.least(u, v)
        return share * F.when(lo >= 0, (u + v) / 2).when(hi <= 0, F.lit(0.0)).otherwise(hi * hi / (2 * (hi - lo)))

    # one select: a name stands for a column made before it, each step becoming a projection
    steps = {"_xa": F.greatest(c(a["x0"]), c(b["x0"])), "_xb": F.least(c(a["x1"]), c(b["x1"]))}
    for who, t in (("a", a), ("b", b)):
        for line in "bt":
            steps |= {f"_{line}{who}{end}": at(t, line + "0", line + "1", c("_x" + x)) for end, x in (("0", "a"), ("1", "b"))}
    steps |= {f"_d{k}{end}": c(f"_{k}a{end}") - c(f"_{k}b{end}") for k in "bt" for end in "01"}
    steps |= {"_ct": crossing("_dt"), "_cb": crossing("_db")}
    steps |= {"_s1": F.least(c("_ct"), c("_cb")), "_s2": F.greatest(c("_ct"), c("_cb"))}
    steps |= {"_u0": height(F.lit(0.0)), "_u1": height(c("_s1")), "_u2": height(c("_s2")), "_u3": height(F.lit(1.0))}
    area = positive(c("_u0"), c("_u1"), c("_s1")) + positive(c("_u1"), c("_u2"), c("_s2") - c("_s1")) + positive(c("_u2"), c("_u3"), 1 - c("_s2"))
    slack = F.greatest(*[F.abs(c(x)) for x in ("_ta0", "_tb0", "_ba1", "_bb1")]) * TOUCH_SLACK
    steps["area_ab"] = F.when(c("_xb") > c("_xa"), (c("_xb") - c("_xa")) * area).otherwise(F.lit(0.0))
    steps["touch"] = (c("_xa") <= c("_xb")) & (F.greatest(c("_u0"), c("_u1"), c("_u2"), c("_u3")) >= -slack)
    return df.select(*df.columns, *[v.alias(k) for k, v in steps.items()]).select(*df.columns, "area_ab", "touch")


# ------------------------------------------------------------------ zone decomposition
def _frames(rows, columns, at_once: int = 20_000):
    """DataFrames of at most ``at_once`` of the rows, so a large zone is never held as a whole."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= at_once:
            yield pd.DataFrame(held, columns=columns)
            held = []
    yield pd.DataFrame(held, columns=columns)


def _block_batches(size: float):
    def rows(batches):
        for pdf in batches:
            for zid, rings in zip(pdf["id"].to_numpy(), pdf["rings"]):
                for bx, by, kind, clip, segs in K.decompose(K.to_rings(rings), size):
                    yield zid, bx, by, (None if kind == 0 else K.from_rings(clip)), (None if kind == 0 else segs.tolist())

    return lambda batches: _frames(rows(batches), ["zone_id", "bx", "by", "rings", "segs"], 500)


def _cell_batches(cell: float):
    def rows(batches):
        for pdf in batches:
            for zid, rings, segs in zip(pdf["zone_id"].to_numpy(), pdf["rings"], pdf["segs"]):
                segs = np.array([list(x) for x in segs], float).reshape(-1, 4)
                for cx, cy, kind, clip, own in K.decompose(K.to_rings(rings), cell, segs):
                    if kind == 0:
                        x0, y0, x1, y1 = cx * cell, cy * cell, (cx + 1) * cell, (cy + 1) * cell
                        yield zid, cx, cy, 0, x0, y0, x1, y1, y0, y0, y1, y1
                        continue
                    pieces = K.trapezoids(clip, own)
                    if clip:  # parts of the zone that only touch the cell's border
                        edge = np.array([cx, cy, cx + 1, cy + 1], float) * cell
                        on = [(own[:, k] == v) & (own[:, k + 2] == v) for k, v in ((0, edge[0]), (0, edge[2]), (1, edge[1]), (1, edge[3]))]
                        pieces = np.concatenate([pieces, K.trapezoids([], own[np.any(on, axis=0)])])
                    for x0, x1, b0, b1, t0, t1 in pieces.tolist():
                        yield zid, cx, cy, kind, x0, min(b0, b1), x1, max(t0, t1), b0, b1, t0, t1

    return lambda batches: _frames(rows(batches), ["zone_id", "cx", "cy", *PIECE])


def zone_cells(zones: DataFrame, cell: float) -> DataFrame:
    """Per-cell pieces of a zone layer (id, rings): trapezoids that together are the zone's part of the cell.

    A zone is first cut into blocks of ``BLOCK`` x ``BLOCK`` cells; full blocks become cells by ``sequence`` in the JVM, the others
    are dealt over tasks and cut into cells there. So one very large zone keeps many tasks busy.
    """
    c = F.col
    blocks = materialize(zones.select("id", "rings").mapInPandas(_block_batches(float(cell) * BLOCK), BLOCK_SCHEMA))
    span = lambda b: F.explode(F.sequence(c(b) * BLOCK, c(b) * BLOCK + BLOCK - 1))
    full = blocks.where(c("rings").isNull() & c("segs").isNull()).select("zone_id", span("bx").alias("cx"), "by").select("zone_id", "cx", span("by").alias("cy"))
    s = F.lit(float(cell))
    x0, y0, x1, y1 = c("cx") * s, c("cy") * s, (c("cx") + 1) * s, (c("cy") + 1) * s
    full = full.select("zone_id", "cx", "cy", F.lit(0).alias("kind"), x0.alias("q_minx"), y0.alias("q_miny"), x1.alias("q_maxx"), y1.alias("q_maxy"),
                       y0.alias("b0"), y0.alias("b1"), y1.alias("t0"), y1.alias("t1"))
    part = blocks.where(c("segs").isNotNull()).repartition("zone_id", "bx", "by").select("zone_id", "rings", "segs")
    return full.unionByName(part.mapInPandas(_cell_batches(float(cell)), ZONE_CELL_SCHEMA))


# ------------------------------------------------------------------ zone × feature measures
def _mean_clamp(a: Column, b: Column, h: Column) -> Column:
    """Mean over a straight line from ``a`` to ``b`` of the value cut to [0, h]."""
    def upto(t):  # integral of the cut value from 0
        return F.when(t <= 0, F.lit(0.0)).when(t <= h, t * t / 2).otherwise(h * t - h * h / 2)

    lo, hi = F.least(a, b), F.greatest(a, b)
    return F.when(lo >= h, h).when(hi <= 0, F.lit(0.0)).when((lo >= 0) & (hi <= h), (a + b) / 2).otherwise((upto(b) - upto(a)) / (b - a))


def _piece_measures() -> tuple[Column, Column]:
    """Area of feature box ∩ piece, and whether the closed sets meet, for candidate rows whose closed bboxes meet."""
    c = F.col
    xa, xb = F.greatest(c("minx"), c("q_minx")), F.least(c("maxx"), c("q_maxx"))
    width = c("q_maxx") - c("q_minx")

    def at(y0, y1, x):
        return F.when(width > 0, c(y0) + (c(y1) - c(y0)) * (x - c("q_minx")) / width).otherwise(c(y0))

    h = c("maxy") - c("miny")
    top = _mean_clamp(at("t0", "t1", xa) - c("miny"), at("t0", "t1", xb) - c("miny"), h)
    bottom = _mean_clamp(at("b0", "b1", xa) - c("miny"), at("b0", "b1", xb) - c("miny"), h)
    area = F.when(xb > xa, (xb - xa) * (top - bottom)).otherwise(F.lit(0.0))

    def where_at_least(ya, yb):
        """Part of [xa, xb] on which a line with these end values is not negative: (from, to), from > to if none."""
        cross = xa + (xb - xa) * ya / (ya - yb)
        return (F.when(ya >= 0, xa).when(yb >= 0, cross).otherwise(F.lit(1.0)), F.when(yb >= 0, xb).when(ya >= 0, cross).otherwise(F.lit(0.0)))

    l1, r1 = where_at_least(at("t0", "t1", xa) - c("miny"), at("t0", "t1", xb) - c("miny"))
    l2, r2 = where_at_least(c("maxy") - at("b0", "b1", xa), c("maxy") - at("b0", "b1", xb))
    none = (l1 > r1) | (l2 > r2)
    return area, ~none & (F.greatest(l1, l2) <= F.least(r1, r2))


def _closed_bbox_overlap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    return (ax0 <= bx1) & (bx0 <= ax1) & (ay0 <= by1) & (by0 <= ay1)


def candidates(features: DataFrame, pieces: DataFrame, cell: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Feature cells joined with the zone pieces of the same cell (and the same ``keys``) whose closed bboxes meet."""
    c = F.col
    return cells_of(features, cell).join(pieces, ["cx", "cy", *keys]).where(
        _closed_bbox_overlap(c("minx"), c("miny"), c("maxx"), c("maxy"), c("q_minx"), c("q_miny"), c("q_maxx"), c("q_maxy"))
    )


#: The columns of a zone's piece, as sides.
ZONE_SIDES = dict(zip(SIDES, ("q_minx", "q_maxx", "b0", "b1", "t0", "t1")))


def piece_overlaps(features: DataFrame, pieces: DataFrame, cell: float, keep: tuple[str, ...], keys: tuple[str, ...] = (), with_touch: bool = True) -> DataFrame:
    """(fid, f_area, area_in, touch, *``keep``) for every piece of a feature and every zone piece near it.

    ``keep``: columns of ``pieces``; ``keys``: columns of both that must be equal. Rectangles are measured against the zone's trapezoids, other
    features as trapezoids; that branch is empty, and planned away, for a layer of boxes.
    """
    c = F.col
    base = features.select(c("id").alias("fid"), c("area").alias("f_area"), "rings", "minx", "miny", "maxx", "maxy", "is_rect", *keys)
    area, touch = _piece_measures()
    fast = candidates(base.where(c("is_rect")).drop("rings"), pieces, cell, keys).select(
        "fid", "f_area", area.alias("area_in"), (touch if with_touch else F.lit(True)).alias("touch"), *keep)
    cut = feature_pieces(base.where(~c("is_rect")), "f_")
    slow = with_overlap(candidates(cut, pieces, cell, keys), {k: "f_" + k for k in SIDES}, ZONE_SIDES)
    return fast.unionByName(slow.select("fid", "f_area", c("area_ab").alias("area_in"), "touch", *keep))


def zone_measures(features: DataFrame, zones: DataFrame, cell: float, with_touch: bool = False,
                  zone_pieces: DataFrame | None = None) -> DataFrame:
    """(fid, zone_id, f_area, area_in, touch) for every feature/zone pair whose closed sets meet.

    ``features``/``zones``: layers (``as_layer``/``box_layer``). ``area_in`` = area(feature ∩ zone).
    """
    c = F.col
    pieces = zone_pieces if zone_pieces is not None else materialize(zone_cells(zones, cell))
    per_pair = piece_overlaps(features, pieces, cell, ("zone_id",), with_touch=with_touch).groupBy("fid", "zone_id").agg(
        F.max("f_area").alias("f_area"), F.sum("area_in").alias("area_in"), F.max(F.col("touch").cast("int")).cast("boolean").alias("touch")
    )
    if not with_touch:
        return per_pair.where(c("area_in") > 0)
    return per_pair.where(c("touch") | (c("area_in") > 0)).withColumn("touch", F.lit(True))


def _union_in_cell(keys: list[str]):
    """Trapezoids of several zones in one cell → disjoint trapezoids of their union."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        t = K.union_trapezoids(group[["q_minx", "q_maxx", "b0", "b1", "t0", "t1"]].to_numpy(float))
        out = pd.DataFrame(t, columns=["q_minx", "q_maxx", "b0", "b1", "t0", "t1"])
        out["q_miny"], out["q_maxy"] = t[:, 2:4].min(1, initial=np.inf), t[:, 4:].max(1, initial=-np.inf)
        for k in keys:
            out[k] = group[k].iloc[0]
        return out

    return run


def union_pieces(pieces: DataFrame, *keys: str) -> DataFrame:
    """Disjoint pieces (*``keys``, cx, cy, bbox, sides) of the union of the zones that share the ``keys``, cell by cell.

    ``pieces``: ``zone_cells`` output with the key columns. A cell that one zone reaches alone passes as it is, one that some zone
    fills is one full piece; only cells shared by several zones are worked out, each from the few trapezoids it holds.
    """
    c = F.col
    at = [*keys, "cx", "cy"]
    shape = ["q_minx", "q_miny", "q_maxx", "q_maxy", "b0", "b1", "t0", "t1"]
    marks = pieces.groupBy(*at).agg(F.min("kind").alias("_least"), (F.min("zone_id") != F.max("zone_id")).alias("_many"))
    marked = pieces.join(marks, at)
    full = marked.where((c("_least") == 0) & (c("kind") == 0)).dropDuplicates(at).select(*at, *shape)
    single = marked.where((c("_least") > 0) & ~c("_many")).select(*at, *shape)
    shared = marked.where((c("_least") > 0) & c("_many") & (c("q_maxx") > c("q_minx"))).select(*at, *shape)
    joined = shared.groupBy(*at).applyInPandas(_union_in_cell(at), shared.schema)
    return full.unionByName(single).unionByName(joined)


def within_pairs(features: DataFrame, zones: DataFrame, cell: float, zone_pieces: DataFrame | None = None) -> DataFrame:
    """(fid, zone_id) where the feature lies within the zone (boundary contact allowed)."""
    m = zone_measures(features, zones, cell, with_touch=False, zone_pieces=zone_pieces)
    return m.where((F.col("f_area") > 0) & (F.col("area_in") >= F.col("f_area") * (1 - K.EPS_REL))).select("fid", "zone_id")


def intersect_pairs(features: DataFrame, zones: DataFrame, cell: float, zone_pieces: DataFrame | None = None) -> DataFrame:
    """(fid, zone_id) where the closed feature and zone share a point."""
    return zone_measures(features, zones, cell, with_touch=True, zone_pieces=zone_pieces).select("fid", "zone_id")


# ------------------------------------------------------------------ feature × feature pairs
def geometry_key(layer: DataFrame) -> list[Column]:
    """Columns that are equal exactly for equal geometries: the bbox, and the rings of what is no rectangle."""
    return [F.col(x) for x in ("minx", "miny", "maxx", "maxy")] + [F.when(~F.col("is_rect"), F.col("rings")).alias("shape")]


def by_geometry(layer: DataFrame, *keys: str, **aggs: Column) -> DataFrame:
    """One row per distinct (``keys``, geometry): ``id`` is the smallest id, ``aggs`` are aggregated."""
    grouped = layer.groupBy(*keys, *geometry_key(layer)).agg(
        F.min("id").alias("id"), F.first("is_rect").alias("is_rect"), F.first("area").alias("area"), *[v.alias(k) for k, v in aggs.items()])
    return grouped.withColumnRenamed("shape", "rings")


def join_geometry(layer: DataFrame, found: DataFrame, keys: tuple[str, ...], values: list[str]) -> DataFrame:
    """``layer`` with the columns ``values`` of ``found`` (``by_geometry`` output), joined by keys and geometry."""
    names = [*keys, "minx", "miny", "maxx", "maxy"]
    right = found.select(*[F.col(n).alias("_g_" + n) for n in names], F.col("rings").alias("_g_shape"), *values)
    left = layer.withColumn("_shape", F.when(~F.col("is_rect"), F.col("rings")))
    cond = F.col("_shape").eqNullSafe(F.col("_g_shape"))
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col("_g_" + n))
    return left.join(right, cond, "left").select(*layer.columns, *values)


def _prefixed(rows: DataFrame, prefix: str, cell: float, tree: CellTree | None) -> DataFrame:
    """Rows in their leaves; all columns but the leaf's carry ``prefix``."""
    rows = leaves_of(rows, cell, tree)
    return rows.select("level", "lx", "ly", *[F.col(x).alias(prefix + x) for x in rows.columns if x not in ("level", "lx", "ly")])


def feature_pairs(a: DataFrame, b: DataFrame, cell: float, with_touch: bool = False, condition=None,
                  a_keep=(), b_keep=(), tree: CellTree | None = None) -> DataFrame:
    """(a_id, b_id, area_ab, touch, *keeps) for pairs of layers ``a`` × ``b`` whose closed bboxes meet.

    ``condition``: extra predicate on prefixed columns (e.g. load order). ``tree``: cells that hold much are split (``cell_tree``).
    Pairs of pieces are kept only in the leaf of the bbox-intersection low corner, so each is measured once; the pieces of a pair
    of features are summed where one of them is no rectangle. Rectangles and other features are told apart before the join, so
    no pair is met in two branches. Pairs whose closed sets do not meet are dropped (area 0 and no touch, or area 0 when
    ``with_touch`` is False).
    """
    c = F.col

    def halves(layer: DataFrame, prefix: str, keep) -> list[DataFrame]:
        rows = layer.select("id", "rings", "minx", "miny", "maxx", "maxy", "is_rect", *keep)
        return [_prefixed(f(rows, "s_"), prefix, cell, tree) for f in (_whole_pieces, _cut_pieces)]

    side = F.lit(float(cell)) if tree is None else tree.side(c("level"))
    lox, loy = F.greatest(c("a_minx"), c("b_minx")), F.greatest(c("a_miny"), c("b_miny"))

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        j = x.join(y, ["level", "lx", "ly"])
        if condition is not None:
            j = j.where(condition)
        return j.where(
            _closed_bbox_overlap(c("a_minx"), c("a_miny"), c("a_maxx"), c("a_maxy"), c("b_minx"), c("b_miny"), c("b_maxx"), c("b_maxy"))
            & (F.floor(lox / side) == c("lx")) & (F.floor(loy / side) == c("ly"))
        )

    (a_rect, a_cut), (b_rect, b_cut) = halves(a, "a_", a_keep), halves(b, "b_", b_keep)
    keep_names = [f"a_{k}" for k in a_keep] + [f"b_{k}" for k in b_keep]
    ox, oy = F.least(c("a_maxx"), c("b_maxx")) - lox, F.least(c("a_maxy"), c("b_maxy")) - loy
    rect_area = F.when((ox > 0) & (oy > 0), ox * oy).otherwise(F.lit(0.0))
    out = met(a_rect, b_rect).select("a_id", "b_id", rect_area.alias("area_ab"), F.lit(True).alias("touch"), *keep_names)
    slow = met(a_cut, b_rect).unionByName(met(a_rect, b_cut)).unionByName(met(a_cut, b_cut))
    cut = with_overlap(slow, *({k: f"{p}_s_{k}" for k in SIDES} for p in "ab"))
    summed = cut.groupBy("a_id", "b_id", *keep_names).agg(F.sum("area_ab").alias("area_ab"), F.max("touch").alias("touch"))
    out = out.unionByName(summed.select(*out.columns))
    if with_touch:
        return out.where(c("touch") | (c("area_ab") > 0))
    return out.where(c("area_ab") > 0)


# ------------------------------------------------------------------ features covered by another one
#: Relative slack of bounds, so that rounding never decides: what they leave open is measured.
BOUND_SLACK = 1e-9
CORE_SLACK = 1e-6


def with_gap(layer: DataFrame) -> DataFrame:
    """``layer`` with ``gap``: at most how much of its bbox a feature leaves free (0 for a rectangle)."""
    c = F.col
    box = (c("maxx") - c("minx")) * (c("maxy") - c("miny"))
    free = (box - geo.trapezoids_area(geo.trapezoids("rings"))) * (1 + BOUND_SLACK) + box * BOUND_SLACK
    return layer.withColumn("gap", F.when(c("is_rect"), F.lit(0.0)).otherwise(free))


def covered(a: DataFrame, b: DataFrame, cell: float, ratio: float, at_least: bool = False, a_keep=(), b_keep=(),
            match=(), condition=None, tree: CellTree | None = None) -> DataFrame:
    """Distinct (id, *``a_keep``) of the features of ``a`` of whose area one feature of ``b`` covers more than ``ratio`` (``at_least``: or just that).

    ``match``: (column of ``a``, column of ``b``) that must be equal, also named in the keeps; ``condition``: predicate on prefixed columns.

    What covers that share of a feature meets the core of its bbox, what is left when a margin is taken off: to share an area A within a
    bbox of height h, an overlap is at least A / h wide. So a feature of ``a`` stands in the leaves of its core (for a rectangle and
    half its area, its middle), not in all that it meets. The join is a semi join, which ends at the first feature found: its work does not grow
    with the number of pairs where many cover each other. Bboxes decide rectangles, and other features where bounds of the area do; what is
    left open by them is measured piece by piece (``feature_pairs``). A layer that is stored may bring its ``gap`` (``with_gap``).
    """
    c = F.col
    names = ["id", *a_keep]
    a, b = (x if "gap" in x.columns else with_gap(x) for x in (a, b))
    a = a.where(c("area") > 0)
    width, height = c("maxx") - c("minx"), c("maxy") - c("miny")
    margin = lambda extent, other: F.coalesce(F.least(extent / 2, F.try_divide(c("area") * ratio, other) * (1 - CORE_SLACK)), F.lit(0.0))
    whole = {"w_" + x: c(x) for x in ("minx", "miny", "maxx", "maxy")}
    bounds = ["area", "is_rect", "gap", "minx", "miny", "maxx", "maxy"]
    asked = a.select(*names, *bounds).withColumns({**whole, "_mx": margin(width, height), "_my": margin(height, width)})
    asked = asked.withColumns({"minx": c("minx") + c("_mx"), "miny": c("miny") + c("_my")}).withColumns(
        {"maxx": F.greatest(c("maxx") - c("_mx"), c("minx")), "maxy": F.greatest(c("maxy") - c("_my"), c("miny"))}).drop("_mx", "_my")
    asked = _prefixed(asked, "a_", cell, tree).drop("a_minx", "a_miny", "a_maxx", "a_maxy")
    given = _prefixed(b.select("id", *b_keep, *bounds).withColumns(whole), "b_", cell, tree).drop("b_minx", "b_miny", "b_maxx", "b_maxy", "b_area")
    given = given.withColumnsRenamed({"level": "b_level", "lx": "b_lx", "ly": "b_ly"})

    enough = lambda area: (area > 0) & ((area / c("a_area") >= ratio) if at_least else (area > F.lit(ratio) * c("a_area")))
    ox = F.least(c("a_w_maxx"), c("b_w_maxx")) - F.greatest(c("a_w_minx"), c("b_w_minx"))
    oy = F.least(c("a_w_maxy"), c("b_w_maxy")) - F.greatest(c("a_w_miny"), c("b_w_miny"))
    box = F.when((ox > 0) & (oy > 0), ox * oy).otherwise(F.lit(0.0))
    mine = reduce(lambda p, q: p & q, [c("a_" + x) == c("b_" + y) for x, y in match] + ([condition] if condition is not None else []) or [F.lit(True)])
    at = (c("level") == c("b_level")) & (c("lx") == c("b_lx")) & (c("ly") == c("b_ly")) & mine

    def found(rows: DataFrame, test: Column) -> DataFrame:
        return rows.join(given, at & test, "left_semi").select(*[c("a_" + n).alias(n) for n in names]).distinct()

    sure = found(asked, enough(box - c("a_gap") - c("b_gap")))
    if not any(x.where(~c("is_rect")).limit(1).count() for x in (a, b)):
        return sure
    sure = materialize(sure)
    possible = enough(box * (1 + BOUND_SLACK))
    undecided = asked.join(sure.select(*[c(n).alias("a_" + n) for n in names]), ["a_" + n for n in names], "left_anti")
    maybe = materialize(found(undecided, possible & ~(c("a_is_rect") & c("b_is_rect"))))
    keep = [*whole]
    pairs = feature_pairs(a.join(maybe, names, "left_semi").withColumns(whole), b.withColumns(whole), cell, condition=mine & possible,
                          a_keep=(*a_keep, "area", *keep), b_keep=(*b_keep, *keep), tree=tree)
    measured = pairs.where(enough(c("area_ab"))).select(*[c("a_" + n).alias(n) for n in names])
    return sure.unionByName(measured).distinct()
