"""The loaded detections as a stored table in which one (territory, batch) run can be replaced.

A row's first-detection flag depends on the rows of earlier runs that lie on it. So when a run is replaced, only rows of this and
later runs that meet a geometry which came or went can change. The table is keyed by tile (a square of ``side`` around the low
corner of the bbox; no feature may be larger), so these rows, and those they are compared with, stand in the tiles next to the
changed ones: other tiles are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.geo import RINGS_TYPE
from vigie.operators.spatial import FIRST_RATIO
from vigie.plans import cells as C
from vigie.plans.materialize import materialize
from vigie.sources.named import NamedTables, Table

COLUMNS = (
    "id bigint, score double, object_type string, geozone_id bigint, batch_year int, id_parcellaire string, load_seq bigint, "
    f"rings {RINGS_TYPE}, minx double, miny double, maxx double, maxy double, is_rect boolean, area double, first_detection boolean, "
    "tx bigint not null, ty bigint not null"
)
TILE = ["tx", "ty"]
GEOMETRY = ["minx", "miny", "maxx", "maxy", "shape"]


class DetectionStore:
    """``load_detections`` output under a name; ``side``: tile side, at least the extent of every detection; ``cell``: of the pair index."""

    def __init__(self, tables: NamedTables, name: str, side: float, cell: float, buckets: int = 256):
        self.tables, self.name, self.side, self.cell, self.buckets = tables, name, float(side), cell, buckets

    def create(self) -> Table:
        return self.tables.create(self.name, COLUMNS, key=("tx", "ty"), buckets=self.buckets, if_not_exists=True)

    def read(self) -> DataFrame:
        return self.tables.read(self.name).drop(*TILE)

    def load(self, rows: DataFrame) -> Table:
        """Make ``rows`` (flagged, of all runs) the whole table."""
        return self.tables.refresh(self.name, self._tiled(rows))

    def replace_run(self, rows: DataFrame, load_seq: int, territory: DataFrame) -> Table:
        """Put ``rows`` in the place of the run ``load_seq`` and flag anew what may have changed.

        ``territory``: a layer holding the run's territory; all rows of the run, old and new, lie within it. ``rows`` need no flag.
        """
        c = F.col
        fresh = materialize(self._tiled(rows.withColumn("first_detection", F.lit(None).cast("boolean"))))
        if fresh.where(~c("load_seq").eqNullSafe(F.lit(load_seq))).limit(1).count():
            raise ValueError(f"rows of another run than {load_seq}")
        home = self._tiles(territory, 0)
        if fresh.join(home, TILE, "left_anti").limit(1).count():
            raise ValueError(f"rows of run {load_seq} outside its territory")
        old = materialize(self.tables.read_keys(self.name, home).where(c("load_seq") == load_seq))
        was, now = (self._shapes(x) for x in (old, fresh))
        moved = materialize(was.subtract(now).unionByName(now.subtract(was)))
        # rows that meet a changed geometry have their low corner in its tiles or the ones before
        near = self._tiles(moved, 1).unionByName(fresh.select(*TILE)).unionByName(old.select(*TILE)).distinct()
        near = materialize(near)
        around = near.select(F.explode(F.sequence(c("tx") - 1, c("tx") + 1)).alias("tx"), "ty").select("tx", F.explode(F.sequence(c("ty") - 1, c("ty") + 1)).alias("ty"))
        stored = self.tables.read_keys(self.name, around).where(~c("load_seq").eqNullSafe(F.lit(load_seq)))
        every = materialize(stored.select(*fresh.columns).unionByName(fresh))
        mine = every.join(near, TILE, "left_semi")
        return self.tables.replace(self.name, self._flagged(mine, every, load_seq), keys=near)

    def _flagged(self, rows: DataFrame, every: DataFrame, load_seq: int) -> DataFrame:
        """``rows`` with the flags of this and later runs worked out against ``every``; earlier ones keep theirs."""
        c = F.col
        later = rows.where(c("load_seq") >= load_seq)
        asked = materialize(C.with_gap(C.by_geometry(later, "load_seq")))
        present = materialize(C.with_gap(C.by_geometry(every, seq=F.min("load_seq"))))
        covered = C.covered(asked, present, self.cell, FIRST_RATIO, a_keep=("load_seq",), b_keep=("seq",), condition=c("b_seq") < c("a_load_seq"),
                            tree=C.cell_tree([present], self.cell))
        flags = asked.join(covered.withColumn("_cov", F.lit(True)), ["id", "load_seq"], "left")
        fresh = C.join_geometry(later, flags, ("load_seq",), ["_cov"]).withColumn("first_detection", ~F.coalesce("_cov", F.lit(False))).drop("_cov")
        return rows.where(c("load_seq") < load_seq).unionByName(fresh)

    def _tiled(self, rows: DataFrame) -> DataFrame:
        large = rows.where((F.col("maxx") - F.col("minx") > self.side) | (F.col("maxy") - F.col("miny") > self.side) | F.col("minx").isNull())
        if large.limit(1).count():
            raise ValueError(f"a detection without geometry, or larger than a tile ({self.side})")
        tile = [F.floor(F.col(v) / self.side).alias(t) for v, t in (("minx", "tx"), ("miny", "ty"))]
        names = [x.split()[0] for x in COLUMNS.replace(RINGS_TYPE, "rings").split(", ")][:-2]
        return rows.select(*[F.col("batch_year").cast("int").alias("batch_year") if n == "batch_year" else F.col(n) for n in names], *tile)

    def _tiles(self, layer: DataFrame, before: int) -> DataFrame:
        """Tiles the bboxes of ``layer`` meet, and ``before`` tiles to the left and below."""
        at = lambda v: F.floor(F.col(v) / self.side)
        x = F.explode(F.sequence(at("minx") - before, at("maxx"))).alias("tx")
        return layer.select(x, "miny", "maxy").select("tx", F.explode(F.sequence(at("miny") - before, at("maxy"))).alias("ty")).distinct()

    def _shapes(self, rows: DataFrame) -> DataFrame:
        return rows.select(*C.geometry_key(rows)).select(*GEOMETRY)
