"""Replacing one run of the stored detections equals loading everything anew, and touches only the tiles around the change."""

import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_polygons import polygons
from vigie.functions import geo
from vigie.functions import kernel as K
from vigie.operators import spatial
from vigie.operators.reload import DetectionStore
from vigie.plans import cells as C
from vigie.sources.named import NamedTables

CELL, SIDE = 12.0, 20.0


def detections(spark, shapes, seqs, first=1):
    rows = [(i, K.from_rings(s), int(q)) for i, (s, q) in enumerate(zip(shapes, seqs), first)]
    df = spark.createDataFrame(rows, f"id long, rings {geo.RINGS_TYPE}, load_seq long")
    lay = C.as_layer(df, "id", keep=("load_seq",))
    return C.materialize(lay.select("*", F.lit(0.5).alias("score"), F.lit("piscine").alias("object_type"), F.col("load_seq").alias("geozone_id"),
                                    F.lit(2015).alias("batch_year"), F.lit("P1").alias("id_parcellaire")))


def flagged(rows):
    flags = spatial.first_detection(spatial.spots_in_order(rows), CELL, "load_seq").select("id", "load_seq", "first_detection")
    return C.materialize(rows.join(flags, ["id", "load_seq"]))


def key(df):
    return sorted((r["id"], r["load_seq"], r["first_detection"]) for r in df.select("id", "load_seq", "first_detection").collect())


def territory(spark, x0, y0, x1, y1):
    return C.box_layer(spark.createDataFrame([(1, x0, y0, x1, y1)], "id long, minx double, miny double, maxx double, maxy double"), "id")


@pytest.fixture
def world(spark, tmp_path):
    """Four runs over a wide field; run 2 fills the square 100..160."""
    shapes = polygons(31, 900, 5.0, 300)
    inside = [all(100 <= p[0] <= 160 and 100 <= p[1] <= 160 for ring in s for p in ring) for s in shapes]
    rng = np.random.default_rng(32)
    seqs = [2 if ok and i % 2 else int(rng.choice([1, 3, 4])) for i, ok in enumerate(inside)]
    shapes += [shapes[i] for i in range(200)]  # copies in later runs
    seqs += [4] * 200
    rows = detections(spark, shapes, seqs)
    store = DetectionStore(NamedTables(spark, f"file://{tmp_path}/t"), "det", SIDE, CELL, buckets=64)
    store.create()
    store.load(flagged(rows))
    return rows, store


def test_replaced_run_equals_a_full_load(spark, world):
    rows, store = world
    assert key(store.read()) == key(flagged(rows))
    mine = rows.where("load_seq = 2")
    assert mine.count() > 10
    moved = polygons(33, 60, 6.0, 50)
    new = detections(spark, [[r + 102 for r in s] for s in moved if min(r.min() for r in s) > -2], [2] * len(moved), 5000)
    # half of the old rows stay, new ones come
    new = C.materialize(new.where("maxx <= 160 and maxy <= 160 and minx >= 100 and miny >= 100").unionByName(mine.where("id % 4 = 1")))
    store.replace_run(new, 2, territory(spark, 100.0, 100.0, 160.0, 160.0))
    want = flagged(C.materialize(rows.where("load_seq <> 2").unionByName(new.select(*rows.columns))))
    assert key(store.read()) == key(want)
    before, after = dict((r[0:2], r[2]) for r in key(flagged(rows))), dict((r[0:2], r[2]) for r in key(want))
    assert any(before[k] != after[k] for k in set(before) & set(after) if k[1] > 2)  # a later run's flag did change
    # replaying the same run leaves the same rows; an empty run takes its rows away
    store.replace_run(new, 2, territory(spark, 100.0, 100.0, 160.0, 160.0))
    assert key(store.read()) == key(want)
    store.replace_run(new.limit(0), 2, territory(spark, 100.0, 100.0, 160.0, 160.0))
    assert key(store.read()) == key(flagged(C.materialize(rows.where("load_seq <> 2"))))


def test_far_tiles_are_neither_read_nor_written(spark, world):
    rows, store = world
    t = store.tables.table("det")
    close = spark.createDataFrame([(x, y) for x in range(2, 12) for y in range(2, 12)], "tx long, ty long")  # 100..160, two tiles around and one more
    near = {r[0] for r in close.select(store.tables._bucket(t)).distinct().collect()}
    spoiled = [b for b in t.folders if b not in near]
    assert len(spoiled) >= 5
    for b in spoiled:
        for f in glob.glob(t.folders[b].removeprefix("file://") + "/*.parquet"):
            open(f, "wb").close()
    store.replace_run(rows.where("load_seq = 2 and id % 3 <> 0"), 2, territory(spark, 100.0, 100.0, 160.0, 160.0))
    after = store.tables.table("det")
    assert all(after.folders[b] == t.folders[b] for b in spoiled) and after.version == t.version + 1


def test_wrong_rows_are_refused(spark, world):
    rows, store = world
    place = territory(spark, 100.0, 100.0, 160.0, 160.0)
    for bad, say in ((rows.where("load_seq = 3"), "another run"), (rows.where("load_seq = 2").withColumns({"minx": F.lit(0.0), "maxx": F.lit(4.0)}), "outside"),
                     (rows.where("load_seq = 2").withColumn("maxx", F.lit(400.0)), "larger than a tile")):
        with pytest.raises(ValueError, match=say):
            store.replace_run(bad, 2, place)
    assert store.tables.table("det").version == 1


def test_flags_of_a_replaced_run_come_from_a_search(spark, tmp_path):
    """Rows are told covered by a semi join that ends at the first feature found, not by a list of the pairs that meet."""
    box = lambda x, y: [np.array([(x, y), (x + 6, y), (x + 6, y + 6), (x, y + 6)], float)]
    rows = detections(spark, [box(100 + i % 7, 100 + i % 5) for i in range(140)], [1 + i % 3 for i in range(140)])
    store = DetectionStore(NamedTables(spark, f"file://{tmp_path}/t"), "det", SIDE, CELL, buckets=4)
    every = C.materialize(store._tiled(rows.withColumn("first_detection", F.lit(True))))
    out = store._flagged(every, every, 2)
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    leaf = [x for x in joins if "lx#" in x]
    assert len(leaf) == 1 and "Join LeftSemi" in leaf[0]
    want = {(r["id"], r["load_seq"]): r["first_detection"] for r in flagged(rows).where("load_seq >= 2").collect()}
    assert {(r["id"], r["load_seq"]): r["first_detection"] for r in out.where("load_seq >= 2").collect()} == want
