"""Cases outside the friendly fixtures: size, orientation, overlaps, replays, missing folders."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from vigie.functions import geo
from vigie.functions.text import normalize_text
from vigie.operators import loads, spatial
from vigie.plans import cells as C
from vigie.plans.ids import surrogate_ids
from vigie.plans.nulls import not_in
from vigie.sources import layers, sinks
from vigie.sources.fixtures import Fixtures
from vigie.streaming.incremental import append_batch

RINGS = geo.RINGS_TYPE


def ring(*points):
    return [[{"x": float(x), "y": float(y)} for x, y in points]]


def square(x, y, s=2, clockwise=False):
    p = [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    return ring(*(p[::-1] if clockwise else p))


def layer(spark, shapes):
    return C.as_layer(spark.createDataFrame([(i, s) for i, s in enumerate(shapes, 1)], f"id long, rings {RINGS}"), "id")


def test_surrogate_ids_beyond_the_range_sample(spark):
    n = 1_200_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), F.concat(F.lit("payload-"), F.col("id").cast("string")).alias("p"))
    ids = surrogate_ids(df, [F.col("k"), F.col("p")], offset=55, partitions=8).select("id", "k")
    r = ids.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(r) == (n, n, 55, 54 + n)


def test_not_in(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a long")
    for right, want in (([(2,)], {1}), ([(2,), (None,)], set()), ([], {1, 2, None})):
        got = {r["a"] for r in not_in(left, "a", spark.createDataFrame(right, "b long"), "b").collect()}
        assert got == want


@pytest.mark.parametrize("clockwise", [False, True])
def test_orientation_does_not_matter(spark, clockwise):
    zones = layer(spark, [square(0, 0, 10, clockwise)])
    outer = square(0, 0, 10, clockwise)
    holed = layer(spark, [outer + square(4, 4, 2, clockwise)])
    feats = layer(spark, [square(1, 1, 2, clockwise), square(9, 9, 2, clockwise), ring((3, 3), (6, 3), (4.5, 6)) if clockwise else ring((3, 3), (4.5, 6), (6, 3))])
    tag = lambda z: {r["id"] for r in spatial.zone_tag(feats, z, 3.0).collect()}
    assert tag(zones) == {1, 3}
    assert tag(holed) == {1}
    assert holed.first()["area"] == 96
    flags = {r["id"]: r["first_detection"] for r in spatial.first_detection(layer(spark, [square(0, 0, 2, clockwise), square(0, 0, 2, not clockwise)]).withColumn("load_seq", F.col("id")), 3.0).collect()}
    assert flags == {1: True, 2: False}
    det = feats.withColumn("tile_set_id", F.lit(1))
    links = spark.createDataFrame([(1, 1)], "tileset_id int, geozone_id long")
    assert {r["id"] for r in spatial.outside_bounds(det, links, zones, 3.0).collect()} == {2}
    parcels = zones.withColumn("id_parcellaire", F.lit("P"))
    assert {r["id"]: r["id_parcellaire"] for r in spatial.match_parcel(feats, parcels, 3.0).collect()} == {1: "P", 2: "P", 3: "P"}


def test_geometry_without_area_is_listed(spark):
    shapes = layer(spark, [square(0, 0), ring((0, 0), (1, 1), (2, 2))])
    assert [r["id"] for r in C.degenerate(shapes).collect()] == [2]
    assert {r["fid"] for r in C.within_pairs(shapes, layer(spark, [square(-1, -1, 9)]), 2.0).collect()} == {1}


@pytest.mark.parametrize("shapes, area, perimeter, rings", [
    ([square(0, 0), square(1, 0)], 6, 10, 1),  # overlap
    ([square(0, 0), square(2, 1)], 8, 14, 1),  # T-junction
    ([square(0, 0), square(2, 0, 1), square(2, 1, 1)], 6, 10, 1),
    ([square(0, 0, 4), square(1, 1, 1)], 16, 16, 1),  # one inside the other
    ([square(0, 0, 1), square(5, 5, 1)], 2, 8, 2),
    ([ring((0, 0), (6, 0), (6, 6), (0, 6)) + square(2, 2, 2, True)], 32, 32, 2),
])
@pytest.mark.parametrize("cell", [1.0, 1.7, 64.0, None])
def test_union(spark, shapes, area, perimeter, rings, cell):
    boundary = spatial.dissolve(layer(spark, shapes), cell=cell)
    m = spatial.edge_measures(boundary, "group_id").first()
    assert (round(m["area"], 9), round(m["perimeter"], 9)) == (area, perimeter)
    whole = spatial.assemble(boundary).select("rings", geo.area("rings").alias("a")).first()
    assert round(whole["a"], 9) == area and len(whole["rings"]) == rings


def test_ingest_quarantines_and_replaces_by_name(spark):
    rows = [("a", 4326, square(0, 0)), ("a", 4326, square(1, 0, clockwise=True)), ("a", 4326, ring((0, 0), (1, 1), (2, 2))), ("b", 3857, square(0, 0)), ("c", 4326, None), ("a", 4326, ring((0, 0), (1, 1)))]
    zone, bad = spatial.ingest_layer(spark.createDataFrame(rows, f"file string, srid int, rings {RINGS}"), "z", cell=2.0)
    assert round(zone.first()["area"], 9) == 6
    assert sorted((r["file"], r["reason"]) for r in bad.collect()) == [("a", "invalid ring"), ("a", "no area"), ("b", "unsupported srid"), ("c", "no geometry")]
    old = zone.withColumn("area", F.lit(1.0)).unionByName(zone.withColumn("name", F.lit("other")))
    got = sinks.replace_by_key(old, zone, "name")
    assert sorted((r["name"], round(r["area"], 9)) for r in got.collect()) == [("other", 6), ("z", 6)]


def test_features_without_id(spark):
    rows = [(1, "a", "a", "01", square(0, 0)), (None, "b", "b", "02", square(3, 0)), (None, "c", "c", "03", square(6, 0)), (2, "d", "d", "04", square(9, 0))]
    got = spatial.zone_features(spark.createDataFrame(rows, f"id long, name string, name_normalized string, insee_code string, rings {RINGS}").repartition(4)).collect()
    assert sorted(r["name"] for r in got) == ["a", "b", "c", "d"]
    assert len({r["feature_id"] for r in got}) == 4
    for r in got:
        assert f'"name": "{r["name"]}"' in r["geojson"]
    assert {r["feature_id"] for r in got if r["name"] in "ad"} == {1, 2}


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    first, second = layer(spark, [square(0, 0), square(5, 5)]), layer(spark, [square(0, 0), square(9, 9)])
    for b, df in ((0, first), (1, second), (1, second), (0, first)):
        append_batch(df, path, 3.0, b)
    got = spark.read.parquet(path)
    assert got.count() == 4
    assert sorted((r["load_batch"], r["minx"], r["first_detection"]) for r in got.collect()) == [(0, 0.0, True), (0, 5.0, True), (1, 0.0, False), (1, 9.0, True)]


def test_a_broken_table_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        append_batch(layer(spark, [square(0, 0)]), str(tmp_path / "t"), 3.0, 0)


def test_loads_one_by_one_equal_one_pass(spark):
    fx = Fixtures(spark, SMALL)
    from vigie import registry

    args = registry._load_inputs(fx)
    whole = spatial.load_detections(**args)
    want = {(r["id"], r["load_seq"]): r["first_detection"] for r in whole.collect()}
    got, existing = {}, None
    for lo, hi in ((0, 80), (80, 130), (130, 10**9)):  # three loads, in the order the runs are committed in
        part = spatial.load_detections(**{**args, "configs": args["configs"].where(F.col("load_seq").between(lo, hi - 1))}, existing=existing).cache()
        got |= {(r["id"], r["load_seq"]): r["first_detection"] for r in part.collect()}
        existing = part if existing is None else existing.unionByName(part)
    assert got == want and len(want) > 0


def test_load_never_pairs_a_detection_with_every_territory(spark):
    fx = Fixtures(spark, SMALL)
    from vigie import registry

    args = registry._load_inputs(fx)
    tags = spatial.zone_tag(args["inference"], args["zones"], args["cell"])
    rows = spatial._load_rows(args["inference"], tags, args["configs"], ["ze_zone_id", "zr_zone_id", "zan_zone_id"]).count()
    assert rows <= tags.count()


def test_fixtures_grow_with_the_tables(spark):
    small, large = (Fixtures(spark, f"/root/testdata/sf{x}") for x in ("0.001", "0.01"))
    for name in ("fx_hist_det", "fx_history", "fx_user", "fx_hist_object", "fx_layer_box"):
        assert getattr(large, name).count() > 5 * getattr(small, name).count(), name


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_parcel_pairs_follow_the_detections(spark, sf):
    """A detection meets at most four places of the parcel grid, however many parcels lie on each."""
    fx = Fixtures(spark, f"/root/testdata/sf{sf}")
    places, spots = C.by_geometry(layers.parcel_layer(fx.fx_parcel)), C.by_geometry(layers.detection_layer(fx.fx_detection))
    assert C.feature_pairs(spots, places, layers.FIXTURE_PAIR_CELL, with_touch=True).count() <= 4 * spots.count()


def test_accents(spark):
    df = spark.createDataFrame([("Ő Š Łódź Ærø Ñandú été ẞ",)], "s string")
    assert df.select(normalize_text(F.col("s"))).first()[0] == "o s lodz aero nandu ete ss"


def test_repeated_source_codes_do_not_multiply_zones(spark):
    zones = layer(spark, [square(0, 0)]).select(F.col("id"), F.lit("z").alias("name"), F.lit("z").alias("name_normalized"), F.lit("COMMUNE").alias("zone_type"), "rings", "minx", "miny", "maxx", "maxy")
    child = spark.createDataFrame([(1, "34001")], "geozone_ptr_id long, code string")
    src = layer(spark, [square(5, 5), square(7, 7)]).select(F.lit("34001").alias("code"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.lit("34").alias("parent_code"), "rings", "minx", "miny", "maxx", "maxy")
    out, _ = loads.upsert_collectivities(zones, child, src, "COMMUNE")
    assert [(r["id"], r["minx"]) for r in out.collect()] == [(1, 5.0)]


def test_tiles_one_by_one(spark):
    z = layer(spark, [square(2.0, 48.0, 0.01)])
    span = spatial.tile_cover(z, zoom=14).first()
    tiles = spatial.tile_cover(z, zoom=14, explode=True).collect()
    n = (span["max_x_tile"] - span["min_x_tile"] + 1) * (span["max_y_tile"] - span["min_y_tile"] + 1)
    assert len(tiles) == len({(r["x"], r["y"]) for r in tiles}) == n


def test_sinks_and_readers(spark, tmp_path):
    from vigie.sources import readers

    (tmp_path / "s.csv").write_text("a,b\n1,x\n")
    assert readers.read_sheet_export(spark, str(tmp_path / "s.csv")).first()["b"] == "x"
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","id":1,"properties":{"n":"p"},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    assert readers.read_geojson_features(spark, str(tmp_path / "f.json")).first()["properties"]["n"] == "p"
    spark.createDataFrame([(4326, square(0, 0))], f"srid int, rings {RINGS}").write.parquet(str(tmp_path / "layers"))
    assert "layers" in readers.read_layer_folder(spark, str(tmp_path / "layers")).first()["file"]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.append(df, str(tmp_path / "t"), ["k"])
    sinks.overwrite_partitions(spark.createDataFrame([(2, "c")], "k int, v string"), str(tmp_path / "t"), ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, "a"), (2, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    sinks.geojson_lines(spark.createDataFrame([('{"type":"Feature"}',)], "geojson string"), str(tmp_path / "g"))
    assert spark.read.text(str(tmp_path / "g")).first()[0] == '{"type":"Feature"}'


def test_checkpoint_folder_is_asked_for_on_a_cluster(spark):
    from vigie import session

    class Conf(dict):
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

        def set(self, key, value):
            raise AssertionError

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_runs_from_another_folder(tmp_path):
    """The package reaches the workers when only the driver can import it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as e
from vigie.session import local_session
print(e.queries()["S11_zone_surface"](local_session(2, 2), {SMALL!r}).count(), e.queries()["S4_dissolve"](local_session(2, 2), {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and done.stdout.split()[-2:] == ["25", "5"], done.stderr[-2000:]


def test_ids_start_at_one_in_an_empty_zone_table(spark):
    box = f"id long, name string, name_normalized string, zone_type string, rings {RINGS}, minx double, miny double, maxx double, maxy double"
    zones = spark.createDataFrame([], box)
    child = spark.createDataFrame([], "geozone_ptr_id long, code string")
    src = spark.createDataFrame([("7", "Nord", None, square(0, 0), 0.0, 0.0, 2.0, 2.0), ("8", "Sud", None, square(4, 0), 4.0, 0.0, 6.0, 2.0)],
                                f"code string, name string, parent_code string, rings {RINGS}, minx double, miny double, maxx double, maxy double")
    out, rows = loads.upsert_collectivities(zones, child, src, "REGION", by="name")
    assert sorted((r["id"], r["name"]) for r in out.collect()) == [(1, "Nord"), (2, "Sud")]
    assert sorted((r["geozone_ptr_id"], r["code"]) for r in rows.collect()) == [(1, "7"), (2, "8")]
