"""Named tables: declared schema, refresh as one switch, replacement by key, failures midway."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from vigie.operators import spatial
from vigie.plans import cells as C
from vigie.sources import analytics
from vigie.sources.named import Conflict, NamedTables, SchemaError

ZONES = "name string not null, size int"


@pytest.fixture
def tables(spark, tmp_path):
    return NamedTables(spark, f"file://{tmp_path}/tables")


def zones(spark, rows):
    return spark.createDataFrame(rows, "name string, size int")


def content(tables, name):
    return sorted(map(tuple, tables.read(name).collect()))


def failing(df, column):
    """``df``, whose rows cannot all be computed."""
    return df.withColumn(column, F.when(F.col(column) > 0, F.expr("raise_error('lost')").cast("int")).otherwise(F.col(column)))


def test_five_tables_are_created_refreshed_and_survive_a_failed_refresh(spark, tables):
    assert [t.name for t in analytics.create_output_tables(tables)] == list(analytics.OUTPUT_TABLES)
    analytics.create_output_tables(tables)  # again: nothing happens
    for name in analytics.OUTPUT_TABLES:
        declared = tables.table(name).columns
        assert tables.read(name).count() == 0 and tables.read(name).columns == declared.names
        row = spark.range(3).select(*[(F.col("id").cast(f.dataType) if f.name == "id" else F.lit(1).cast(f.dataType) if f.dataType.simpleString() in ("int", "bigint", "double", "string", "boolean") else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared])
        tables.refresh(name, row)
        assert tables.read(name).count() == 3 and tables.table(name).version == 1
    rows = tables.read("stats_status_analysis")
    with pytest.raises(Exception, match="lost"):
        tables.refresh("stats_status_analysis", failing(rows, "year"))
    assert tables.read("stats_status_analysis").count() == 3 and tables.table("stats_status_analysis").version == 1


def test_schema_is_checked_before_anything_is_written(spark, tables):
    tables.create("z", ZONES, key=("name",), unique=True, buckets=4)
    bad = [
        (zones(spark, [("a", 1)]).withColumn("more", F.lit(1)), "more is not declared"), (zones(spark, [("a", 1)]).drop("size"), "size is missing"),
        (zones(spark, [("a", 1)]).withColumn("size", F.lit(1).cast("long")), "size is bigint, declared int"), (zones(spark, [(None, 1)]), "null in name"),
        (zones(spark, [("a", 1), ("a", 2)]), "occurs 2 times"),
    ]
    for df, say in bad:
        for write in (tables.refresh, tables.replace):
            with pytest.raises(SchemaError, match=say):
                write("z", df)
    assert tables.table("z").version == 0 and not glob.glob(f"{tables.root[7:]}/z/data/*")
    with pytest.raises(ValueError):
        tables.create("z", ZONES)
    with pytest.raises(SchemaError):
        tables.create("z", "name string", if_not_exists=True)
    with pytest.raises(KeyError):
        tables.read("nothing")
    with pytest.raises(ValueError):
        tables.create("../z", ZONES)


def test_replacing_one_name_rewrites_one_bucket(spark, tables):
    tables.create("z", ZONES, key=("name",), buckets=32)
    tables.refresh("z", zones(spark, [(f"zone {i}", i) for i in range(200)]))
    before = tables.table("z").folders
    assert len(before) == 32
    tables.replace("z", zones(spark, [("zone 7", -1), ("zone 7", -2)]))
    after = tables.table("z").folders
    assert sum(before[b] != after[b] for b in before) == 1
    want = sorted([(f"zone {i}", i) for i in range(200) if i != 7] + [("zone 7", -1), ("zone 7", -2)])
    assert content(tables, "z") == want
    # untouched buckets are not even read: their files may be gone
    touched = {r[0] for r in zones(spark, [("zone 9", 0)]).select(tables._bucket(tables.table("z"))).collect()}
    for b, folder in after.items():
        if b not in touched:
            for f in glob.glob(folder.removeprefix("file://") + "/*.parquet"):
                os.chmod(f, 0o600)
                open(f, "wb").close()
    tables.replace("z", zones(spark, [("zone 9", 99)]))
    now = tables.table("z")
    assert ("zone 9", 99) in set(map(tuple, tables._read(now, touched).collect()))


def test_replacement_that_fails_midway_changes_nothing(spark, tables):
    tables.create("z", ZONES, key=("name",), buckets=8)
    tables.refresh("z", zones(spark, [(f"zone {i}", i) for i in range(50)]))
    want, version = content(tables, "z"), tables.table("z").version
    with pytest.raises(Exception, match="lost"):
        tables.replace("z", failing(zones(spark, [("zone 1", 0), ("zone 2", 5)]), "size"))
    # the files are written, the commit is not
    real, tables._commit = tables._commit, lambda t: (_ for _ in ()).throw(OSError("driver lost"))
    with pytest.raises(OSError):
        tables.replace("z", zones(spark, [("zone 1", 500)]))
    tables._commit = real
    assert content(tables, "z") == want and tables.table("z").version == version
    tables.replace("z", zones(spark, [("zone 1", 500)]))
    assert ("zone 1", 500) in content(tables, "z") and len(content(tables, "z")) == 50


def test_keys_without_rows_are_deleted(spark, tables):
    tables.create("z", ZONES, key=("name",), buckets=8)
    tables.refresh("z", zones(spark, [("a", 1), ("b", 2), ("c", 3)]))
    tables.replace("z", zones(spark, [("a", 10)]), keys=spark.createDataFrame([("a",), ("b",)], "name string"))
    assert content(tables, "z") == [("a", 10), ("c", 3)]
    with pytest.raises(SchemaError):
        tables.replace("z", zones(spark, [("c", 1)]), keys=spark.createDataFrame([("a",)], "name string"))
    tables.replace("z", zones(spark, []), keys=spark.createDataFrame([("a",), ("c",)], "name string"))
    assert content(tables, "z") == []


def test_a_table_may_be_refreshed_from_itself_and_vacuumed(spark, tables):
    tables.create("z", ZONES)
    tables.refresh("z", zones(spark, [("a", 1)]))
    for _ in range(3):
        tables.refresh("z", tables.read("z").withColumn("size", F.col("size") * 2))
    assert content(tables, "z") == [("a", 8)]
    assert tables.vacuum("z") == 3 and tables.vacuum("z") == 0 and content(tables, "z") == [("a", 8)]
    tables.drop("z")
    with pytest.raises(KeyError):
        tables.table("z")


def test_two_writers(spark, tables):
    tables.create("z", ZONES)
    t = tables.table("z")
    other = NamedTables(spark, tables.root)
    other.refresh("z", zones(spark, [("b", 2)]))
    with pytest.raises(Conflict):
        tables._commit(tables._next(t, tables._written(t, zones(spark, [("a", 1)]))))
    assert content(tables, "z") == [("b", 2)]


def test_ingested_zone_replaces_its_earlier_version(spark, tables):
    from tests.test_verdict_fixes import square

    analytics.create_custom_zones(tables, buckets=4)
    for side in (2, 3):
        lay = spark.createDataFrame([("f", 4326, square(0, 0, side))], f"file string, srid int, rings {C.geo.RINGS_TYPE}")
        zone, _ = spatial.ingest_layer(lay, "study")
        tables.replace("custom_zones", zone.select("name", F.col("rings").alias("geometry"), "area", "perimeter", "n_rings"))
    assert [(r["name"], r["area"]) for r in tables.read("custom_zones").collect()] == [("study", 9.0)]
