"""Cohort reports from the stored state equal those from all detections; a survey is merged without the earlier ones."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from vigie.operators import cohort, presence
from vigie.registry import _parcel_stats, _pv_rows
from vigie.sources.fixtures import Fixtures
from vigie.sources.named import NamedTables

SCHEMA = "geozone_id bigint, batch_year int, id_parcellaire string"
YEARS = (2015, 2018, 2021, 2024)


@pytest.fixture(scope="module")
def det(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(6), rng.choice(YEARS), rng.choice([None, *(f"P{i}" for i in range(40))])) for _ in range(900)]
    rows += [(0, 2024, "HOT")] * 450  # a third of all rows
    rows += [(7, 2018, None), (7, 2021, "P1"), (8, 2015, None), (9, None, "P2"), (None, 2021, "P3")]  # only NULL parcels; no survey; no zone
    return spark.createDataFrame(rows, SCHEMA).cache()


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_reports_from_the_state(spark, det):
    state = presence.presence_state(det)
    same(cohort.stock_by_year(state), cohort.stock_by_year(det.where("batch_year is not null")))
    same(cohort.stock_by_year(state, YEARS, drop_null=True), cohort.stock_by_year(det, YEARS, drop_null=True))
    same(cohort.new_parcels(state, 2024, (2021, 2018)), cohort.new_parcels(det, 2024, (2021, 2018)))
    same(cohort.cleared_parcels(state, 2021, 2024), cohort.cleared_parcels(det, 2021, 2024))
    fx = Fixtures(spark, SMALL)
    stats = _parcel_stats(fx, "commune").cache()
    c8 = [cohort.evolution_epci(x, fx.fx_zone, stats) for x in (state, det)]
    same(*c8)
    same(*map(cohort.corrected_estimates, c8))
    c6 = [cohort.evolution_commune(_pv_rows(fx), x, fx.fx_mapping, stats) for x in (state, det)]
    same(*c6)  # C7 is its column ``groupe``
    assert c6[0].count() > 0 and c8[0].count() > 0


def test_a_survey_is_merged_from_the_state_and_its_rows_alone(spark, det, tmp_path):
    store = presence.PresenceStore(NamedTables(spark, f"file://{tmp_path}"))
    store.create()
    of = lambda *years: det.where(F.col("batch_year").isin(list(years)))
    store.add(of(2015, 2018, 2021))
    same(store.read().orderBy("geozone_id", "id_parcellaire"), presence.presence_state(of(2015, 2018, 2021)).orderBy("geozone_id", "id_parcellaire"))
    # the new survey is a table of its own: nothing but it and the state is scanned
    of(2024).write.parquet(f"{tmp_path}/new")
    new = spark.read.parquet(f"{tmp_path}/new")
    plan = presence.merged(store.read(), presence.presence_state(new))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "InMemoryTableScan" not in plan
    store.add(new)
    store.add(new)  # replayed
    same(store.read(), presence.presence_state(det.where("batch_year is not null")).select(*store.read().columns))


def test_replacing_a_survey(spark, det, tmp_path):
    store = presence.PresenceStore(NamedTables(spark, f"file://{tmp_path}"))
    store.create()
    store.add(det)
    other = spark.createDataFrame([(0, 2021, "NEW"), (3, 2021, None), (3, 2018, "ignored")], SCHEMA)
    store.replace_survey(2021, other)
    want = det.where("batch_year <> 2021").unionByName(other.where("batch_year = 2021"))
    same(store.read(), presence.presence_state(want).select(*store.read().columns))
    same(cohort.stock_by_year(store.read()), cohort.stock_by_year(want))


def test_bounds(spark, det):
    with pytest.raises(Exception, match="survey years lie"):
        presence.presence_state(spark.createDataFrame([(1, 1999, "P")], SCHEMA)).collect()
    with pytest.raises(ValueError):
        presence.without_survey(presence.presence_state(det), 2063)
    edge = presence.presence_state(spark.createDataFrame([(1, 2000, "P"), (1, 2062, "P")], SCHEMA))
    assert {r["batch_year"] for r in cohort.stock_by_year(edge).collect()} == {2000, 2062}
    assert presence.merged(presence.presence_state(det.limit(0))).count() == 0
