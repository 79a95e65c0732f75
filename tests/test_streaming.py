"""The append form of first detection (one run against everything committed before) equals the one-pass S3."""

from pyspark.sql import functions as F

from tests.conftest import SMALL
from vigie.operators import spatial
from vigie.sources import layers
from vigie.sources.fixtures import Fixtures
from vigie.streaming import first_detection_increment


def test_increment_matches_one_pass(spark):
    fx = Fixtures(spark, SMALL)
    det = layers.detection_layer(fx.fx_detection, keep=("batch_year",))
    one_pass = spatial.first_detection(det, layers.FIXTURE_PAIR_CELL, seq_col="batch_year").where(F.col("batch_year") == 2024)
    new = det.where(F.col("batch_year") == 2024)
    existing = det.where(F.col("batch_year") < 2024)
    inc = first_detection_increment(new, existing, layers.FIXTURE_PAIR_CELL)
    a = {(r.id, r.first_detection) for r in one_pass.select("id", "first_detection").collect()}
    b = {(r.id, r.first_detection) for r in inc.select("id", "first_detection").collect()}
    assert a == b and len(a) > 0
