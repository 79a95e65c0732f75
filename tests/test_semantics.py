"""Semantics that must not drift from the studied SQL/pandas (null ordering, rounding, NOT IN, concat, collation)."""

from decimal import Decimal

from pyspark.sql import functions as F

from vigie.functions.text import canonical_commune, normalize_text, repair_short_date
from vigie.operators import cohort, workflow


def test_corrected_count_is_exact_decimal_floor(spark):
    df = spark.createDataFrame([(100,), (1,), (0,), (19,)], "n long")
    got = [r[0] for r in df.select(cohort.corrected_count(F.col("n"))).collect()]
    exp = [int((Decimal(n) * Decimal("0.705") * (1 - Decimal("0.252"))).to_integral_value(rounding="ROUND_FLOOR")) for n in (100, 1, 0, 19)]
    assert got == exp


def test_not_in_is_null_aware(spark):
    groups = spark.createDataFrame(
        [("g1", "COLLECTIVITY", 1, None), ("g2", "COLLECTIVITY", 2, 5)], "name string, user_group_type string, geozone_id long, dep_geozone_id long"
    )
    planned = spark.createDataFrame([(7, 0)], "dep_geozone_id long, nb_collectivity long")
    out = cohort.deployment_by_department(groups, planned)
    assert 7 not in [r.dep_geozone_id for r in out.collect()]
    groups2 = groups.where(F.col("name") == "g2")
    assert 7 in [r.dep_geozone_id for r in cohort.deployment_by_department(groups2, planned).collect()]


def test_concat_propagates_null(spark):
    df = spark.createDataFrame([("A", None, "C")], "a string, b string, c string")
    assert df.select(workflow._status(F.col("a"), F.col("b"), F.col("c"))).first()[0] is None


def test_label_key_folds_case_accents_trailing_spaces(spark):
    df = spark.createDataFrame([("Création décisions de justice ", "CREATION DECISIONS DE JUSTICE")], "a string, b string")
    r = df.select((workflow.label_key(F.col("a")) == workflow.label_key(F.col("b"))).alias("eq")).first()
    assert r.eq


def test_text_helpers(spark):
    df = spark.createDataFrame([("Œuvre  d'Été-x", "5/3/21", "MONS LA TRIVALLE")], "a string, d string, c string")
    r = df.select(normalize_text(F.col("a")).alias("n"), repair_short_date(F.col("d")).alias("d"), canonical_commune(F.col("c")).alias("c")).first()
    assert r.n == "oeuvre d ete x"
    assert r.d == "2021-3-5 00:00:00"
    assert r.c == "MONS"


def test_keep_first_nulls_first_descending(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(1, 5), (1, None), (1, 9)], "k long, p long")
    w = Window.partitionBy("k").orderBy(F.col("p").desc_nulls_first())
    first = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").first()
    assert first.p is None
