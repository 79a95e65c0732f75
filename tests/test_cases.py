"""Collated labels, rules as data, durations, closures."""

import random

import pytest
from pyspark.sql import functions as F

from vigie.operators import cases, workflow
from vigie.operators.quality import Rule, constraint_report


# ---------------------------------------------------------------- labels
SAME = [("Άνοιγμα φακέλου", "ΑΝΟΙΓΜΑ ΦΑΚΕΛΟΥ  "), ("Отчёт готов", "отчет ГОТОВ"), ("Straße", "STRASSE"), ("Création", "CREATION "), ("Ångström", "angstrom"), ("ﬁn", "FIN")]
DIFFERENT = [("Отчёт", "Отчёты"), (" a", "a"), ("a b", "ab"), ("oe", "o e")]


def test_labels_are_equal_beyond_latin_letters(spark):
    df = spark.createDataFrame(SAME + DIFFERENT, "a string, b string")
    got = [r[0] for r in df.select(workflow.label_key(F.col("a")) == workflow.label_key(F.col("b"))).collect()]
    assert got == [True] * len(SAME) + [False] * len(DIFFERENT)


def log(spark, rows):
    return spark.createDataFrame(rows, "id long, dossier_id long, ville string, action_date timestamp, action_type string")


def test_transitions_and_conformance_with_collated_labels(spark):
    import datetime as dt

    steps = spark.createDataFrame([("1", "Άνοιγμα"), ("2", "Отчёт"), ("3", "Clôture")], "step_code string, step_label string")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(1, 1, None, day(0), "ΑΝΟΙΓΜΑ "), (2, 1, None, day(1), "отчет"), (3, 1, None, day(2), "CLOTURE  "), (4, 2, None, day(0), "άνοιγμα"), (5, 2, None, day(9), "ОТЧЁТ "), (6, 2, None, day(10), "nothing")]
    flow = workflow.case_transitions(log(spark, rows), steps)
    assert sorted((r["id"], r["source_step"], r["target_step"]) for r in flow.collect()) == [(1, "1", "2"), (2, "2", "3"), (4, "1", "2"), (5, "2", None)]
    allowed = spark.createDataFrame([("2", "3")], "from_step string, to_step string")
    got = workflow.unknown_transitions(flow, allowed, ["action_type", "next_action_type"], labels=("action_type", "next_action_type"))
    assert got.columns == ["transition_code", "action_type", "next_action_type", "nb_transitions"]
    assert [tuple(r) for r in got.collect()] == [("1_2", "ΑΝΟΙΓΜΑ ", "ОТЧЁТ ", 2)]  # one group, by its least spellings
    assert workflow.unknown_transitions(flow, allowed, ["action_type", "next_action_type"]).count() == 2


# ---------------------------------------------------------------- rules
def test_rules_by_brute_force(spark):
    rng = random.Random(3)
    pick = lambda n: rng.choice([None, *range(n)])
    a = [(pick(30), pick(5), pick(40)) for _ in range(60)] + [(7, 1, 2)] * 40  # one row is many
    b = [(i,) for i in range(0, 40, 2)] + [(None,), (4,)]
    tables = {"a": spark.createDataFrame(a, "x int, y int, z int"), "b": spark.createDataFrame(b, "z long")}
    rules = [Rule("pk", "a", ("x", "y")), Rule("pk", "b", ("z",)), Rule("duplicates", "a", ("x",)), Rule("not_null", "a", ("z",)), Rule("fk", "a", ("z",), "b", ("z",)), Rule("unmapped", "b", ("z",), "a", ("z",)), Rule("not_null", "b", ("z",))]
    report = constraint_report(tables, rules)
    got = {(r["table_name"], r["rule"]): r["violations"] for r in report.collect()}
    count = lambda v: {k: v.count(k) for k in set(v)}
    xy, x, z = [(r[0], r[1]) for r in a], [r[0] for r in a], [r[2] for r in a]
    bz = [r[0] for r in b]
    assert got == {
        ("a", "pk(x, y)"): sum(n > 1 for n in count(xy).values()) + sum(None in k for k in xy), ("b", "pk(z)"): 1 + 1,
        ("a", "duplicates(x)"): sum(n > 1 for k, n in count(x).items() if k is not None), ("a", "not_null(z)"): z.count(None),
        ("a", "fk(z -> b.z)"): sum(k is not None and k not in bz for k in z), ("b", "unmapped(z -> a.z)"): sum(k is not None and k not in z for k in bz), ("b", "not_null(z)"): 1,
    }


def test_each_table_is_scanned_once(spark, tmp_path):
    names = ("a", "b", "c")
    for n in names:
        spark.range(10).selectExpr("id as x", "id % 3 as y").write.parquet(f"{tmp_path}/{n}")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in names}
    rules = [Rule("pk", n, ("x",)) for n in names] + [Rule("not_null", n, ("y",)) for n in names] + [Rule("fk", "a", ("y",), "b", ("x",)), Rule("fk", "c", ("x",), "a", ("x",)), Rule("fk", "b", ("y",), "a", ("y",))]
    df = constraint_report(tables, rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    assert {r["violations"] for r in df.collect()} == {0}


def test_rules_are_checked(spark):
    with pytest.raises(ValueError):
        Rule("fk", "a", ("x",))
    with pytest.raises(ValueError):
        Rule("check", "a", ("x",))
    with pytest.raises(KeyError):
        constraint_report({}, [Rule("pk", "a", ("x",))])
    empty = spark.createDataFrame([], "x int")
    assert [r["violations"] for r in constraint_report({"a": empty}, [Rule("pk", "a", ("x",)), Rule("not_null", "a", ("x",))]).collect()] == [0, 0]


# ---------------------------------------------------------------- durations and ends
def test_quantiles_of_merged_counts(spark):
    rng = random.Random(5)
    days = [rng.choice([0, 0, 0, 1, 2, 3, 50, rng.randint(0, 400), -2]) for _ in range(999)]
    rows = [(d, "1" if i % 3 else "2") for i, d in enumerate(days)]
    flow = spark.createDataFrame(rows, "d int, source_step string").selectExpr("source_step", "'9' as target_step", "timestamp'2024-01-01 10:00:00' as action_date", "timestamp'2024-01-01 10:00:00' + make_dt_interval(d, 5) as next_action_date")
    parts = [cases.duration_counts(flow.where(F.col("source_step") == k)) for k in ("1", "2")] + [cases.duration_counts(flow)]
    got = {r["source_step"]: r for r in cases.durations(cases.merged_counts(*parts), (0.25, 0.5, 0.99)).collect()}
    for k in ("1", "2"):
        own = sorted(2 * [d for d, s in rows if s == k])  # every row came twice
        r = got[k]
        rank = lambda q: own[-(-int(q * 100) * len(own) // 100) - 1]
        assert (r["nb_transitions"], r["min_days"], r["max_days"]) == (len(own), own[0], own[-1])
        assert r["mean_days"] == pytest.approx(sum(own) / len(own))
        assert (r["p25_days"], r["p50_days"], r["p99_days"]) == (rank(0.25), rank(0.5), rank(0.99))


def test_closure_and_dead_ends(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("b", "x"), ("a", "b"), (None, "a"), ("d", None)]
    steps = spark.createDataFrame([(s,) for s in "abcdxyz"], "step_code string")
    df = spark.createDataFrame(edges, "from_step string, to_step string")
    reach = {(r[0], r[1]) for r in cases.reachable(df).collect()}
    assert reach == {(a, b) for a, bs in {"a": "bcdxy", "b": "cdxy", "c": "d", "x": "xy", "y": "xy"}.items() for b in bs}
    ends = {r["step_code"]: (r["is_end"], r["can_end"]) for r in cases.step_ends(steps, df.where("to_step is not null")).collect()}
    assert ends == {"a": (False, True), "b": (False, True), "c": (False, True), "d": (True, True), "x": (False, False), "y": (False, False), "z": (True, True)}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(12)], "from_step string, to_step string")
    assert cases.reachable(chain).count() == 12 * 13 // 2
    assert cases.reachable(df.limit(0)).count() == 0
