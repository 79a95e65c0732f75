"""Q1: declared constraints as rules, checked in one pass.

Rules are data. For each table they are compiled to one list of checks per row: which rule, which key, and whether the table
stands as the checked or the referenced side. All tables' checks meet in one ``groupBy(rule, key)``, combined before its shuffle, so
every table is scanned once however many rules name it, and a key that a third of all rows hold costs one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("pk", "fk", "not_null", "duplicates", "unmapped")


@dataclass(frozen=True)
class Rule:
    """``pk``: key values held by more than one row, plus rows with a NULL in the key. ``duplicates``: values held by more than one row, NULLs
    apart. ``not_null``: rows with a NULL. ``fk`` and ``unmapped``: rows whose value (NULL apart) no row of ``parent`` holds."""

    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"no kind of rule: {self.kind}")
        if (self.kind in ("fk", "unmapped")) != (self.parent is not None) or len(self.parent_columns) != (len(self.columns) if self.parent else 0):
            raise ValueError(f"{self.kind} on {self.table}: parent {self.parent}{self.parent_columns}")

    @property
    def name(self) -> str:
        target = f" -> {self.parent}.{', '.join(self.parent_columns)}" if self.parent else ""
        return f"{self.kind}({', '.join(self.columns)}{target})"


def _key(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def _checks(table: str, rules: list[Rule]) -> list[Column]:
    """What a row of ``table`` says to each rule: (rule, key, is the row checked, is it referenced)."""
    entry = lambda i, key, child: F.struct(F.lit(i).alias("rule"), key.alias("key"), F.lit(int(child)).cast("long").alias("child"), F.lit(int(not child)).cast("long").alias("parent"))
    out = []
    for i, r in enumerate(rules):
        if r.table == table:
            null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in r.columns])
            # the keys of rows that cannot break the rule need not travel
            wanted = null if r.kind == "not_null" else F.lit(True) if r.kind == "pk" else ~null
            out.append(F.when(wanted, entry(i, _key(r.columns), True)))
        if r.parent == table:
            out.append(entry(i, _key(r.parent_columns), False))
    return out


def constraint_report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table_name, rule, violations) for every rule, those that hold included."""
    named = {t for r in rules for t in (r.table, r.parent) if t}
    if missing := named - set(tables):
        raise KeyError(f"no such table: {sorted(missing)}")
    c = F.col
    parts = []
    for name in sorted(named):
        said = F.filter(F.array(*_checks(name, rules)), lambda x: x.isNotNull())
        parts.append(tables[name].select(F.inline(said)))
    keys = reduce(DataFrame.unionByName, parts).groupBy("rule", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    of = lambda *kinds: c("rule").isin([i for i, r in enumerate(rules) if r.kind in kinds])
    null = F.exists("key", lambda x: x.isNull())
    broken = (
        F.when(of("pk"), F.when(c("child") > 1, 1).otherwise(0) + F.when(null, c("child")).otherwise(0))
        .when(of("duplicates"), F.when(c("child") > 1, 1).otherwise(0))
        .when(of("not_null"), c("child"))
        .otherwise(F.when(c("parent") == 0, c("child")).otherwise(0))
    )
    counted = keys.groupBy("rule").agg(F.sum(broken).cast("long").alias("violations"))
    listed = keys.sparkSession.createDataFrame([(i, r.table, r.name) for i, r in enumerate(rules)], "no int, table_name string, name string")
    return listed.join(counted, c("no") == c("rule"), "left").select("table_name", c("name").alias("rule"), F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
