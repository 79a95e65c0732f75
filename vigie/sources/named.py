"""Named tables with a declared schema: checked before a write, switched by one commit, replaced key by key.

A table is a folder: data files in folders of their own for every commit, and ``commits``, a Parquet table to which each commit adds
one file. A commit lists, for each bucket of the key's hash, the folder that holds it now; the newest commit is the table. So

* a refresh that fails leaves nothing but an unused folder, and readers never see a half-written table;
* replacing rows by key rewrites the buckets that hold these keys and points to the old folders for all others;
* of two writers that started from the same version the later to commit is told so (``Conflict``) and has changed nothing.

All files are read and written by Spark, on whatever store the root lies; only dropping and vacuuming ask Hadoop's file system to
delete folders. A view that is kept as a table is refreshed by ``refresh(name, query result)``.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigie.plans.materialize import materialize

BUCKET = "vg_bucket"
COMMITS = "version long, commit string, at timestamp, columns string, key array<string>, is_unique boolean, buckets int, bucket int, folder string"


class SchemaError(ValueError):
    """Rows do not have the declared columns, types, non-null values or unique keys."""


class Conflict(RuntimeError):
    """Another writer committed the same version first."""


@dataclass(frozen=True)
class Table:
    """What the newest commit says. ``folders``: bucket → folder; a bucket without rows has none."""

    name: str
    version: int
    columns: StructType
    key: tuple[str, ...]
    is_unique: bool
    buckets: int
    folders: dict[int, str]


class NamedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- what there is
    def _path(self, name: str, *more: str) -> str:
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"no table name: {name!r}")
        return "/".join((self.root, name, *more))

    def _commits(self, name: str) -> list:
        try:
            rows = self.spark.read.schema(COMMITS).parquet(self._path(name, "commits")).collect()  # a row for each bucket of each version kept
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        # of two commits of one version the first counts, then the lesser name
        first = {}
        for r in sorted(rows, key=lambda r: (r["version"], r["at"], r["commit"])):
            first.setdefault(r["version"], r["commit"])
        return [r for r in rows if first[r["version"]] == r["commit"]]

    def table(self, name: str) -> Table:
        rows = self._commits(name)
        if not rows:
            raise KeyError(name)
        last = max(r["version"] for r in rows)
        rows = [r for r in rows if r["version"] == last]
        head = rows[0]
        columns = StructType.fromJson(json.loads(head["columns"]))
        return Table(name, last, columns, tuple(head["key"]), head["is_unique"], head["buckets"], {r["bucket"]: r["folder"] for r in rows if r["folder"]})

    def read(self, name: str) -> DataFrame:
        return self._read(self.table(name))

    def read_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows that have one of ``keys`` (the key columns); only buckets that can hold one are read."""
        t = self.table(name)
        keys = materialize(keys.select(*t.key).distinct())
        touched = {r[0] for r in keys.select(self._bucket(t)).distinct().collect()}  # at most one number for each bucket
        return self._read(t, touched).join(keys, list(t.key), "left_semi").select(*t.columns.names)

    def _read(self, t: Table, buckets=None) -> DataFrame:
        folders = [f for b, f in sorted(t.folders.items()) if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], t.columns)
        return self.spark.read.schema(t.columns).parquet(*folders)

    # ---- declaring and dropping
    def create(self, name: str, columns: str | StructType, key: tuple[str, ...] = (), unique: bool = False, buckets: int = 1, if_not_exists: bool = False) -> Table:
        """Declare a table without rows. ``key``: columns (never null) by whose hash rows are dealt to ``buckets``; ``unique``: one row a key."""
        columns = StructType.fromDDL(columns) if isinstance(columns, str) else columns
        missing = set(key) - set(columns.names)
        if missing or (buckets > 1 and not key):
            raise SchemaError(f"{name}: key {sorted(key)} with {buckets} buckets, columns {columns.names}")
        new = Table(name, 0, columns, tuple(key), unique, buckets, {})
        if self._commits(name):
            now = self.table(name)
            if not if_not_exists:
                raise ValueError(f"{name} exists")
            if (now.columns, now.key, now.is_unique, now.buckets) != (new.columns, new.key, new.is_unique, new.buckets):
                raise SchemaError(f"{name} exists with another declaration")
            return now
        return self._commit(new)

    def drop(self, name: str) -> None:
        self._delete(self._path(name))

    def vacuum(self, name: str, keep: int = 1) -> int:
        """Delete the data folders that the newest ``keep`` versions do not use (left by older versions and failed writes)."""
        rows = self._commits(name)
        kept = sorted({r["version"] for r in rows})[-keep:]
        used = {r["folder"].split("/data/")[1].split("/")[0] for r in rows if r["folder"] and r["version"] in kept}
        old = [p for p in self._list(self._path(name, "data")) if p not in used]
        for p in old:
            self._delete(self._path(name, "data", p))
        return len(old)

    # ---- writing
    def refresh(self, name: str, rows: DataFrame) -> Table:
        """Make ``rows`` the whole table."""
        t = self.table(name)
        rows = self._checked(t, rows)
        return self._commit(self._next(t, self._written(t, rows)))

    def replace(self, name: str, rows: DataFrame, keys: DataFrame | None = None) -> Table:
        """Delete the rows that have one of ``keys`` (by default the keys of ``rows``) and insert ``rows``.

        Only buckets with such a key are read and rewritten. Rows whose key is not among ``keys`` are an error.
        """
        t = self.table(name)
        if not t.key:
            raise SchemaError(f"{name} has no key")
        rows = self._checked(t, materialize(rows))
        gone = (rows if keys is None else keys).select(*t.key).distinct()
        if keys is not None and rows.join(gone, list(t.key), "left_anti").limit(1).count():
            raise SchemaError(f"{name}: rows outside the keys to replace")
        gone = materialize(gone)
        touched = {r[0] for r in gone.select(self._bucket(t)).distinct().collect()}  # at most one number for each bucket
        kept = self._read(t, touched).join(gone, list(t.key), "left_anti").select(*t.columns.names)
        written = self._written(t, kept.unionByName(rows))
        return self._commit(self._next(t, {b: f for b, f in t.folders.items() if b not in touched} | written))

    # ---- steps of a write
    def _bucket(self, t: Table) -> Column:
        return F.pmod(F.xxhash64(*t.key), F.lit(t.buckets)).cast("int").alias(BUCKET) if t.key else F.lit(0).alias(BUCKET)

    def _checked(self, t: Table, rows: DataFrame) -> DataFrame:
        """``rows`` in the declared order of columns; an error names everything that does not fit."""
        have, want = {f.name: f.dataType for f in rows.schema}, {f.name: f.dataType for f in t.columns}
        wrong = [f"{c} is missing" for c in want if c not in have] + [f"{c} is not declared" for c in have if c not in want]
        plain = lambda d: d.simpleString()
        wrong += [f"{c} is {plain(have[c])}, declared {plain(want[c])}" for c in want if c in have and plain(have[c]) != plain(want[c])]
        if wrong:
            raise SchemaError(f"{t.name}: " + "; ".join(wrong))
        rows = rows.select(*t.columns.names)
        filled = sorted({f.name for f in t.columns if not f.nullable} | set(t.key))
        if filled:
            nulls = rows.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in filled]).first()
            if found := [c for c in filled if nulls[c]]:
                raise SchemaError(f"{t.name}: null in {', '.join(found)}")
        if t.is_unique and (twice := rows.groupBy(*t.key).count().where("count > 1").first()):
            raise SchemaError(f"{t.name}: key {tuple(twice)[:-1]} occurs {twice['count']} times")
        return rows

    def _written(self, t: Table, rows: DataFrame) -> dict[int, str]:
        """Write ``rows`` under a new folder; bucket → folder of the buckets that have rows."""
        base = self._path(t.name, "data", uuid.uuid4().hex)
        dealt = rows.withColumn(BUCKET, self._bucket(t)).hint("rebalance", BUCKET)  # Spark may split a large bucket
        dealt.write.partitionBy(BUCKET).parquet(base)
        found = [p.partition("=")[2] for p in self._list(base) if p.startswith(f"{BUCKET}=")]
        return {int(b): f"{base}/{BUCKET}={b}" for b in found}

    def _next(self, t: Table, folders: dict[int, str]) -> Table:
        return Table(t.name, t.version + 1, t.columns, t.key, t.is_unique, t.buckets, folders)

    def _commit(self, t: Table) -> Table:
        """Add the commit's one file: before that nothing is visible, after it everything is."""
        commit, columns = uuid.uuid4().hex, t.columns.json()
        rows = [(t.version, commit, columns, list(t.key), t.is_unique, t.buckets, b, f) for b, f in sorted(t.folders.items())]
        rows = rows or [(t.version, commit, columns, list(t.key), t.is_unique, t.buckets, -1, None)]
        df = self.spark.createDataFrame(rows, "version long, commit string, columns string, key array<string>, is_unique boolean, buckets int, bucket int, folder string")
        df = df.withColumn("at", F.current_timestamp()).select(*[c.split()[0] for c in COMMITS.split(", ")])
        df.coalesce(1).write.mode("append").parquet(self._path(t.name, "commits"))
        if not any(r["commit"] == commit for r in self._commits(t.name)):
            raise Conflict(f"{t.name}: version {t.version} was committed by another writer")
        return t

    # ---- folders
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _list(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)
