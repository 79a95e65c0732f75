"""Line dedup that can be undone: sharded cuckoo filters in front of exact reference counts.

State of a ``LineStore`` (Parquet tables in the shared folder):

* ``postings(shard, key, doc_id)``: which document holds which line, one row per pair. ``key`` is the 128-bit digest of
  the line, stripped of ASCII white space and with A-Z lower-cased; lines under ``min_chars`` code points have none.
* ``refs(shard, key, refs, owner)``: the exact reference count, and the smallest document that holds the line.
* ``filters(shard, n, cells)``: one cuckoo filter per shard over the keys with at least two references. It answers
  "surely not repeated" without a look at the exact table, so only the few lines that pass it are joined with ``refs``.

``insert`` adds a batch of documents, ``delete`` takes documents out; both change counts, owners and filters of the keys
they touch (a cuckoo filter can forget a key), so inserting and then deleting a batch gives the same answers as before.

Shards are cut by the digest, so they are even; a very frequent line is summed before the shuffle, and the routing of
lines to filters splits each shard further by document.

Null or empty text is one empty line. Repeated rows with one id count as one document and each gets its result. A
null id counts as one document after all others. Extra columns are ignored (``apply`` passes them through).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import NULL_ID, stored

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Keys a shard holds on average; the number of shards follows from the number of postings.
KEYS_PER_SHARD = 200_000
ROWS_PER_ROUTE = 100_000
SLOTS = 4  # fingerprints in a bucket


# ---- keys -----------------------------------------------------------------------------------------------------------


def line_keys(data: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The key of each line of ``data``; None for a line too short to have one."""
    out: list[bytes | None] = []
    for line in data.split(b"\n"):
        line = line.strip(WHITE)
        long = len(line) >= 4 * min_chars or len(line) >= min_chars and len(line.decode("utf-8", "replace")) >= min_chars
        out.append(hashlib.blake2b(line.lower(), digest_size=16).digest() if long else None)
    return out


def postings(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(key, doc_id)``, one row per line key and row of ``df``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                own = set(line_keys(t.as_py() or b"", min_chars))
                own.discard(None)
                found.extend(own)
                ids.extend([i] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    rows = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(keys, "key binary, doc_id long")


# ---- cuckoo filter --------------------------------------------------------------------------------------------------


class Cuckoo:
    """Partial-key cuckoo filter: 16-bit fingerprints, four slots a bucket; keys are 16-byte digests."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.mask = len(cells) - 1

    @classmethod
    def sized(cls, n: int) -> Cuckoo:
        return cls(np.zeros((1 << max(1, int(np.ceil(np.log2(max(n, 1) / (SLOTS * 0.85) + 1)))), SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
        prints = (words[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (words[:, 0] & np.uint64(self.mask)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return bucket ^ ((np.asarray(prints, np.int64) * 0x5BD1E995) & self.mask)

    def insert(self, keys: list[bytes]) -> bool:
        """Add keys that are not held yet. False: the filter is full and has to be rebuilt larger."""
        if not keys:
            return True
        state = 12345
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                free = np.flatnonzero(self.cells[bucket] == 0)
                if len(free):
                    self.cells[bucket, free[0]] = p
                    break
            else:
                bucket = b
                for _ in range(500):
                    state = (1103515245 * state + 12345) % 2**31
                    slot = (state >> 16) % SLOTS
                    p, self.cells[bucket, slot] = int(self.cells[bucket, slot]), p
                    bucket = int(self._other(bucket, p))
                    free = np.flatnonzero(self.cells[bucket] == 0)
                    if len(free):
                        self.cells[bucket, free[0]] = p
                        break
                else:
                    return False
        return True

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        p, a, b = self._places(keys)
        return (self.cells[a] == p[:, None]).any(1) | (self.cells[b] == p[:, None]).any(1)

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that are held; one matching fingerprint goes for each."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))) if keys else ():
            for bucket in (a, b):
                hit = np.flatnonzero(self.cells[bucket] == p)
                if len(hit):
                    self.cells[bucket, hit[0]] = 0
                    break

    @classmethod
    def of(cls, keys: list[bytes]) -> Cuckoo:
        n = max(1, len(keys))
        while True:
            new = cls.sized(n)
            if new.insert(keys):
                return new
            n *= 2


# ---- the store ------------------------------------------------------------------------------------------------------


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _counts(post: DataFrame) -> DataFrame:
    """Exact counts: partial sums by key before the shuffle, so a frequent line sends one row a task."""
    return post.groupBy("key").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner"))


class LineStore:
    def __init__(self, spark: SparkSession, shards: int, post: DataFrame, refs: DataFrame, filters: DataFrame):
        self.spark, self.shards, self.post, self.refs, self.filters = spark, shards, post, refs, filters

    @classmethod
    def build(cls, post: DataFrame, shards: int | None = None) -> LineStore:
        """A store of ``post(key, doc_id)``; a pair that occurs twice counts once."""
        post = stored(post.distinct(), "postings")
        spark = post.sparkSession
        shards = shards or max(2, -(-post.count() // KEYS_PER_SHARD))
        refs = stored(_counts(post).where("refs > 1").select(_shard(shards), "*"), "refs")
        return cls(spark, shards, post, refs, stored(_filters(refs), "filters"))

    def insert(self, new: DataFrame) -> LineStore:
        """The store with the postings ``new`` as well."""
        new = stored(new.distinct().join(self.post, ["key", "doc_id"], "left_anti"), "postings")
        return self._changed(stored(self.post.unionByName(new), "postings"), new)

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """The store without the documents in ``doc_ids(doc_id)`` (a null id: the document without an id)."""
        ids = doc_ids.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id")).distinct()
        gone = stored(self.post.join(ids, "doc_id", "left_semi").select("key", "doc_id"), "postings")
        return self._changed(stored(self.post.join(ids, "doc_id", "left_anti").select("key", "doc_id"), "postings"), gone)

    def _changed(self, post: DataFrame, delta: DataFrame) -> LineStore:
        """Counts again those keys only that ``delta`` touches, and moves them in or out of their shard's filter."""
        touched = stored(delta.select("key").distinct(), "touched")
        again = _counts(post.join(touched, "key", "left_semi")).where("refs > 1").select(_shard(self.shards), "*")
        kept = self.refs.join(touched, "key", "left_anti").select("shard", "key", "refs", "owner")
        refs = stored(kept.unionByName(again), "refs")
        into = refs.join(touched, "key", "left_semi").join(self.refs, "key", "left_anti").selectExpr("shard", "key", "true as grow")
        out = self.refs.join(touched, "key", "left_semi").join(refs, "key", "left_anti").selectExpr("shard", "key", "false as grow")
        moves = stored(into.unionByName(out), "moves")

        def apply(old: pd.DataFrame, move: pd.DataFrame) -> pd.DataFrame:
            shard = int(old["shard"].iloc[0] if len(old) else move["shard"].iloc[0])
            f = Cuckoo.load(old["cells"].iloc[0]) if len(old) else Cuckoo.sized(KEYS_PER_SHARD)
            grow = move["grow"].astype(bool)
            f.delete(list(move["key"][~grow]))
            full = not f.insert(list(move["key"][grow]))
            return pd.DataFrame({"shard": [shard], "cells": [None if full else f.dump()]})

        moved = stored(self.filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(apply, "shard int, cells binary"), "filters")
        over = moved.where("cells is null").select("shard")
        filters = moved.where("cells is not null").unionByName(_filters(refs.join(over, "shard", "left_semi").select(*refs.columns)))
        return LineStore(self.spark, self.shards, post, refs, stored(filters, "filters"))

    def repeated(self, post: DataFrame) -> DataFrame:
        """``(doc_id, key)`` of the lines of ``post`` that another, smaller document owns.

        Each line goes to the filter of its shard; only those that pass are joined with the exact counts.
        """
        routes = max(1, -(-post.count() // (self.shards * ROWS_PER_ROUTE)))
        lines = post.select(_shard(self.shards), F.pmod(F.xxhash64("doc_id"), F.lit(routes)).cast("int").alias("route"), "key", "doc_id")
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(routes - 1))).alias("route"), "cells")

        def screen(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(own):
                return rows[["key", "doc_id"]][:0]
            return rows[["key", "doc_id"]][Cuckoo.load(own["cells"].iloc[0]).contains(list(rows["key"]))]

        maybe = lines.groupBy("shard", "route").cogroup(filters.groupBy("shard", "route")).applyInPandas(screen, "key binary, doc_id long")
        maybe = stored(maybe, "maybe")
        return maybe.join(self.refs.select("key", "owner"), "key").where("doc_id > owner").select("doc_id", "key")


def _filters(refs: DataFrame) -> DataFrame:
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "cells": [Cuckoo.of(list(rows["key"])).dump()]})

    return refs.select("shard", "key").groupBy("shard").applyInPandas(build, "shard int, cells binary")


def drop_lists(repeated: DataFrame) -> DataFrame:
    """``(doc_id, keys)``: a document's dropped line keys as one binary (bounded by the document's own lines)."""
    return repeated.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def apply_drops(df: DataFrame, drops: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``df`` with ``text`` rid of the lines in ``drops``, plus ``_n_lines`` and ``_n_dropped``. A null text stays null."""
    df = df.drop("_n_lines", "_n_dropped", "_gone_id", "_gone_keys")
    schema = df.select(*df.columns, F.lit(0).cast("long").alias("_n_lines"), F.lit(0).cast("long").alias("_n_dropped")).schema
    names = df.columns
    at, n_cols = names.index(text), len(names)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts, dropped = [], [], []
            for t, gone in zip(b.column(at), b.column(n_cols)):
                t, gone = t.as_py(), gone.as_py()
                data = (t or "").encode()
                n = data.count(b"\n") + 1
                if gone:
                    gone = set(gone)
                    kept = [line for line, k in zip(data.split(b"\n"), line_keys(data, min_chars)) if k not in gone]
                    dropped.append(n - len(kept))
                    t = b"\n".join(kept).decode()
                else:
                    dropped.append(0)
                texts.append(t)
                counts.append(n)
            cols = [b.column(i) if i != at else pa.array(texts, b.column(i).type) for i in range(n_cols)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, "_n_lines", "_n_dropped"])

    gone = drops.select(F.col("doc_id").alias("_gone_id"), F.col("keys").alias("_gone_keys"))
    joined = df.join(gone, F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)) == F.col("_gone_id"), "left").select(*df.columns, "_gone_keys")
    return joined.mapInArrow(rebuild, schema)


def line_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One-shot form: every document of ``df`` is inserted into an empty store, then rid of lines it does not own."""
    store = LineStore.build(postings(df, doc_id, text, min_chars))
    return apply_drops(df, drop_lists(store.repeated(store.post)), doc_id, text, min_chars)
