"""Best-fit packing of documents into fixed-length sequences, by hierarchical residual packing.

A document is its token ids and an end id; only one longer than ``capacity`` is cut, into full pieces and a last shorter
one. Full pieces are sequences of their own. All others are packed in rounds. First every group of about
``group_items`` pieces is packed by best fit, longest piece first. Bins filled to ``nearly_full``, and bins into which
not even the group's shortest piece would fit, are done. The others are merged: ``fan_in`` groups hand their underfull
bins up to one, as items. There each bin goes into another bin whole where it fits, and is opened where it does not, so
its pieces can fill the gaps of other bins. A group hands up at most ``carry`` bins, the emptiest; the rest are done as
they are, so no task holds more than ``fan_in * carry`` bins, whatever the lengths are. The last round has one group.

Null or empty text is one piece with the end id alone. Repeated rows are packed like any others; their pieces carry the
same ids. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.llm.common import stored
from vigie.llm.wordbpe import WordEncoder

CAPACITY = 4096
GROUP_ITEMS = 20_000
NEARLY_FULL = 0.995
FAN_IN = 8
CARRY = 2_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``PIECES`` of every document, and with ``with_ids`` the ids themselves as ``ids`` (array of int)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                codes, ends, whole, _ = encoder.batch(part.column(1).to_pylist())
                out: list[list] = [[] for _ in names]
                begin = 0
                for i, (doc, end) in enumerate(zip(part.column(0).to_pylist(), ends.tolist())):
                    ids = np.append(np.asarray(whole[i], np.int32) if i in whole else encoder.expand(codes[begin:end]), np.int32(end_id)).astype("<u4")
                    begin = end
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        for col, v in zip(out, (doc, k, at, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32))):
                            col.append(v)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that has room (ties: the newest such bin)."""
    out = np.zeros(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = {}  # room -> bins
    rooms = 0  # bit r is set if a bin has room r
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            bins = open_bins[room]
            b = bins.pop()
            if not bins:
                rooms &= ~(1 << room)
        else:
            b, room, n = n, capacity, n + 1
        out[i] = b
        left = room - size
        if left:
            open_bins.setdefault(left, []).append(b)
            rooms |= 1 << left
    return out


def pack_group(rows: pd.DataFrame, capacity: int, nearly_full: float, carry: int, last: bool) -> pd.DataFrame:
    """One group's round. ``rows`` has ``bin`` (-1: not in one yet) and ``length``; adds the new ``bin`` and ``done``."""
    rows = rows.reset_index(drop=True)
    length, old = rows["length"].to_numpy(), rows["bin"].to_numpy()

    def sizes(of: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=length).astype(np.int64)

    opened = best_fit(length, capacity)
    choice = opened
    if (old >= 0).any():  # bins handed up: each whole, as one item
        _, item = np.unique(old, return_inverse=True)
        whole = best_fit(sizes(item), capacity)[item]
        choice = whole if whole.max() <= opened.max() else opened
    fill = sizes(choice)
    room = capacity - fill
    done = (fill >= nearly_full * capacity) | (room < length.min()) | last
    spare = np.flatnonzero(~done)
    if len(spare) > carry:
        done[spare[np.argsort(fill[spare], kind="stable")][carry:]] = True
    rows["bin"], rows["done"] = choice, done[choice]
    return rows


def _step(*limits):
    def step(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_group(rows, *limits)

    return step


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, nearly_full: float = NEARLY_FULL, fan_in: int = FAN_IN, carry: int = CARRY) -> DataFrame:
    """``items`` (with ``length`` up to ``capacity``) plus ``sequence_id`` and ``offset``."""
    items = stored(items, "pieces")
    columns = items.columns
    kept = [F.col(c) for c in columns]
    full = items.where(F.col("length") == capacity)
    rest = items.where(F.col("length") < capacity)
    n = rest.count()
    groups = max(1, -(-n // group_items))
    result = [full.select(*kept, F.monotonically_increasing_id().alias("bin"), F.lit(-1).cast("long").alias("round"), F.lit(0).cast("long").alias("node"))]
    # the stored table gives a row the same number whenever it is read, so a repeated task deals it the same way
    todo = rest.select(*kept, F.lit(-1).cast("long").alias("bin"), F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).alias("node"))
    rnd = 0
    while n:
        last = groups == 1

        schema = todo.withColumn("done", F.lit(True)).schema
        out = stored(todo.groupBy("node").applyInPandas(_step(capacity, nearly_full, carry, last), schema), "packed")
        result.append(out.where("done").select(*kept, "bin", F.lit(rnd).cast("long").alias("round"), "node"))
        if last:
            break
        # bins of different groups get different numbers in the group above
        todo = out.where("not done").select(*kept, (F.col("node") % fan_in * 2**40 + F.col("bin")).alias("bin"), F.floor(F.col("node") / fan_in).alias("node"))
        groups = -(-groups // fan_in)
        rnd += 1
    packed = result[0]
    for r in result[1:]:
        packed = packed.unionByName(r)
    number = F.when(F.col("round") < 0, -1 - F.col("bin")).otherwise(F.col("round") * 2**56 + F.col("node") * 2**24 + F.col("bin"))
    packed = packed.withColumn("sequence_id", number.cast("long")).drop("round", "node", "bin")
    # a sequence holds at most ``capacity`` pieces, so this sum runs over a bounded group
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return packed.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long"))


def best_fit_packing(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per piece of every document with its ``sequence_id`` and ``offset``."""
    return pack(pieces(df, path, capacity, end_id, doc_id, text), capacity, **limits)
