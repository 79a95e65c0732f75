"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, sorted-array intersection, connected components.

A document's set holds the 64-bit hashes of its distinct ``n``-word shingles. Two documents link when
``100 * |A & B| >= percent * |A | B|``. The steps:

1. Documents with equal sets fall into one class; from here on one document stands for each class.
2. A link needs a share of ``percent`` of the smaller set to occur in some other set too, so documents whose sets hold
   too few shared shingles are alone. Shingles go to hash partitions as packed arrays, one row per block of documents and
   partition, and come back as counts. This leaves the near copies, usually a small part.
3. The rest get exact shingle frequencies the same way. With shingles ordered from rare to frequent, linked documents
   share one among their first ``(1 - percent) * size + 1``. Documents that share such a prefix shingle are tied, and the
   connected ones form a candidate group.
4. A group is cut, by size order, into blocks; two blocks make a tile if their size bands can meet. In a tile, hashed
   bitmaps bound each overlap from above by bit counts; pairs the bound cannot exclude are intersected exactly, except
   those known to be connected already. A tile puts out the links that connect something new.
5. Connected components over these links, then back from classes to documents.

No step drops or caps anything: a frequent shingle costs one array entry per document, a large group more tiles.

Words are stretches without ASCII white space, A-Z lower-cased. Fewer than ``n`` words: the whole sequence is the one
shingle. Null, empty or blank text: an empty set, linked with nothing (component: its own id). Repeated rows (same id)
count as one document. A null id counts as an id after all others and comes back as null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import NULL_ID, components, stored

N = 5
PERCENT = 80
#: Documents in one block of packed rows.
BLOCK_DOCS = 4096
#: Shingles a hash partition holds on average.
PART_SHINGLES = 1_000_000
TILE_DOCS = 512
BITS = 1024


# ---- sets -----------------------------------------------------------------------------------------------------------


def shingles(data: bytes, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of UTF-8 text."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    take = min(n, len(h))
    out = np.full(len(h) - take + 1, take, np.uint64)
    for k in range(take):  # mixed after each word, so order matters
        out = (out ^ h[k : len(h) - take + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def sets(df: DataFrame, n: int = N, doc_id: str = "doc_id", text: str = "text", with_set: bool = True) -> DataFrame:
    """``(doc_id, size, digest, items)``: the set and a 128-bit digest of it; ``items`` is packed uint64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t.as_py() or b"", n) for t in b.column(1)]
            packed = [s.tobytes() for s in found]
            cols = [b.column(0), pa.array(list(map(len, found)), pa.int64()), pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary())]
            if with_set:
                cols.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "size", "digest", "items"][: len(cols)])

    rows = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, size long, digest binary" + ", items binary" * with_set)


# ---- how often shingles occur ---------------------------------------------------------------------------------------


def _deal(rows: DataFrame, parts: int, n: int | None) -> DataFrame:
    """Packed rows ``(part, block, items, who)``: the shingles of one block of documents in one hash partition.

    ``rows`` has ``doc_id`` and either ``items`` or, with ``n``, a text to take them from. ``who`` says which document of
    the block each shingle is from. One more row per block, with a negative ``part``, holds the documents and their sizes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        held: list[np.ndarray] = []

        def flush():
            lens = np.fromiter(map(len, held), np.int64, len(held))
            docs, sizes = np.array(ids, np.int64).tobytes(), lens.tobytes()
            block = int.from_bytes(hashlib.blake2b(docs, digest_size=8).digest(), "little", signed=True)
            flat = np.concatenate(held)
            # the partition is taken from the high bits; 32 other bits stand for the shingle inside it
            part = ((flat >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            who = np.repeat(np.arange(len(held), dtype=np.uint16), lens)
            order = np.argsort(part, kind="stable")
            low, who = flat[order].astype(np.uint32), who[order]
            cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
            out = [(p, block, low[a:b].tobytes(), who[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            out.append((-1 - block % parts, block, docs, sizes))
            ids.clear(), held.clear()
            types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["part", "block", "items", "who"])

        size = 0
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                s = shingles(x.as_py() or b"", n) if n else np.frombuffer(x.as_py(), np.uint64)
                if len(s):
                    ids.append(i)
                    held.append(s)
                    size += len(s)
                if len(ids) >= BLOCK_DOCS or size >= PART_SHINGLES:
                    yield flush()
                    size = 0
        if ids:
            yield flush()

    return rows.mapInArrow(run, "part int, block long, items binary, who binary")


ANSWER = "block long, part int, who binary, items binary, freq binary"


def _frequent(group: pd.DataFrame) -> pd.DataFrame:
    """``ANSWER``: of every row of a partition the shingles that occur more than once in it, with how often (65,535: at
    least that often; an order by it is the same for all documents). Rows that hold documents pass."""
    if group["part"].iloc[0] < 0:
        return pd.DataFrame({"block": group["block"], "part": group["part"], "who": group["who"], "items": group["items"], "freq": b""})
    items = [np.frombuffer(x, np.uint32) for x in group["items"]]
    _, inverse, counts = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    freq = np.minimum(counts, 65535).astype(np.uint16)[inverse]
    cuts = np.cumsum([0, *map(len, items)])
    out = []
    for own, who, a, b in zip(items, group["who"], cuts, cuts[1:]):
        keep = freq[a:b] > 1
        out.append((np.frombuffer(who, np.uint16)[keep].tobytes(), own[keep].tobytes(), freq[a:b][keep].tobytes()))
    return pd.DataFrame({"block": group["block"], "part": group["part"]} | {k: [r[i] for r in out] for i, k in enumerate(("who", "items", "freq"))})


def _counted(group: pd.DataFrame) -> pd.DataFrame:
    """``_frequent`` with nothing but how many such shingles each document has: ``who`` lists documents, ``items`` counts."""
    out = _frequent(group)
    if group["part"].iloc[0] >= 0:
        pairs = [np.unique(np.frombuffer(w, np.uint16), return_counts=True) for w in out["who"]]
        out["who"], out["items"], out["freq"] = [w.tobytes() for w, _ in pairs], [n.astype(np.uint32).tobytes() for _, n in pairs], b""
    return out


def _block(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """A block's documents, their sizes, and its answers."""
    own = group[group["part"] < 0].iloc[0]
    return np.frombuffer(own["items"], np.int64), np.frombuffer(own["who"], np.int64), group[group["part"] >= 0]


def shared_counts(dealt: DataFrame) -> DataFrame:
    """``(doc_id, shared)``: how many shingles of each document occur in another one as well."""

    def block(group: pd.DataFrame) -> pd.DataFrame:
        docs, _, rows = _block(group)
        total = np.zeros(len(docs), np.int64)
        for who, n in zip(rows["who"], rows["items"]):
            total[np.frombuffer(who, np.uint16)] += np.frombuffer(n, np.uint32)  # a document stands once in a row
        return pd.DataFrame({"doc_id": docs, "shared": total})

    return dealt.groupBy("part").applyInPandas(_counted, ANSWER).groupBy("block").applyInPandas(block, "doc_id long, shared long")


def prefix_rows(dealt: DataFrame, percent: int) -> DataFrame:
    """``(token, doc_id)``: each document's prefix in the order (frequency, token), without what no other document has."""

    def block(group: pd.DataFrame) -> pd.DataFrame:
        docs, size, rows = _block(group)
        empty = np.zeros(0, np.int64)
        who = np.concatenate([empty, *[np.frombuffer(x, np.uint16) for x in rows["who"]]])
        freq = np.concatenate([empty, *[np.frombuffer(x, np.uint16) for x in rows["freq"]]])
        token = np.concatenate([empty, *[np.int64(p) << 32 | np.frombuffer(x, np.uint32).astype(np.int64) for p, x in zip(rows["part"], rows["items"])]])
        order = np.lexsort((token, freq, who))
        who, token = who[order], token[order]
        shared = np.bincount(who, minlength=len(docs))
        place = np.arange(len(who)) - np.repeat(np.cumsum(shared) - shared, shared) + (size - shared)[who]  # the others come first
        keep = place <= (size - -(-percent * size // 100))[who]
        return pd.DataFrame({"token": token[keep], "doc_id": docs[who[keep]]})

    return dealt.groupBy("part").applyInPandas(_frequent, ANSWER).groupBy("block").applyInPandas(block, "token long, doc_id long")


# ---- tiles ----------------------------------------------------------------------------------------------------------


def _bitmaps(items: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(items), BITS // 8), np.uint8)
    for row, s in zip(out, items):
        bits = np.zeros(BITS, np.uint8)
        bits[s % np.uint64(BITS)] = 1
        row[:] = np.packbits(bits)
    return out.view(np.uint64)


def tile_links(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect something new among ``left``, or between ``left`` and ``right``."""
    inner = right is None
    right = left if inner else right
    ids = [i for i, _ in left] + ([] if inner else [i for i, _ in right])
    shift = 0 if inner else len(left)
    root = np.arange(len(ids))  # the class of every document of the tile
    size_l = np.array([len(s) for _, s in left], np.int64)
    size_r = np.array([len(s) for _, s in right], np.int64)
    map_l, map_r = _bitmaps([s for _, s in left]), _bitmaps([s for _, s in right])
    out = []
    for i, (a, s) in enumerate(left):
        js = np.arange(i + 1, len(right)) if inner else np.arange(len(right))
        js = js[(100 * np.minimum(size_r[js], len(s)) >= percent * np.maximum(size_r[js], len(s)))]
        if not len(js):
            continue
        # a bit set on one side only stands for at least one item of that side outside the other
        only_l = np.bitwise_count(map_l[i] & ~map_r[js]).sum(1, dtype=np.int64)
        only_r = np.bitwise_count(map_r[js] & ~map_l[i]).sum(1, dtype=np.int64)
        most = np.minimum(len(s) - only_l, size_r[js] - only_r)
        js = js[100 * most >= percent * (len(s) + size_r[js] - most)]
        for j in js:
            if root[i] == root[shift + j]:
                continue
            t = right[j][1]
            at = np.searchsorted(t, s)
            common = int((t[np.minimum(at, len(t) - 1)] == s).sum())
            if 100 * common >= percent * (len(s) + len(t) - common):
                out.append((a, right[j][0]))
                root[root == root[shift + j]] = root[i]
    return out


def group_links(items: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` links inside each candidate group. ``items(doc_id, size, items)``, ``groups(doc_id, grp)``."""
    sized = items.select("doc_id", "size").join(groups, "doc_id")
    # blocks by size order, cut by range so that no task sorts a whole group: bands first, then ranks inside a band
    banded = sized.withColumn("band", F.floor(F.log("size") / F.log(F.lit(1.25))).cast("int"))
    counts = banded.groupBy("grp", "band").agg(F.count("*").alias("n"))
    cut = banded.join(counts, ["grp", "band"]).withColumn("blocks", F.ceil(F.col("n") / TILE_DOCS).cast("int"))
    placed = stored(cut.select("doc_id", "grp", "band", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("blk")), "blocks")
    blocks = placed.groupBy("grp").agg(F.collect_set(F.struct("band", "blk")).alias("all"))  # a group's blocks: its documents / TILE_DOCS
    # sizes that can link differ by at most 100 / percent
    reach = int(np.ceil(np.log(100 / percent) / np.log(1.25) - 1e-9))
    alone = counts.groupBy("grp").agg(F.sum("n").alias("docs"))
    small = alone.where(F.col("docs") <= TILE_DOCS).select("grp")
    big = blocks.join(alone.where(F.col("docs") > TILE_DOCS), "grp")
    pairs = (
        big.select("grp", F.explode("all").alias("x"), "all")
        .select("grp", "x", F.explode("all").alias("y"))
        .where(f"x <= y AND y.band - x.band <= {reach}")
        .select("grp", F.concat_ws("_", "x.band", "x.blk", "y.band", "y.blk").alias("tile"), "x", "y")
    )
    side = lambda k, s: pairs.select("grp", "tile", F.col(f"{k}.band").alias("band"), F.col(f"{k}.blk").alias("blk"), F.lit(s).alias("side"))
    # a tile of a block with itself has one side
    ends = side("x", 0).union(side("y", 1).where(F.expr("split(tile, '_')[0] <> split(tile, '_')[2] OR split(tile, '_')[1] <> split(tile, '_')[3]")))
    rows = placed.join(ends, ["grp", "band", "blk"]).select("doc_id", "grp", "tile", "side")
    whole = placed.join(small, "grp").select("doc_id", "grp", F.lit("all").alias("tile"), F.lit(0).alias("side"))
    tiles = rows.union(whole).join(items, "doc_id")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        side = [[(r.doc_id, np.frombuffer(r.items, np.uint64)) for r in group[group["side"] == k].itertuples()] for k in (0, 1)]
        found = tile_links(side[0], side[1] or None, percent)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return tiles.select("doc_id", "grp", "tile", "side", "items").groupBy("grp", "tile").applyInPandas(run, "a long, b long")


# ---- the join -------------------------------------------------------------------------------------------------------


def jaccard_components(df: DataFrame, n: int = N, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``df``."""
    every = stored(sets(df, n, doc_id, text, with_set=False), "sets")
    total = every.agg(F.sum("size")).first()[0] or 0
    parts = max(8, -(-total // PART_SHINGLES))
    rows = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    classes = stored(every.where("size > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("size").alias("size")), "classes")
    shared = shared_counts(_deal(rows, parts, n))
    # sets kept for the documents that stand for their class and share enough
    near = shared.groupBy("doc_id").agg(F.max("shared").alias("shared")).join(classes.withColumnRenamed("rep", "doc_id"), "doc_id")
    near = stored(near.where(F.col("shared") * 100 >= F.col("size") * percent).select("doc_id"), "near")
    texts = rows.join(near, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    items = stored(sets(texts, n).select("doc_id", "size", "items"), "items")
    # again without the copies: what only equal sets shared falls away here
    dealt = _deal(items.select("doc_id", "items"), parts, None)
    prefix = stored(prefix_rows(dealt, percent), "prefix")
    first = prefix.groupBy("token").agg(F.min("doc_id").alias("center"))
    ties = prefix.join(stored(first, "centers"), "token").where("doc_id <> center").select(F.col("doc_id").alias("a"), F.col("center").alias("b")).distinct()
    groups = components(ties, "ties").selectExpr("node as doc_id", "component as grp")
    links = stored(group_links(items, stored(groups.distinct(), "groups"), percent), "links")
    comp = stored(components(links, "comp").distinct(), "components")
    by_class = classes.join(comp, classes["rep"] == comp["node"], "left").select("digest", F.coalesce("component", "rep").alias("component"))
    by_class = stored(by_class, "by_class")
    out = every.join(by_class, "digest", "left").select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.coalesce(F.when(F.col("size") > 0, F.col("component")), F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("component_id", F.when(F.col("component_id") != NULL_ID, F.col("component_id")))
