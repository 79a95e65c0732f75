"""Hard negatives by an STR-packed R-tree: inner-product intervals of bounding boxes, searched best first.

1. Vectors become integers (``floor(scale * x)``), so every score is exact. Rows are put in sort-tile-recursive order: by label,
   then slabs of the most varying coordinate, in a slab slabs of the next, in these by the third. The slabs' borders come from
   at most about ``SAMPLE`` rows chosen by a hash; the order covers every row, and consecutive runs of ``TILE`` rows are tiles, equal
   in size whatever is frequent. Anchors are numbered in the same order and cut into blocks of ``ANCHORS``.
2. A task takes one tile and one block of anchors. It packs the tile into leaves of ``LEAF`` rows and nodes of ``FAN`` leaves;
   each has its bounding box and its range of labels. For an anchor the sum over coordinates of the smallest and the largest
   product bounds all inner products in a box from below and above.
3. Positives: a queue for each anchor opens the box of the highest upper bound first; boxes without the anchor's label and those
   strictly below the ``k``-th score so far are never opened. Ties are opened, as a smaller id may stand there.
4. Negatives: every positive gives its anchor a window of scores. Boxes outside all windows, or strictly below the ``k``-th
   negative of each window they meet, or of the anchor's label alone, are never opened.
5. The best of each tile are merged: ``k`` rows for each anchor (and window) and tile are shuffled.

The queues of a block's anchors advance together, so each step is array work. No box is skipped that could hold a result: the
result equals that of comparing everything.

Rows with a null id, label or vector, an empty vector, or a component that is null, not finite or beyond ``MOST_ABS`` in size
take no part. Only vectors of equal length (at most ``MOST_DIM``) meet. Rows repeated whole count once. Rows that share an id but differ each
take part, but never as each other's positive or negative. Equal scores go by smaller id. An anchor with no positive, and a
positive whose window holds nothing, give no rows; neither does an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigie.llm.common import stored
from vigie.plans.ids import surrogate_ids

TILE = 4096
LEAF = 64
FAN = 16
ANCHORS = 4096
#: Anchors whose queues advance together.
AT_ONCE = 1024
SAMPLE = 20_000
MOST_SLABS = 64
#: With these bounds every inner product of scaled components is an exact double.
MOST_ABS = 4096.0
MOST_DIM = 8192
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
NO_ID = np.iinfo(np.int64).max


# ---- rows in STR order ----------------------------------------------------------------------------------------------


def usable(df: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """``(vec_id, label, dim, vec)`` with integer components, once each."""
    fine = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) <= MOST_ABS))  # NaN counts as larger than any number
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.size("vec").between(1, MOST_DIM) & fine)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("int")))
    return rows.dropDuplicates(["vec_id", "label", "vec"]).select("vec_id", "label", F.size("vec").alias("dim"), "vec")


def _borders(x: np.ndarray, slabs: int) -> list[int]:
    at = np.arange(1, slabs) * len(x) // slabs
    return sorted(set(np.sort(x)[at].tolist())) if len(x) else []


def slab_columns(rows: DataFrame, total: int, tile: int, sample: int) -> tuple[Column, Column, Column]:
    """The first two slab numbers and the third coordinate of a row; borders by a sample of the rows."""
    few = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, sample / max(total, 1)) * (1 << 30))).select("vec").toPandas()["vec"]
    dim = max(map(len, few), default=1)
    x = np.zeros((len(few), dim))
    for i, v in enumerate(few):
        x[i, : len(v)] = v
    axis = np.argsort(-x.var(0), kind="stable")[:3].tolist() if len(x) else [0]
    axis += [axis[-1]] * (3 - len(axis))
    slabs = min(MOST_SLABS, max(1, round((total / tile) ** (1 / 3))))
    first = _borders(x[:, axis[0]], slabs)
    inside = np.searchsorted(first, x[:, axis[0]], side="right")
    second = [_borders(x[inside == s, axis[1]], slabs) for s in range(len(first) + 1)]
    at = [F.coalesce(F.get("vec", F.lit(a)), F.lit(0)) for a in axis]
    listed = lambda b: F.array(*map(F.lit, b)).cast("array<int>")
    s1 = F.size(F.filter(listed(first), lambda b: b <= at[0]))
    s2 = F.size(F.filter(F.get(F.array(*map(listed, second)), s1), lambda b: b <= at[1]))
    return s1, s2, at[2]


def str_order(rows: DataFrame, tile: int, sample: int) -> DataFrame:
    """``rows`` with ``pos``, their place in STR order, and ``tile``."""
    rows = stored(rows, "vectors")
    s1, s2, third = slab_columns(rows, rows.count(), tile, sample)
    keyed = rows.withColumns({"_s1": s1, "_s2": s2, "_s3": third, "_h": F.xxhash64("vec")})
    placed = surrogate_ids(keyed, ["dim", "label", "_s1", "_s2", "_s3", "vec_id", "_h"], "pos", 0)
    return stored(placed.drop("_s1", "_s2", "_s3", "_h").withColumn("tile", (F.col("pos") / tile).cast("long")), "tiles")


# ---- tree of a tile -------------------------------------------------------------------------------------------------


class Tree:
    """Root, nodes and leaves in one list; ``child`` has the children of what is no leaf, -1 where there is none."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, vec: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        n = len(ids)
        leaves = -(-n // leaf)
        slabs = max(1, round(leaves ** (1 / 3)))
        axis = np.argsort(-vec.var(0), kind="stable")[:3]
        x = [vec[:, a] for a in (*axis, *[axis[-1]] * (3 - len(axis)))]
        share = np.zeros((2, n), np.int64)
        for k, by in enumerate(((x[0], label), (x[1], share[0], label))):  # slabs of equal size in a label, then in a slab
            order = np.lexsort(by)
            group = np.stack([b[order] for b in by[1:]])
            new = np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(0)])
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, n))
            share[k, order] = (np.arange(n) - np.repeat(start, size)) * slabs // np.repeat(size, size)
        order = np.lexsort((ids, x[2], share[1], share[0], label))
        self.ids, self.label, self.vec = ids[order], label[order], vec[order]
        cut = np.arange(0, n, leaf)
        low, high = np.minimum.reduceat(self.vec, cut), np.maximum.reduceat(self.vec, cut)
        least, most = np.minimum.reduceat(self.label, cut), np.maximum.reduceat(self.label, cut)
        up = np.arange(0, leaves, fan)
        inner = len(up)
        tops = [(f.reduceat(b, up), f.reduce(b, axis=0, keepdims=True)) for f, b in ((np.minimum, low), (np.maximum, high), (np.minimum, least), (np.maximum, most))]
        self.low, self.high, self.least, self.most = (np.concatenate([root, node, b]) for (node, root), b in zip(tops, (low, high, least, most)))
        self.first_leaf = 1 + inner
        width = max(inner, fan)
        self.child = np.full((1 + inner, width), -1)
        self.child[0, :inner] = 1 + np.arange(inner)
        for k in range(inner):
            own = np.arange(up[k], min(up[k] + fan, leaves))
            self.child[1 + k, : len(own)] = self.first_leaf + own
        self.rows = np.minimum(cut[:, None] + np.arange(leaf)[None, :], n - 1)
        self.held = cut[:, None] + np.arange(leaf)[None, :] < n

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each anchor with anything in each box."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T

    def visit(self, key: np.ndarray, still, take) -> int:
        """Best-first walk of all anchors at once. ``key``: anchors x boxes, -inf where a box is out of question.

        ``still(anchors, boxes)`` says whether a box is worth opening now; ``take(anchors, leaves)`` gets the opened leaves. Returns how many
        leaves were opened.
        """
        queue = np.full(key.shape, -np.inf)
        queue[:, 0] = key[:, 0]
        alive, opened = np.arange(len(key)), 0
        while len(alive):
            box = queue[alive].argmax(1)
            some = queue[alive, box] > -np.inf
            alive, box = alive[some], box[some]
            queue[alive, box] = -np.inf
            worth = still(alive, box)
            who, box = alive[worth], box[worth]
            node = box < self.first_leaf
            child = self.child[box[node]]
            w, c = np.nonzero(child >= 0)
            w, c = who[node][w], child[w, c]
            queue[w, c] = key[w, c]
            if (~node).any():
                opened += int((~node).sum())
                take(who[~node], box[~node] - self.first_leaf)
        return opened

    def scores(self, q: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        return np.matmul(self.vec[self.rows[leaves]], q[:, :, None])[:, :, 0]


class Best:
    """The ``k`` best ``(score, id)`` of many queries; higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), -np.inf), np.full((n, k), NO_ID)

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        last, last_id = self.score[who, -1][:, None], self.id[who, -1][:, None]
        better = (score > last) | (score == last) & (ids < last_id) & (score > -np.inf)
        some = better.any(1)
        who, k = who[some], self.score.shape[1]
        s, i = np.concatenate([self.score[who], score[some]], 1), np.concatenate([self.id[who], ids[some]], 1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        self.score[who], self.id[who] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def best_positives(tree: Tree, ids: np.ndarray, label: np.ndarray, q: np.ndarray, k: int) -> Best:
    best = Best(len(q), k)
    _, up = tree.bounds(q)
    up[(label[:, None] < tree.least) | (label[:, None] > tree.most)] = -np.inf

    def take(who, leaves):
        rows = tree.rows[leaves]
        ok = tree.held[leaves] & (tree.label[rows] == label[who][:, None]) & (tree.ids[rows] != ids[who][:, None])
        best.add(who, np.where(ok, tree.scores(q[who], leaves), -np.inf), tree.ids[rows])

    tree.visit(up, lambda who, box: up[who, box] >= best.score[who, -1], take)
    return best


def best_negatives(tree: Tree, ids: np.ndarray, label: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[Best]:
    """One ``Best`` for each window column of ``low`` and ``high`` (anchors x windows); an empty window has low above high."""
    windows = low.shape[1]
    best = [Best(len(q), k) for _ in range(windows)]
    down, up = tree.bounds(q)
    key = np.full(up.shape, -np.inf)
    for w in range(windows):
        lo, hi = low[:, [w]], high[:, [w]]
        meets = (lo <= hi) & (up >= lo) & (down <= hi)
        key = np.where(meets, np.maximum(key, np.minimum(up, hi)), key)
    key[(tree.least == tree.most) & (tree.least == label[:, None])] = -np.inf

    def still(who, box):
        u, d = up[who, box], down[who, box]
        out = np.zeros(len(who), bool)
        for w in range(windows):
            lo, hi = low[who, w], high[who, w]
            out |= (lo <= hi) & (u >= lo) & (d <= hi) & (np.minimum(u, hi) >= best[w].score[who, -1])
        return out

    def take(who, leaves):
        rows = tree.rows[leaves]
        score = tree.scores(q[who], leaves)
        ok = tree.held[leaves] & (tree.label[rows] != label[who][:, None]) & (tree.ids[rows] != ids[who][:, None])
        for w in range(windows):
            inside = ok & (score >= low[who, w][:, None]) & (score <= high[who, w][:, None])
            some = inside.any(1)
            if some.any():
                best[w].add(who[some], np.where(inside, score, -np.inf)[some], tree.ids[rows[some]])

    tree.visit(key, still, take)
    return best


# ---- jobs -----------------------------------------------------------------------------------------------------------


def _matrix(vec: pd.Series) -> np.ndarray:
    return np.stack(vec.to_numpy()).astype(float)


def _halves(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    rows = group[group["an"].isna()].sort_values("pos")
    asked = group[group["an"].notna()].sort_values("pos")
    return rows, asked


FOUND = "an long, win int, id long, score long"


def _search_pair(k: int, windows: bool):
    """The best of one tile for one block of anchors, as ``FOUND``; window 0 stands for the positives."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows, asked = _halves(group)
        out = [pd.DataFrame({"an": [], "win": [], "id": [], "score": []}, dtype="int64")]
        if len(rows) and len(asked):
            vec, queries = _matrix(rows["vec"]), _matrix(asked["vec"])
            if np.abs(vec).max() * np.abs(queries).max() * vec.shape[1] < 1 << 24:
                vec, queries = vec.astype(np.float32), queries.astype(np.float32)  # still exact, half the bytes
            tree = Tree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), vec)
            for lo in range(0, len(asked), AT_ONCE):
                part = asked.iloc[lo : lo + AT_ONCE]
                own = (part["vec_id"].to_numpy(), part["label"].to_numpy(), queries[lo : lo + AT_ONCE])
                if windows:
                    low, high = (np.stack([np.pad(np.asarray(x, float), (0, POSITIVES - len(x)), constant_values=fill) for x in part[c]]) for c, fill in (("low", 1.0), ("high", 0.0)))
                    found = best_negatives(tree, *own, low, high, k)
                else:
                    found = [best_positives(tree, *own, k)]
                for w, best in enumerate(found):
                    i, j = np.nonzero(best.score > -np.inf)
                    out.append(pd.DataFrame({"an": part["an"].to_numpy(np.int64)[i], "win": w, "id": best.id[i, j], "score": best.score[i, j].astype(np.int64)}))
        return pd.concat(out).astype({"win": "int32"})

    return run


def _met(placed: DataFrame, asked: DataFrame, pairs: DataFrame, k: int, windows: bool) -> DataFrame:
    """``asked`` carries (block, an, ...); ``pairs`` (block, tile, dim): which anchors meet which tiles."""
    extra = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    base = ["tile", "block", "dim", "pos", "vec_id", "label", "vec"]
    rows = placed.join(pairs, ["dim", "tile"]).select(*base, F.lit(None).cast("long").alias("an"), *extra)
    mine = asked.drop("tile").join(pairs, ["block", "dim"]).select(*base, "an", "low", "high")
    return rows.unionByName(mine).groupBy("tile", "block", "dim").applyInPandas(_search_pair(k, windows), FOUND)


def hard_negatives(df: DataFrame, anchors: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PERCENT, most: int = MOST_PERCENT, tile: int = TILE, block: int = ANCHORS, sample: int = SAMPLE) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors``: a condition on ``vec_id`` and ``label``. A negative's score lies between ``least`` and ``most`` percent of the positive's.
    """
    if positives > POSITIVES:
        raise ValueError(f"at most {POSITIVES} positives")
    placed = str_order(usable(df, vec_id, embedding, label, scale), tile, sample)
    asked = surrogate_ids(placed.where(F.coalesce(anchors, F.lit(False))), ["pos"], "an", 0)
    asked = stored(asked.withColumn("block", (F.col("an") / block).cast("long")), "anchors")
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]

    spans = placed.groupBy("dim", "label").agg(F.min("tile").alias("t0"), F.max("tile").alias("t1"))
    here = asked.select("block", "dim", "label").distinct().join(spans, ["dim", "label"])
    near = here.select("block", "dim", F.explode(F.sequence("t0", "t1")).alias("tile")).distinct()
    found = _met(placed, asked.select("*", *none), near, positives, False)
    order = Window.partitionBy("an").orderBy(F.desc("score"), "id")
    chosen = stored(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).select("an", "place", "id", "score"), "positives")

    low = F.ceil(F.col("score") * least / 100)
    window = F.struct("place", low.alias("low"), F.floor(F.col("score") * most / 100).alias("high"))
    ranges = chosen.groupBy("an").agg(F.array_sort(F.collect_list(window)).alias("w"))  # at most ``positives`` entries
    ranged = asked.join(ranges, "an").withColumns({"low": F.col("w.low"), "high": F.col("w.high")}).drop("w")
    whole = placed.groupBy("dim").agg(F.min("tile").alias("t0"), F.max("tile").alias("t1"))
    every = asked.select("block", "dim").distinct().join(whole, "dim").select("block", "dim", F.explode(F.sequence("t0", "t1")).alias("tile"))
    met = _met(placed, ranged, every, negatives, True)
    order = Window.partitionBy("an", "win").orderBy(F.desc("score"), "id")
    hard = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = chosen.join(asked.select("an", F.col("vec_id").alias("anchor_id")), "an").select("an", (F.col("place") - 1).cast("int").alias("win"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(named, ["an", "win"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
