"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors with equal labels become one node that knows how many rows it stands for.
2. Cluster centres come from a bounded sample (``SAMPLE`` nodes, all labels together; k-means on the driver). Every node goes
   to the ``overlap`` nearest centres of its label: overlapping shards. A shard of more than ``SHARD_LIMIT`` nodes is cut
   into blocks, and every two blocks make a tile, so no task holds more than two blocks, whatever the data.
3. Build: in each tile, nodes are linked to near ones by robust pruning (a candidate is dropped when a chosen neighbour is
   clearly nearer to it), plus some far nodes; nodes the medoid cannot reach are tied to their nearest reachable one.
4. The adjacency lists of all tiles are united by node.
5. Search: in each tile every node is a query. A greedy beam search starts at the medoid; then the range is expanded from
   the query and from every node found, as long as new nodes within the threshold turn up. Similarities are cosines in
   double precision, so a link found is a verified one.
6. A pair that several tiles can see is counted in the first of them. Each tile puts out how many rows each node links
   with, and a spanning forest of its links; components follow from the forests.
7. Audit: for up to ``AUDIT_QUERIES`` nodes the links are compared with brute force over all nodes, in sum and as the mean
   recall of a node with links, so that large groups cannot hide small ones. Below ``MIN_RECALL`` the whole search is
   repeated with twice the overlap. Beyond ``MAX_OVERLAP`` every label is one shard, so its blocks meet two by two; if even
   that misses the bound, the job fails.

A tile's memory is bounded by its nodes, however many of them are near copies: hubs are pruned, a range grows over the
tile's adjacency matrix, and cosines are taken for ``PRODUCTS`` numbers at a time.

Only vectors with equal, non-null labels and equal length are compared. Vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing. A null id counts as an id after all others. Rows that repeat an id and a
vector count as one vector and each gets its result. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import NULL_ID, components, stored

THRESHOLD = 0.93
SAMPLE = 20_000
SHARD_NODES = 384
SHARD_LIMIT = 1024
DEGREE = 24
CANDIDATES = 48
FAR_NODES = 8
ALPHA = 1.2
BEAM = 16
OVERLAP = 2
AUDIT_QUERIES = 256
MAX_OVERLAP = 16
#: A node with more neighbours than this (reverse edges) is pruned again to ``2 * DEGREE``.
HUB = 4 * DEGREE
#: Numbers gathered at once when cosines are worked out.
PRODUCTS = 1 << 21
MIN_RECALL = 0.95


# ---- graph of one tile ----------------------------------------------------------------------------------------------


def robust_prune(x: np.ndarray, at: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of the nodes ``at`` out of ``cand`` (nodes x candidates); -1 fills a row.

    Candidates are taken nearest first; one taken drops those it is ``alpha`` times nearer to than the node is.
    """
    dist = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,ncd->nc", x[at], x[cand]), 0))
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    alive = cand != at[:, None]
    out = np.full((len(at), degree), -1)
    rows = np.arange(len(at))
    for k in range(degree):
        any_left = alive.any(1)
        if not any_left.any():
            break
        pick = alive.argmax(1)
        node = cand[rows, pick]
        out[any_left, k] = node[any_left]
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,ncd->nc", x[node], x[cand]), 0))
        alive &= alpha * between > dist
        alive[rows, pick] = False
    return out


def build(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Adjacency lists of a tile's nodes; all nodes can be reached from the medoid."""
    m = len(x)
    if m == 1:
        return [np.zeros(0, np.int64)]
    rng = np.random.default_rng(seed)
    links: list[set[int]] = [set() for _ in range(m)]
    for lo in range(0, m, 256):
        at = np.arange(lo, min(m, lo + 256))
        sim = x[at] @ x.T
        sim[np.arange(len(at)), at] = -2
        near = np.argpartition(-sim, min(CANDIDATES, m - 1) - 1, axis=1)[:, :CANDIDATES]
        far = rng.integers(0, m, (len(at), FAR_NODES))
        for i, row in zip(at, robust_prune(x, at, np.concatenate([near, far], 1), DEGREE, ALPHA)):
            for j in row[row >= 0]:
                links[i].add(int(j))
                links[j].add(int(i))
    for i in range(m):
        if len(links[i]) > HUB:
            picked = robust_prune(x, np.array([i]), np.array([sorted(links[i])]), 2 * DEGREE, ALPHA)[0]
            links[i] = set(picked[picked >= 0].tolist())
    reached = np.zeros(m, bool)
    queue = [medoid(x)]
    reached[queue] = True
    while True:
        while queue:
            for j in links[queue.pop()]:
                if not reached[j]:
                    reached[j] = True
                    queue.append(j)
        lost = np.flatnonzero(~reached)
        if not len(lost):
            break
        known = np.flatnonzero(reached)
        j, i = int(lost[0]), int(known[(x[known] @ x[lost[0]]).argmax()])
        links[i].add(j), links[j].add(i)
        reached[j] = True
        queue = [j]
    return [np.array(sorted(s), np.int64) for s in links]


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def search(x: np.ndarray, links: list[np.ndarray], threshold: float, at_once: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(query, node)`` pairs within the threshold, query != node, for batches of queries."""
    m = len(x)
    width = max([1, *map(len, links)])
    near = np.full((m, width), -1)
    edges = np.zeros((m, m), np.float32)
    for i, own in enumerate(links):
        near[i, : len(own)] = own
        edges[i, own] = 1
    start = medoid(x)
    for lo in range(0, m, at_once):
        q = np.arange(lo, min(m, lo + at_once))
        rows = np.arange(len(q))
        seen = np.zeros((len(q), m), bool)
        beam = np.full((len(q), BEAM), -1)
        sim = np.full((len(q), BEAM), -3.0)
        opened = np.ones((len(q), BEAM), bool)
        beam[:, 0], sim[:, 0], opened[:, 0], seen[:, start] = start, x[q] @ x[start], False, True
        at_start = rows[sim[:, 0] >= threshold]
        hits_q, hits_n = [at_start], [np.full(len(at_start), start)]
        active = rows
        while len(active):
            b = np.where(opened[active], -4.0, sim[active]).argmax(1)
            opened[active, b] = True
            nodes = near[beam[active, b]]
            fresh = (nodes >= 0) & ~seen[active[:, None], nodes]
            who, col = np.nonzero(fresh)
            node = nodes[who, col]
            who = active[who]
            seen[who, node] = True
            s = cosines(x, q[who], node)
            ok = s >= threshold
            hits_q.append(who[ok])
            hits_n.append(node[ok])
            more = np.full(nodes.shape, -3.0)
            more[fresh] = s
            every = np.concatenate([sim[active], more], 1)
            top = np.argpartition(-every, BEAM - 1, axis=1)[:, :BEAM]
            sim[active] = np.take_along_axis(every, top, 1)
            beam[active] = np.take_along_axis(np.concatenate([beam[active], nodes], 1), top, 1)
            opened[active] = np.take_along_axis(np.concatenate([opened[active], ~fresh], 1), top, 1)
            active = active[~opened[active].all(1)]
        # the query itself is a node of the graph and in range
        hits_q.append(rows), hits_n.append(q)
        seen[rows, q] = True
        hit = np.zeros((len(q), m), bool)
        hit[np.concatenate(hits_q), np.concatenate(hits_n)] = True
        front = hit
        while front.any():
            node = np.flatnonzero(front.any(0))  # the next step: neighbours of the front, of all queries at once
            who, node = np.nonzero((front[:, node].astype(np.float32) @ edges[node] > 0) & ~seen)
            seen[who, node] = True
            ok = cosines(x, q[who], node) >= threshold
            front = np.zeros_like(hit)
            front[who[ok], node[ok]] = True
            hit |= front
        hit[rows, q] = False
        at, node = np.nonzero(hit)
        yield q[at], node


def cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the rows ``a`` and ``b`` of ``x``, gathered in bounded pieces."""
    step = max(1, PRODUCTS // x.shape[1])
    return np.concatenate([np.zeros(0), *(np.einsum("nd,nd->n", x[a[lo : lo + step]], x[b[lo : lo + step]]) for lo in range(0, len(a), step))])


# ---- Spark side -----------------------------------------------------------------------------------------------------


def _unit(binary) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in binary])


def unit_vectors(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``(vec_id, label, dim, vec)`` of usable rows; ``vec`` is the unit vector in doubles."""
    good = F.col(embedding).isNotNull() & F.col(label).isNotNull() & (F.size(embedding) > 0)
    rows = df.where(good).select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NULL_ID)).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out, dims = [], [], []
            for i, v in enumerate(b.column(2)):
                x = np.array([np.nan if c is None else c for c in v.as_py()], float)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top  # neither over- nor underflow in the squares
                    keep.append(i)
                    dims.append(len(x))
                    out.append((x / np.sqrt((x * x).sum())).tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "label", "dim", "vec"])

    return rows.mapInArrow(run, "vec_id long, label string, dim int, vec binary")


def centres(nodes: DataFrame, total: int, shard_nodes: int, sample: int, rounds: int = 6) -> dict[tuple, np.ndarray]:
    """k-means centres by (label, dim), from at most about ``sample`` nodes picked by a hash of their id."""
    share = min(1.0, sample / max(total, 1))
    picked = nodes.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * sample).select("label", "dim", "vec").toPandas()
    out = {}
    for key, rows in picked.groupby(["label", "dim"]):
        x = _unit(rows["vec"])
        k = max(1, min(len(x), round(len(x) / share / shard_nodes)))
        c = x[np.random.default_rng(1).choice(len(x), k, replace=False)]
        for _ in range(rounds if k > 1 else 0):
            own = (x @ c.T).argmax(1)
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            norm = np.linalg.norm(sums, axis=1)
            c = np.where(norm[:, None] > 1e-12, sums / np.maximum(norm, 1e-12)[:, None], c)
        out[key] = c
    return out


def assign(nodes: DataFrame, found: dict[tuple, np.ndarray], overlap: int) -> DataFrame:
    """``(vec_id, n_rows, vec, shards, shard)``: one row for each of a node's nearest centres."""
    shared = nodes.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            frame = b.to_pandas()
            for key, rows in frame.groupby(["label", "dim"]):
                c = shared.value.get(key)
                if c is None:  # a label the sample missed: one shard
                    c = np.ones((1, int(key[1])))
                near = np.argsort(-(_unit(rows["vec"]) @ c.T), axis=1, kind="stable")[:, :overlap]
                names = [sorted(f"{key[0]}/{key[1]}/{i}" for i in own) for own in near]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["vec_id"], pa.int64()), pa.array(rows["n_rows"], pa.int64()), pa.array(list(rows["vec"]), pa.binary()), pa.array(names, pa.list_(pa.string()))], ["vec_id", "n_rows", "vec", "shards"]
                )

    out = nodes.select("vec_id", "label", "dim", "vec", "n_rows").mapInArrow(run, "vec_id long, n_rows long, vec binary, shards array<string>")
    return out.select("*", F.explode("shards").alias("shard"))


def tiles(members: DataFrame, limit: int) -> DataFrame:
    """``members`` by tile: a shard within ``limit`` is one tile, a larger one a tile for every two of its blocks."""
    sizes = members.groupBy("shard").agg(F.count("*").alias("n")).select("shard", F.ceil(F.col("n") / limit).cast("int").alias("blocks"))
    rows = members.join(stored(sizes, "shards"), "shard").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("vec_id", "n_rows", "vec", "shards", "shard", "block", other)
    return rows.select("vec_id", "n_rows", "vec", "shards", "shard", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def _build_tile(group: pd.DataFrame) -> pd.DataFrame:
    ids = group["vec_id"].to_numpy()
    return pd.DataFrame({"vec_id": ids, "near": [ids[own] for own in build(_unit(group["vec"]))]})


def _runs(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Each value of the sorted ``a`` with its stretch of ``b``."""
    values, starts = np.unique(a, return_index=True)
    return values.tolist(), np.split(b, starts[1:]) if len(values) else []


def _search_tile(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        ids, weight, block = group["vec_id"].to_numpy(), group["n_rows"].to_numpy(), group["block"].to_numpy()
        place = {v: i for i, v in enumerate(ids.tolist())}
        links = [np.array([place[j] for j in own if j in place], np.int64) for own in group["near"]]
        shard, lo, hi = group["shard"].iloc[0], group["lo"].iloc[0], group["hi"].iloc[0]
        shards = [list(s) for s in group["shards"]]
        kind, code = [], {}  # nodes with equal shard lists are of one kind
        for s in shards:
            kind.append(code.setdefault(tuple(s), len(code)))
        kinds, kind = list(code), np.array(kind)
        mine = np.zeros((len(kinds), len(kinds)), bool)
        for i, s in enumerate(kinds):
            for j, t in enumerate(kinds):
                mine[i, j] = min(set(s) & set(t)) == shard
        count = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        forest = []
        x = _unit(group["vec"])
        for a, b in search(x, links, threshold):
            ok = mine[kind[a], kind[b]] & (block[a] != block[b] if lo != hi else np.ones(len(a), bool))
            count += np.bincount(a[ok], weights=weight[b[ok]], minlength=len(ids)).astype(np.int64)
            for i, near in zip(*_runs(a, b)):
                trees, first = np.unique(root[near], return_index=True)
                other = trees != root[i]
                forest += [(i, j) for j in near[first[other]].tolist()]
                root[np.isin(root, trees[other])] = root[i]
        out = pd.DataFrame({"vec_id": ids, "links": count, "other": -1})
        tree = pd.DataFrame(forest, columns=["i", "j"]).astype("int64")
        return pd.concat([out, pd.DataFrame({"vec_id": ids[tree["i"]], "links": 0, "other": ids[tree["j"]]})])

    return run


def _links(nodes: DataFrame, total: int, overlap: int, threshold: float, shard_nodes: int, limit: int, sample: int) -> DataFrame:
    found = centres(nodes, total, shard_nodes, sample) if overlap <= MAX_OVERLAP else {}  # without centres a label is one shard
    members = stored(assign(nodes, found, overlap), "members")
    tiled = stored(tiles(members, limit), "tiles")
    edges = tiled.select("vec_id", "vec", "shard", "lo", "hi").groupBy("shard", "lo", "hi").applyInPandas(_build_tile, "vec_id long, near array<long>")
    graph = stored(edges.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    found = tiled.join(graph, "vec_id").groupBy("shard", "lo", "hi").applyInPandas(_search_tile(threshold), "vec_id long, links long, other long")
    return stored(found, "found")


def brute_force(queries: pd.DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``(vec_id, links)`` of a bounded set of query nodes against all ``nodes``, in blocks."""
    shared = nodes.sparkSession.sparkContext.broadcast({k: (g["vec_id"].to_numpy(), _unit(g["vec"])) for k, g in queries.groupby(["label", "dim"])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            for key, rows in b.to_pandas().groupby(["label", "dim"]):
                ids, q = shared.value.get(key, (None, None))
                if ids is None:
                    continue
                hit = (q @ _unit(rows["vec"]).T >= threshold) & (ids[:, None] != rows["vec_id"].to_numpy()[None])
                for i, n in zip(ids.tolist(), (hit * rows["n_rows"].to_numpy()[None]).sum(1).tolist()):
                    total[i] = total.get(i, 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["vec_id", "links"])

    out = nodes.select("vec_id", "label", "dim", "vec", "n_rows").mapInArrow(run, "vec_id long, links long")
    return out.groupBy("vec_id").agg(F.sum("links").alias("links"))


def _recall(true: DataFrame, counts: DataFrame) -> float:
    """The lower of two shares of the true links found: over all links, and on average over the nodes that have some."""
    both = true.selectExpr("vec_id", "links as want").where("want > 0").join(counts, "vec_id", "left").withColumn("got", F.least("want", F.coalesce("links", F.lit(0))))
    sums = both.agg((F.sum("got") / F.sum("want")).alias("links"), F.avg(F.col("got") / F.col("want")).alias("nodes")).first()
    return 1.0 if sums["links"] is None else min(sums)


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, overlap: int = OVERLAP, shard_nodes: int = SHARD_NODES, limit: int = SHARD_LIMIT, sample: int = SAMPLE, audit: int = AUDIT_QUERIES) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``df``."""
    rows = stored(unit_vectors(df, vec_id, embedding, label).distinct(), "vectors")
    nodes = rows.groupBy("label", "dim", "vec").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n_rows"))
    nodes = stored(nodes, "nodes")
    total = nodes.count()
    queries = nodes.orderBy(F.xxhash64("vec_id")).limit(audit).toPandas() if audit and total else None
    while True:
        found = _links(nodes, total, overlap, threshold, shard_nodes, limit, sample)
        counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
        if queries is None:
            break
        if _recall(brute_force(queries, nodes, threshold), counts) >= MIN_RECALL:
            break
        if overlap > MAX_OVERLAP:
            raise RuntimeError(f"near-duplicate search: audited recall stays below {MIN_RECALL} with every two blocks of a label searched")
        overlap *= 2
    comp = components(found.where("other >= 0").selectExpr("vec_id as a", "other as b"), "vectors").distinct()
    per_node = counts.join(stored(comp, "components"), counts["vec_id"] == F.col("node"), "left").select(counts["vec_id"].alias("rep"), "links", F.coalesce("component", counts["vec_id"]).alias("component_id"))
    per_node = stored(per_node.join(nodes.select(F.col("vec_id").alias("rep"), "label", "dim", "vec", "n_rows"), "rep"), "results")
    by_id = rows.join(per_node, ["label", "dim", "vec"]).select("vec_id", (F.col("links") + F.col("n_rows") - 1).alias("n_links"), "component_id")
    # one id with several vectors: all their links
    by_id = stored(by_id.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")), "by_id")
    every = df.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NULL_ID)).alias("vec_id")).join(by_id, "vec_id", "left")
    own = F.coalesce("component_id", "vec_id")
    back = lambda c: F.when(c != NULL_ID, c)
    return every.select(back(F.col("vec_id")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), back(own).alias("component_id"), (F.col("vec_id") == own).alias("kept"))
