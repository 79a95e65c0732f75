"""Rings from boundary edges by list ranking: rows stay edges until every ring is numbered.

The edges of a group's boundary (interior on the left) form closed chains. Each edge finds the one that goes on from its end by
a join on the vertex. Then pointers are doubled: after ``k`` rounds an edge knows the least edge number among the ``2 ** k`` edges from
it on, and how many steps away that one is. When nothing changes any more, the least edge of the whole ring is known to all
its edges, so it names the ring, and the steps give the order. A ring of ``n`` edges takes about ``log2 n`` rounds, each a join of
four numbers per edge; no task ever holds a ring, let alone a group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.plans.ids import surrogate_ids
from vigie.plans.materialize import materialize

#: Vertices of one group are one within a quarter of this share of its extent.
VERTEX_UNIT = 1e-8
#: Sine of the turn below which a vertex lies on a straight line.
STRAIGHT = 1e-9
MOST_ROUNDS = 60


def numbered_edges(boundary: DataFrame) -> DataFrame:
    """Edges with ``eid`` in the order of group and coordinates, and ``unit``, the group's vertex unit."""
    c = F.col
    numbered = surrogate_ids(boundary.select("group_id", "x1", "y1", "x2", "y2"), ["group_id", "x1", "y1", "x2", "y2"], "eid", 0)
    span = lambda v: F.max(F.greatest(c(v + "1"), c(v + "2"))) - F.min(F.least(c(v + "1"), c(v + "2")))
    units = boundary.groupBy("group_id").agg((F.greatest(span("x"), span("y"), F.lit(1e-300)) * VERTEX_UNIT).alias("unit"))
    return materialize(numbered.join(units, "group_id"))


def successors(edges: DataFrame) -> DataFrame:
    """(eid, next, bend): the edge that goes on from ``eid``, and whether the boundary turns where they meet.

    Where several edges leave a vertex the sharpest right turn is taken, so rings touch in points but do not cross. An edge goes on
    to one other and is gone on to by one; what is left over (a chain that does not close) has no successor.
    """
    c = F.col
    places = lambda v: F.array_distinct(F.array(*[F.floor((c(v) + s * c("unit")) / c("unit")) for s in (-0.25, 0.25)]))
    ends = edges.select("group_id", "eid", "unit", c("x2").alias("x"), c("y2").alias("y"), (c("x2") - c("x1")).alias("dx"), (c("y2") - c("y1")).alias("dy"))
    ends = ends.withColumn("kx", F.explode(places("x"))).withColumn("ky", F.explode(places("y")))
    starts = edges.select("group_id", c("eid").alias("next"), F.floor(c("x1") / c("unit")).alias("kx"), F.floor(c("y1") / c("unit")).alias("ky"),
                          c("x1").alias("sx"), c("y1").alias("sy"), (c("x2") - c("x1")).alias("ex"), (c("y2") - c("y1")).alias("ey"))
    met = ends.join(starts, ["group_id", "kx", "ky"]).where((F.abs(c("sx") - c("x")) <= c("unit") / 4) & (F.abs(c("sy") - c("y")) <= c("unit") / 4))
    turn = F.pmod(F.atan2("ey", "ex") - F.atan2("dy", "dx") - math.pi, F.lit(2 * math.pi))
    bend = F.abs(c("dx") * c("ey") - c("dy") * c("ex")) > STRAIGHT * F.hypot("dx", "dy") * F.hypot("ex", "ey")
    met = met.select("eid", "next", turn.alias("turn"), bend.alias("bend"))
    onward = met.withColumn("_r", F.row_number().over(Window.partitionBy("eid").orderBy(F.desc("turn"), "next"))).where("_r = 1")
    only = onward.withColumn("_r", F.row_number().over(Window.partitionBy("next").orderBy(F.desc("turn"), "eid"))).where("_r = 1")
    return only.select("eid", "next", "bend")


def ranked(links: DataFrame) -> DataFrame:
    """(eid, ring, steps): the least edge of the ring ``eid`` is on and the steps to it, by pointer doubling over (eid, next).

    Edges of chains that do not close are left out.
    """
    c = F.col
    state = materialize(links.select("eid", c("next").alias("to"), c("eid").alias("ring"), F.lit(0).cast("long").alias("steps")))
    reach = 1
    for _ in range(MOST_ROUNDS):
        far = state.select(c("eid").alias("to"), c("to").alias("_to"), c("ring").alias("_ring"), c("steps").alias("_steps"))
        nearer = c("ring") <= c("_ring")
        state = materialize(state.join(far, "to").select(
            "eid", c("_to").alias("to"), F.least("ring", "_ring").alias("ring"), F.when(nearer, c("steps")).otherwise(c("_steps") + reach).alias("steps"), (~nearer).alias("moved")))
        reach *= 2
        if not state.where("moved").limit(1).count():
            return state.select("eid", "ring", "steps")
    raise RuntimeError("rings did not settle")


def ring_vertices(boundary: DataFrame) -> DataFrame:
    """(group_id, ring, pos, x, y): the turning points of every ring in order.

    ``boundary``: group_id and directed edges x1, y1, x2, y2 (``spatial.dissolve`` output). ``ring`` numbers rings by their least edge;
    ``pos`` counts the ring's edges from there, so straight points leave gaps. Rings of fewer than three turning points have no area
    and are left out.
    """
    c = F.col
    edges = numbered_edges(boundary)
    links = materialize(successors(edges))
    sized = ranked(links.select("eid", "next"))
    sized = sized.join(sized.groupBy("ring").agg(F.count("*").alias("n")), "ring")
    turns = links.where("bend").select(c("next").alias("eid"))
    kept = sized.join(turns, "eid").withColumn("pos", F.pmod(c("n") - c("steps"), c("n"))).select("eid", "ring", "pos")
    enough = kept.groupBy("ring").agg(F.count("*").alias("n")).where("n >= 3").select("ring")
    return kept.join(enough, "ring").join(edges.select("eid", "group_id", c("x1").alias("x"), c("y1").alias("y")), "eid").select("group_id", "ring", "pos", "x", "y")


def as_rings(vertices: DataFrame) -> DataFrame:
    """(group_id, rings) from ``ring_vertices``: the finished geometry is one value, so its turning points become one row."""
    point = F.struct("pos", F.struct("x", "y").alias("p"))
    ring = vertices.groupBy("group_id", "ring").agg(F.array_sort(F.collect_list(point)).alias("v")).select("group_id", "ring", F.col("v.p").alias("points"))
    return ring.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("ring", "points"))).alias("r")).select("group_id", F.col("r.points").alias("rings"))
