"""Follow-ups of the case histories: how long transitions take, which steps lead nowhere, which cases are not finished.

Durations are kept as counts of whole days for each transition. Such counts are added up when logs are merged, and every quantile is
read off them exactly, so no list of durations is ever gathered. What can be reached in the step graph is its closure by semi-naive
joins: a round joins only the pairs found in the round before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.plans.materialize import materialize

QUANTILES = (0.5, 0.9)
LINK = ["source_step", "target_step"]


def duration_counts(flow: DataFrame) -> DataFrame:
    """(source_step, target_step, days, n) of W1's transitions whose steps are both known; days are whole days between the actions."""
    known = flow.where("source_step is not null and target_step is not null and action_date is not null and next_action_date is not null")
    micros = lambda x: F.unix_micros(F.col(x).cast("timestamp"))
    days = F.floor((micros("next_action_date") - micros("action_date")) / 86_400_000_000)
    return known.groupBy(*LINK, days.cast("long").alias("days")).agg(F.count(F.lit(1)).alias("n"))


def merged_counts(*counts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, counts).groupBy(*LINK, "days").agg(F.sum("n").alias("n"))


def durations(counts: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """Per transition: its number, mean, least and largest days, and ``p50`` …: the least days within which that share was done.

    ``counts``: ``duration_counts``; a window holds one row for each number of days, never one for each case.
    """
    c = F.col
    w = Window.partitionBy(*LINK)
    upto = counts.withColumn("_upto", F.sum("n").over(w.orderBy("days"))).withColumn("_all", F.sum("n").over(w))
    picks = [F.min(F.when(c("_upto") >= c("_all") * q, c("days"))).alias(f"p{round(q * 100)}_days") for q in quantiles]
    mean = (F.sum(c("days") * c("n")) / F.sum("n")).alias("mean_days")
    return upto.groupBy(*LINK).agg(F.sum("n").alias("nb_transitions"), mean, F.min("days").alias("min_days"), F.max("days").alias("max_days"), *picks)


def reachable(edges: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """(from_step, to_step) for every step that can be reached from another by one or more of ``edges(from_step, to_step)``."""
    edges = materialize(edges.where("from_step is not null and to_step is not null").select("from_step", "to_step").distinct())
    known, fresh = edges, edges
    for _ in range(most_rounds):
        onward = fresh.select("from_step", F.col("to_step").alias("_via")).join(edges.select(F.col("from_step").alias("_via"), "to_step"), "_via")
        fresh = materialize(onward.select("from_step", "to_step").distinct().join(known, ["from_step", "to_step"], "left_anti"))
        if not fresh.limit(1).count():
            return known
        known = materialize(known.unionByName(fresh))
    raise RuntimeError("the closure did not settle")


def step_ends(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """(step_code, is_end, can_end): steps nothing goes on from, and whether such an end can be reached (an end reaches itself).

    A step that is no end and reaches none is a dead end: its cases circle for ever.
    """
    ends = steps.select("step_code").join(edges.select(F.col("from_step").alias("step_code")).distinct(), "step_code", "left_anti").withColumn("is_end", F.lit(True))
    leading = reachable(edges).join(ends.select(F.col("step_code").alias("to_step")), "to_step", "left_semi").select(F.col("from_step").alias("step_code")).distinct()
    out = steps.select("step_code").join(ends, "step_code", "left").join(leading.withColumn("_leads", F.lit(True)), "step_code", "left")
    is_end = F.coalesce("is_end", F.lit(False))
    return out.select("step_code", is_end.alias("is_end"), (is_end | F.coalesce("_leads", F.lit(False))).alias("can_end"))


def unfinished_cases(log: DataFrame, steps: DataFrame, edges: DataFrame, key, order_col: str = "id") -> DataFrame:
    """Per step that is some case's last known one: (step_code, is_end, can_end, nb_cases).

    ``key``: the comparison key of labels (``workflow.label_key``). A case whose last action is no known step counts under a NULL step.
    """
    last = log.groupBy("dossier_id").agg(F.max_by("action_type", order_col).alias("action_type"))
    named = steps.select(key(F.col("step_label")).alias("_k"), "step_code")
    at = last.join(named, key(F.col("action_type")) == F.col("_k"), "left").groupBy("step_code").agg(F.count(F.lit(1)).alias("nb_cases"))
    return at.join(step_ends(steps, edges), "step_code", "left").select("step_code", "is_end", "can_end", "nb_cases")
