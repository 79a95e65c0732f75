"""Consecutive surrogate ids over a total order without funnelling rows through one task.

``row_number().over(Window.orderBy(...))`` moves every row to a single partition. Instead: range-partition on the
order, number rows inside each partition, and add the running count of the preceding partitions (one tiny
aggregate of one row per partition, broadcast back). The ranged rows are materialized with their partition number
first: range bounds are sampled, so two evaluations of the same plan can cut at different places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.plans.materialize import materialize


def surrogate_ids(df: DataFrame, order_cols: list, name: str = "id", offset: int = 1, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = offset + 0-based position of the row in ``order_cols`` order (which must be total)."""
    n = partitions
    if n is None:
        try:
            n = df.sparkSession.sparkContext.defaultParallelism
        except Exception:  # Spark Connect: no SparkContext
            n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_start"),
    )
    return (
        local.join(F.broadcast(starts), "_pid")
        .withColumn(name, (F.coalesce(F.col("_start"), F.lit(0)) + F.col("_rn") - 1 + F.lit(offset)).cast("long"))
        .drop("_pid", "_rn", "_start")
    )
