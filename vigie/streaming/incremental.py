"""Append form of S3 and a ``foreachBatch`` driver for it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.operators.spatial import FIRST_RATIO
from vigie.plans import cells as C
from vigie.sources.sinks import overwrite_partitions


def first_detection_increment(new: DataFrame, existing: DataFrame, cell: float, ratio: float = FIRST_RATIO) -> DataFrame:
    """Flag rows of one load run against all rows committed before it (rows of the same run do not see each other).

    ``new``/``existing``: layers (id, rings, bbox, is_rect, area). A new row is first unless an existing row covers more
    than ``ratio`` of its area; a zero-area row stays first.
    """
    covered = C.covered(new, existing, cell, ratio)
    return new.join(covered.withColumn("_cov", F.lit(True)), "id", "left").withColumn(
        "first_detection", ~F.coalesce(F.col("_cov"), F.lit(False))).drop("_cov")


BATCH = "load_batch"


def append_batch(batch: DataFrame, table_path: str, cell: float, batch_id: int) -> None:
    """Flag one batch against the earlier batches in the Parquet table at ``table_path`` and write it there.

    Every batch is one partition, overwritten as a whole: a batch that is replayed after a failure sees the same earlier
    batches and leaves the same rows. Only a missing table counts as "nothing stored yet"; any other error is raised.
    """
    try:
        existing = batch.sparkSession.read.parquet(table_path).where(F.col(BATCH) < batch_id)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        flagged = batch.withColumn("first_detection", F.lit(True))
    else:
        flagged = first_detection_increment(batch, existing.select(*batch.columns), cell)
    overwrite_partitions(flagged.withColumn(BATCH, F.lit(batch_id).cast("long")), table_path, [BATCH])


def start_incremental_load(stream: DataFrame, table_path: str, checkpoint_path: str, cell: float):
    """Run the load as a streaming query: each micro-batch is flagged against the committed table and appended.

    ``checkpoint_path`` must be on the shared storage of the cluster so a restarted query resumes exactly once per batch.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint_path)
        .foreachBatch(lambda df, batch_id: append_batch(df, table_path, cell, batch_id))
        .start()
    )
