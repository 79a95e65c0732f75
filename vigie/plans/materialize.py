"""Materialization points.

Operators whose output is read more than once downstream (zone pieces, the loaded-detection table) cut their lineage
with a reliable ``checkpoint`` into the shared folder the cluster names in ``spark.checkpoint.dir`` (a scratch folder
is set only when the session has none, as in tests). A lost executor then re-reads the checkpoint instead of
replaying the spatial joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigie.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
