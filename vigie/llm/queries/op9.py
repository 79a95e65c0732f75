"""op9: near-duplicate vectors of ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm.neargraph import near_duplicates
from vigie.sources.tables import read_table

NAME = "op9_embedding_graph"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
