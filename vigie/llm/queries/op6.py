"""op6: near copies among ``documents`` by exact shingle similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm.common import documents
from vigie.llm.jaccard import jaccard_components

NAME = "op6_jaccard_join"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))
