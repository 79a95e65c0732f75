"""op2: all documents packed into sequences of at most 4096 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm.common import documents, tokenizer_path
from vigie.llm.packing import best_fit_packing

NAME = "op2_best_fit_packing"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())
