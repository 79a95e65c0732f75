"""op1: language-model scores of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm.common import documents, tokenizer_path
from vigie.llm.lm import lm_scores

NAME = "op1_lm_scoring"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
