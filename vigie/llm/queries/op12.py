"""op12: quality of every document, learned from three folds of four."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm import classifier
from vigie.llm.common import crc_mod, documents
from vigie.sources.tables import read_table

NAME = "op12_quality_classifier"
LEAST_SCORE = 0.7


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    weights = classifier.fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"), crc_mod("doc_id", 4) != 2)
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    out = classifier.score(docs, weights)
    return out.select("doc_id", held_out, F.col("_score").alias("score"), (F.col("_score") >= LEAST_SCORE).cast("int").alias("predicted"))
