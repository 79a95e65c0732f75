"""op5: language of every document, learned from four folds of five."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm import langid
from vigie.llm.common import crc_mod, documents

NAME = "op5_language_id"


def trained(docs: DataFrame) -> langid.Model:
    return langid.fit(langid.gram_counts(docs.where(crc_mod("doc_id", 5) != 0)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = langid.predict(docs, trained(docs), columns=("doc_id",))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), out["_lang_pred"].alias("lang_pred"), out["_lang_score"].alias("score"))
