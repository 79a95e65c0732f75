"""op8: ids and decoded text of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm.common import documents, tokenizer_path
from vigie.llm.lexicon import encode_decode

NAME = "op8_bpe_lexicon"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path(), columns=("doc_id",), digests=True)
    return out.selectExpr("doc_id", "_n_tokens as n_tokens", "_ids_sha256 as ids_sha256", "_decoded_sha256 as decoded_sha256")
