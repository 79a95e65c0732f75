"""Corpus pipeline: quality rules, language ID, line dedup, near-copy removal, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns a DataFrame, which is
written as Parquet and read again for the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigie.llm import jaccard, langid, lines, packing, quality  # noqa: E402
from vigie.llm.common import documents, shielded, stored, tokenizer_path  # noqa: E402

#: Code length in bits a byte from which a text is no text of any learned language: a plain copy takes 8.
MOST_BITS = 8.0


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rule and their group's adaptive thresholds (operator 10)."""
    rows, names = shielded(docs, ("text", "lang", "source"))
    return quality.quality_rules(rows).where("_q_kept").select(*names).toDF(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known (operator 5): not ``und``, and the best code is shorter than a plain copy.

    The trees learn from the labelled rows of this stage's own input. Input without any label has no known language to
    compare with, so it passes whole.
    """
    model = langid.fit(langid.gram_counts(docs))
    if not model.langs:
        return docs
    rows, names = shielded(docs, ("text",))
    out = langid.predict(rows, model, columns=tuple(names))
    return out.where((F.col("_lang_pred") != "und") & (F.col("_lang_bits") < MOST_BITS)).select(*names).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, rid of lines an earlier document owns (operator 7); ``n_chars`` follows the new text."""
    rows, names = shielded(docs, ("doc_id", "text", "n_chars"))
    out = lines.line_dedup(rows)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*names).toDF(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (operator 6). Null ids stay."""
    found = stored(jaccard.jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, placed in sequences (operator 2)."""
    return packing.best_fit_packing(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_copy_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot run the tokenizer; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
