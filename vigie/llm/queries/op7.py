"""op7: line dedup over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import documents
from vigie.llm.lines import MIN_CHARS, line_dedup

NAME = "op7_line_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def oracle(table: str = "documents") -> str:
    """CTEs up to ``kept``: (doc_id, n_lines, n_dropped, text)."""
    return f"""
    split as materialized (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from {table}),
    keyed as materialized (select *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from split),
    owners as (select key, min(doc_id) as owner from keyed where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) > 1),
    flagged as (select k.*, coalesce(doc_id <> owner, false) as gone from keyed k left join owners using (key)),
    kept as (select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
        coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text from flagged group by doc_id)"""


ORACLE = f"with {oracle()} select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256 from kept"
