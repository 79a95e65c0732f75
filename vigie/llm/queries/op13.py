"""op13: the ten best documents for every item of ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm import lexical
from vigie.llm.common import documents
from vigie.sources.tables import read_table

NAME = "op13_lexical_search"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    out = lexical.search(documents(spark, sf_dir).select("doc_id", "text"), items, columns=("item_id",))
    return out.selectExpr("item_id", "_rank as rank", "_doc_id as doc_id", "_score as score")


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
#: Every posting of every item's terms is scored and sorted.
ORACLE = f"""
    with docs as materialized (select row_number() over () as r, doc_id, {_TERMS} as w from documents),
    stats as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from docs),
    items as materialized (select row_number() over () as i, item_id, unnest(list_distinct({_TERMS})) as term from benchmark),
    tf as materialized (select r, term, count(*) as tf from (select r, unnest(w) as term from docs) where term in (select term from items) group by r, term),
    weight as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, stats group by term, n_docs),
    size as (select r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms as m from docs, stats where len(w) > 0),
    scores as (select i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from items join tf using (term) join weight using (term) join size using (r) group by i, item_id, r, doc_id),
    ranked as (select item_id, row_number() over (partition by i order by score desc, doc_id) as rank, doc_id, score from scores where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10"""
