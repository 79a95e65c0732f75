"""op3: license labels of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm import licenses
from vigie.llm.common import documents

NAME = "op3_license_scan"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.license_scan(documents(spark, sf_dir).select("doc_id", "text"))
    found = F.transform("_blocks", lambda b: b["label"])
    best = F.coalesce(F.array_max(F.transform("_blocks", lambda b: b["share"])), F.lit(0.0))
    return out.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_base").alias("n_base"),
        F.col("_first_word").alias("first_word"),
        F.col("_last_word").alias("last_word"),
        F.array_join("_base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_base_labels", found))), ",").alias("labels"),
        F.when(F.col("_n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def _oracle() -> str:
    """The same by plain SQL: phrases by place, templates by counting tokens of every block of lines."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = " union all ".join(
        f"select doc_id, i - 1 as pos, '{label}' as label from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from toks where list_contains(w, '{p.split()[0]}')) "
        f"where array_to_string(w[i:i + {len(p.split()) - 1}], ' ') = '{p}'"
        for p, label in sorted(licenses.PHRASES.items())
    )
    after = ", ".join(f"coalesce(lead(w, {k}) over run, [])" for k in range(1, licenses.BLOCK_LINES))
    tokens = ", ".join(f"('{label}', '{s}')" for label, s in sorted(licenses.TEMPLATES.items()))
    return f"""
    with toks as materialized (select doc_id, regexp_extract_all({lower.format("coalesce(text, '')")}, '{word}') as w from documents),
    base as materialized ({phrases}),
    spots as (select doc_id, count(*) as n, min(pos) as first, max(pos) as last, array_to_string(list_sort(list(distinct label)), ',') as labels from base group by doc_id),
    texts as (select row_number() over () as r, doc_id, {lower.format("coalesce(text, '')")} as t from documents),
    lines as (select r, doc_id, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as i from texts),
    tokens as (select r, doc_id, i, regexp_extract_all(line, '{word}') as w from lines),
    held as materialized (select distinct doc_id, w from (select doc_id, list_distinct(flatten([w, {after}])) as w
      from tokens window run as (partition by r order by i))),
    temp as (select label, list_distinct(string_split(s, ' ')) as t from (values {tokens}) v(label, s)),
    hits as (select doc_id, label, len(list_intersect(w, t))::double / len(t) as share from held, temp
      where len(list_intersect(w, t)) * 1000 >= {int(licenses.CONTAINMENT * 1000)} * len(t)),
    best as (select doc_id, max(share) as share from hits group by doc_id),
    every as (select doc_id, array_to_string(list_sort(list(distinct label)), ',') as labels
      from (select doc_id, label from base union all select doc_id, label from hits) group by doc_id)
    select toks.doc_id, len(w) as n_words, coalesce(n, 0) as n_base, first as first_word, last as last_word, coalesce(spots.labels, '') as base_labels,
      coalesce(every.labels, '') as labels, case when n > 0 then 1.0 else coalesce(share, 0.0) end::double as score
    from toks left join spots using (doc_id) left join best using (doc_id) left join every using (doc_id)"""


ORACLE = _oracle()
