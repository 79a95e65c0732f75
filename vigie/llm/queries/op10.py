"""op10: adaptive quality rules over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm import quality
from vigie.llm.common import documents

NAME = "op10_quality_rules"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    measured = quality.stored(quality.measures(docs).drop("text"), "quality")
    cuts = quality.stored(quality.thresholds(quality.sketches(measured)), "cuts")
    out = quality.judged(measured, cuts)
    return out.selectExpr("doc_id", *[f"_q_{c} as {c}" for c in COUNTS], "_q_base_failed as base_failed", "_q_kept as kept")


def oracle(table: str = "documents", key: str = "doc_id") -> str:
    """CTEs up to ``judged``: every row of ``table`` with its counts and verdict. ``key`` is unique in the table."""
    cut = ", ".join(f"max(cut) filter (where measure = '{k}') as {k}" for k in quality.MARGINS)
    margin = " ".join(f"when '{k}' then {v}" for k, v in quality.MARGINS.items())
    pick = ", ".join(
        f"case when o.total >= {quality.MIN_GROUP} then o.{k} when l.total >= {quality.MIN_GROUP} then l.{k} else g.{k} end as {k}" for k in quality.MARGINS
    )
    unpivot = " union all ".join(f"select lang, source, '{k}' as measure, {k} as v from rates" for k in quality.MARGINS)
    good = " and ".join(f"r.{k} <= c.{k}" for k in quality.MARGINS)
    return f"""
    toks as materialized (
      select *, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls
      from {table}),
    wins as (select {key} as k, unnest(range(1, len(w) - 1)) as i, w from toks where len(w) >= 4),
    tri as materialized (select k, i, w[i:i + 2] as t from wins),
    rep as (select k, unnest([i, i + 1, i + 2]) as p from (select k, i, count(*) over (partition by k, t) as c from tri) where c > 1),
    reps as (select k, count(distinct p) as n from rep group by k),
    base as materialized (
      select t.*, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
        len(array_to_string(w, '')) - len(regexp_replace(array_to_string(w, ''), '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(array_to_string(w, '')) - len(regexp_replace(array_to_string(w, ''), '\\p{{Lu}}', '', 'g')) as n_upper,
        len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
      from toks t left join reps on reps.k = t.{key}),
    rates as materialized (
      select *, coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) as symbol_rate, coalesce(n_upper * 1000 // nullif(word_chars, 0), 0) as upper_rate,
        coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) as dup_line_rate, coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0) as repeat_rate
      from base),
    vals as ({unpivot}),
    hist as (select lang, source, measure, (v >> greatest(len(bin(v)) - 6, 0)) << greatest(len(bin(v)) - 6, 0) as bucket, count(*) as n from vals group by all),
    lev as (select 0 as level, lang, source, measure, bucket, n from hist
      union all select 1, lang, null, measure, bucket, sum(n) from hist group by lang, measure, bucket
      union all select 2, null, null, measure, bucket, sum(n) from hist group by measure, bucket),
    cum as (select *, sum(n) over (partition by level, lang, source, measure order by bucket) as seen, sum(n) over (partition by level, lang, source, measure) as total from lev),
    qs as (select level, lang, source, measure, max(total) as total, min(bucket) filter (where seen * 4 >= total) as q1, min(bucket) filter (where seen * 4 >= total * 3) as q3
      from cum group by level, lang, source, measure),
    cuts0 as (select *, q3 + {quality.FENCE} * greatest(q3 - q1, case measure {margin} end) as cut from qs),
    wide as (select level, lang, source, max(total) as total, {cut} from cuts0 group by level, lang, source),
    cuts as (select o.lang, o.source, {pick} from (select * from wide where level = 0) o
      left join (select * from wide where level = 1) l on o.lang is not distinct from l.lang
      left join (select * from wide where level = 2) g on true),
    judged as materialized (
      select r.*, (n_words < {quality.BASE_MIN_WORDS} or 100 * n_repeat_words > 50 * n_words) as base_failed,
        not (n_words < {quality.BASE_MIN_WORDS} or 100 * n_repeat_words > 50 * n_words) and ({good}) as kept
      from rates r left join cuts c on r.lang is not distinct from c.lang and r.source is not distinct from c.source)"""


ORACLE = f"with {oracle()} select doc_id, {', '.join(f'{c}::bigint as {c}' for c in COUNTS)}, base_failed, kept from judged"
