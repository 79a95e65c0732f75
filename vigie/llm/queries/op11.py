"""op11: hard negatives for every anchor of ``embeddings`` and each of its positives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.rtree import hard_negatives
from vigie.sources.tables import read_table

NAME = "op11_hard_negatives"
#: Rows whose id this divides are moved to the next label; rows whose id this divides are anchors.
MOVED, ANCHOR = 7, 50


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % ANCHOR == 0)


#: Every anchor against every row.
ORACLE = f"""
    with usable as materialized (select distinct vec_id, case when vec_id % {MOVED} = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
      from embeddings where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
      from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % {ANCHOR} = 0),
    positives as (select anchor_id, vec_id as positive_id, score as positive_score from scored where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
        vec_id as negative_id, positive_score, score as negative_score
      from positives join scored using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
      qualify rank <= 3"""
