"""op4: a verdict on every url of ``pages``.

Labels: a page's id in ``labels``; low quality or toxic is ``block``, the rest ``allow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.urlrules import url_filter
from vigie.sources.tables import read_table

NAME = "op4_url_filter"
#: Fixed values of the contract: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    label = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit("block")).when(F.col("quality") == 1, F.lit("allow"))
    return url_filter(read_table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), label.alias("label")), RULES)
