"""Readers for the driver's Parquet tables.

Every table is read lazily with ``spark.read.parquet`` so Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def view_prefix(sf_dir: str) -> str:
    return "vg_" + hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10] + "_"


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> str:
    """Register the driver tables as temp views under an sf-specific prefix; returns the prefix."""
    prefix = view_prefix(sf_dir)
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
    return prefix
