"""Sinks: append, overwrite, replace-by-key, GeoJSON lines. Writers take a DataFrame and a path or table name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Idempotent load: replace only the partitions present in ``df`` (e.g. one (zone, batch) run)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def replace_by_key(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``current`` whose key is not in ``new``, plus ``new`` (DELETE where key, then INSERT)."""
    return current.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def geojson_lines(features: DataFrame, path: str, column: str = "geojson") -> None:
    """One GeoJSON Feature per line (a FeatureCollection as newline-delimited features, written in parallel)."""
    features.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
