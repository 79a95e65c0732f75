"""Readers for the workload's file inputs (exported sheets, GeoJSON features, decoded layer folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sheet_export(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A spreadsheet exported to CSV (header row). Excel decoding itself is not re-implemented."""
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema else r.option("inferSchema", False)).csv(path)


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON FeatureCollection files (multi-line JSON) as rows: id, properties, geometry."""
    fc = spark.read.option("multiLine", True).json(path)
    return fc.select(F.inline("features"))


def read_layer_folder(spark: SparkSession, path: str) -> DataFrame:
    """A folder of decoded layers (Parquet with srid + rings), tagged with the source file name."""
    return spark.read.parquet(path).withColumn("file", F.input_file_name())
