"""Catalog shards and per-source flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import STORED
from ..session import read_or_empty


def read_shards(spark: SparkSession, base: str, provider: str | None = None) -> DataFrame:
    """Every stored version of every record, with the partition columns.

    A provider reads only its own partitions.
    """
    shards = read_or_empty(spark, f"{base}/catalog", STORED)
    return shards if provider is None else shards.where(F.col("provider") == provider)


def read_flat_sources(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Flat per-source tables ``books_<source>.parquet``.  Where a table has no source
    column, or a null in it, the source is taken from the name of the file."""
    frames = []
    for path in sorted(paths):
        df = spark.read.parquet(path)
        named = F.regexp_extract(F.lit(path.rstrip("/")), r"books_([^/]+)\.parquet$", 1)
        source = F.coalesce(F.col("source"), named) if "source" in df.columns else named
        frames.append(df.withColumn("source", source))
    return frames
