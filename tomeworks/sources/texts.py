"""Landed full texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import read_or_empty

TEXTS = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, TEXTS)
