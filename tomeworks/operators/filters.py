"""Row predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed


def filter_public_domain(
    df: DataFrame, codes: Sequence[str] | None = fixed.PUBLIC_DOMAIN_CODES, column: str = "rights"
) -> DataFrame:
    """Rows whose rights code is in the public domain; ``codes=None`` keeps all."""
    return df if codes is None else df.where(F.col(column).isin(*codes))


def missing_text(df: DataFrame, column: str = "searchable_text") -> DataFrame:
    return df.where(F.coalesce(F.col(column), F.lit("")) == "")


def exclude_withdrawn(df: DataFrame) -> DataFrame:
    return df.where(F.col("withdrawn_reason").isNull())


def text_quality(df: DataFrame, column: str = "text_source") -> DataFrame:
    """``text_rank``: 0 for the best origin of text, counting up; last for none."""
    rank = F.lit(len(fixed.TEXT_ORIGINS) - 1)
    for place, origin in reversed(list(enumerate(fixed.TEXT_ORIGINS))):
        rank = F.when(F.col(column) == origin, F.lit(place)).otherwise(rank)
    return df.withColumn("text_rank", rank)


def only_sources(df: DataFrame, enabled: Sequence[str], column: str = "source") -> DataFrame:
    return df.where(F.col(column).isin(*enabled))
