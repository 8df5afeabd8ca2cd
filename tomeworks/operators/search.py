"""Merging sources, searching them and counting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import search_blob
from .normalize import record_uid


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources in one table with a ``uid``; columns a source lacks are null.

    A column that sources type differently (a number here, a text there) becomes text:
    Spark would otherwise try to read the texts as numbers.
    """
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = [name for name, seen in kinds.items() if len(seen) > 1 or name == "id"]
    alike = [
        f.withColumns({c: F.col(c).cast("string") for c in mixed if c in f.columns}) for f in frames
    ]
    merged = alike[0]
    for frame in alike[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.withColumn("uid", record_uid(F.col("source"), F.col("id")))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Doubles that are NaN become null, as in every other missing value."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


SEARCHED = ("title", "authors", "subjects", "publisher")


def search(
    df: DataFrame, query: str, source: str = "all", columns: Sequence[str] = SEARCHED
) -> DataFrame:
    """Rows whose searched columns contain the query, whatever its case.  An empty query
    matches everything."""
    blob = search_blob(*[F.col(c) for c in columns])
    found = df.where(F.contains(blob, F.lit(query.lower())))
    return found if source == "all" else found.where(F.col("source") == source)


def lookup(df: DataFrame, uid: str, column: str = "uid") -> DataFrame:
    return df.where(F.col(column) == uid)


def join_vectors(
    catalog: DataFrame, vectors: DataFrame, key: str = "book_uid"
) -> DataFrame:
    """Catalog rows with their vector, which is kept in a table of its own."""
    return catalog.join(vectors, key)
