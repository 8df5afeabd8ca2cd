"""Volumes, works, and dropping what is already known.

Rows of the bulk source are volumes; one work may have many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .linking import linked
from .skew import HOT_ROWS, salted_join


def normal_form(text: Column) -> Column:
    """Lower case, runs of white space as one blank, no blanks at the ends."""
    single = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " ")
    return F.lower(F.btrim(single))


def catalog_numbers(oclc: Column) -> Column:
    """The numbers of a comma-separated list, without blanks; null for null."""
    return F.filter(F.transform(F.split(oclc, ","), lambda n: F.btrim(n)), lambda n: n != "")


def work_key(oclc: Column, title: Column, author: Column, own: Column | None = None) -> Column:
    """The shared catalog number where there is one (the least of a list of them), else a
    hash of title and author.  A row without any of them has the key ``own``."""
    numbers = catalog_numbers(oclc)
    title, author = normal_form(title), normal_form(author)
    named = F.md5(F.concat_ws("\x1f", title, author))
    if own is not None:
        named = F.when((title == "") & (author == ""), own).otherwise(named)
    return F.coalesce(F.array_min(numbers), named)


def with_work_key(volumes: DataFrame, id_column: str = "htid") -> DataFrame:
    """``volumes`` with their keys; a volume that nothing describes is a work of its own."""
    own = F.concat(F.lit("volume:"), F.col(id_column).cast("string"))
    return volumes.withColumn(
        "work_key", work_key(F.col("oclc_num"), F.col("title"), F.col("author"), own)
    )


def work_identifiers(oclc: Column, title: Column, author: Column) -> Column:
    """All that names the work of a volume: every catalog number, and title with author."""
    numbers = F.array_distinct(catalog_numbers(oclc))
    title, author = normal_form(title), normal_form(author)
    named = F.concat(F.lit("t:"), F.md5(F.concat_ws("\x1f", title, author)))
    named = F.when((title != "") | (author != ""), F.array(named)).otherwise(F.array().cast("array<string>"))
    numbered = F.transform(numbers, lambda n: F.concat(F.lit("n:"), n))
    return F.concat(F.coalesce(numbered, F.array().cast("array<string>")), named)


def with_work(volumes: DataFrame, id_column: str = "htid", min_rows: int = HOT_ROWS) -> DataFrame:
    """``volumes`` with ``work_id``, the least volume id of their work.

    Volumes are of one work if they share any catalog number or title and author, or if
    a chain of volumes that do leads from one to the other.  A volume that shares nothing is
    a work of its own; one without an id has no work.
    """
    names = work_identifiers(F.col("oclc_num"), F.col("title"), F.col("author"))
    pairs = volumes.select(F.col(id_column).alias("node"), F.explode(names).alias("link"))
    roots = linked(pairs, min_rows=min_rows).select(F.col("node").alias(id_column), F.col("root").alias("work_id"))
    return volumes.join(roots, id_column, "left").withColumn("work_id", F.coalesce("work_id", id_column))


def collapse_works(df: DataFrame, id_column: str = "htid", key: str = "work_key") -> DataFrame:
    """One row per work: number of volumes and the smallest volume id.

    Members are not collected: a work may hold any share of all rows.  They are the rows
    of ``df`` itself, grouped by ``work_key``.
    """
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("volumes"), F.min(id_column).alias("first_id")
    )


def drop_known(
    candidates: DataFrame,
    known: DataFrame,
    key: str = "work_key",
    spread_by: Sequence[str] = ("htid",),
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Candidates whose key the known catalog does not have."""
    keys = known.select(key).distinct()
    return salted_join(candidates, keys, [key], "left_anti", spread_by, min_rows)
