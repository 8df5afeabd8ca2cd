"""Change detection between runs, and the page-aligned cap on one run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .skew import HOT_ROWS, salted_join, with_previous

# Pages per block of the two-level running sum: one task sees a block of pages or the
# list of blocks, never the list of all pages.
PAGES_PER_BLOCK = 65_536


def classify_changes(
    incoming: DataFrame,
    previous: DataFrame,
    key: Sequence[str] = ("provider", "source_id"),
    hash_column: str = "content_hash",
    spread_by: Sequence[str] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``status``: new, changed or unchanged against the previous hash of the key.

    ``previous`` has one row per key.  Only its key and hash are read.  Where one key may
    repeat without bound in ``incoming``, name columns to spread its rows by.
    """
    key = list(key)
    known = previous.select(*key, F.col(hash_column).alias("known_hash"))
    status = (
        F.when(F.col("known_hash").isNull(), "new")
        .when(F.col("known_hash") == F.col(hash_column), "unchanged")
        .otherwise("changed")
    )
    if spread_by:
        joined = salted_join(incoming, known, key, "left", spread_by, min_rows)
    else:
        joined = incoming.join(known, key, "left")
    return joined.withColumn("status", status).drop("known_hash")


def change_sequence(
    versions: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    hash_column: str = "content_hash",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``status`` to every version of every key, comparing it with the one before."""
    seen = with_previous(versions, key, order, F.struct(F.col(hash_column)), "before", min_rows)
    status = (
        F.when(F.col("before").isNull(), "new")
        .when(F.col(f"before.{hash_column}").eqNullSafe(F.col(hash_column)), "unchanged")
        .otherwise("changed")
    )
    return seen.withColumn("status", status).drop("before")


def cap_pages(
    rows: DataFrame,
    max_rows: int,
    kept: str = "kept",
    resumed_page: int | None = None,
    match_resume_overshoot: bool = False,
    pages_per_block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """Per provider, the page on which the running number of kept rows reaches ``max_rows``.

    Providers that stay below the cap have no row.  With ``match_resume_overshoot`` a cap
    reached on the page the run resumed on lets one more page through, as a reader does
    that checks the cap only after moving past its checkpoint.
    """
    per_page = rows.groupBy("provider", "page").agg(F.count_if(F.col(kept)).alias("n"))
    per_page = per_page.withColumn("block", F.floor(F.col("page") / pages_per_block))
    blocks = per_page.groupBy("provider", "block").agg(F.sum("n").alias("block_n"))
    upto_block = Window.partitionBy("provider").orderBy("block")
    reached = (
        blocks.withColumn("reach", F.sum("block_n").over(upto_block))
        .where(F.col("reach") >= max_rows)
        .groupBy("provider")
        .agg(F.min_by(F.struct("block", "reach", "block_n"), "block").alias("b"))
        .select("provider", F.col("b.block").alias("block"),
                (F.col("b.reach") - F.col("b.block_n")).alias("before"))
    )
    # One row per provider, and providers are entries of the registry.
    inside = per_page.join(F.broadcast(reached), ["provider", "block"])
    upto_page = Window.partitionBy("provider").orderBy("page")
    cut = (
        inside.withColumn("reach", F.col("before") + F.sum("n").over(upto_page))
        .where(F.col("reach") >= max_rows)
        .groupBy("provider")
        .agg(F.min("page").alias("cut_page"))
    )
    if match_resume_overshoot and resumed_page is not None and resumed_page >= 1:
        page = F.col("cut_page")
        cut = cut.withColumn("cut_page", F.when(page == resumed_page, page + 1).otherwise(page))
    return cut


def page_cap(rows: DataFrame, max_rows: int | None, **options) -> DataFrame:
    """Rows of whole pages up to the one that reaches the cap; all rows without a cap."""
    if max_rows is None:
        return rows
    cut = F.broadcast(cap_pages(rows, max_rows, **options))
    below = F.col("cut_page").isNull() | (F.col("page") <= F.col("cut_page"))
    return rows.join(cut, ["provider"], "left").where(below).drop("cut_page")
