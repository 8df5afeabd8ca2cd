"""Budgeted text enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed, session
from ..functions import after_front_matter, first_chars, preview
from .skew import top_rows


def select_budget(
    targets: DataFrame,
    k: int | None,
    priority: str = "download_count",
    ties: Sequence[Column | str] = (),
    partition: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` targets with the highest priority, null counting as zero; ties in the
    order of ``ties``.  ``k=None`` takes all.  Pass narrow rows."""
    if k is None:
        return targets
    ranked = [F.coalesce(F.col(priority), F.lit(0)).desc()]
    ranked += [F.col(t).asc() if isinstance(t, str) else t for t in ties]
    return top_rows(targets, k, ranked, partition)


def fetch_previews(
    chosen: DataFrame,
    texts: DataFrame,
    chars: int = fixed.PREVIEW_CHARS,
    key: Sequence[str] = ("provider", "source_id"),
    at_most: int | None = None,
) -> DataFrame:
    """(key, preview) for the chosen keys that have a text.

    The texts are by far the larger side.  When the caller knows that at most ``at_most``
    keys were chosen and that is small, the keys are broadcast and the texts stay where
    they are.  Otherwise each text is cut to its preview before anything is shuffled.
    A text landed twice counts once.
    """
    key = list(key)
    keys = chosen.select(*key)
    made = preview(F.col("text"), chars).alias("preview")
    if at_most is not None and at_most <= session.BROADCAST_ROWS:
        found = texts.join(F.broadcast(keys), key, "left_semi").select(*key, made)
    else:
        found = texts.select(*key, made).join(keys, key, "left_semi")
    # The null test comes last: before the aggregate it would be pushed into the scan and
    # make every preview twice.
    one = found.groupBy(*key).agg(F.max("preview").alias("preview"))
    return one.where(F.col("preview").isNotNull())


def attach_text(
    targets: DataFrame, previews: DataFrame, key: Sequence[str] = ("provider", "source_id")
) -> DataFrame:
    """Targets with the preview filled in; a target without one stays as it was."""
    got = F.col("preview").isNotNull()
    joined = targets.join(previews, list(key), "left")
    return (
        joined.withColumn("text_source", F.when(got, "first_chars").otherwise(F.col("text_source")))
        .withColumn(
            "text_char_count",
            F.when(got, F.length("preview")).otherwise(F.col("text_char_count")),
        )
        .withColumn("searchable_text", F.coalesce("preview", "searchable_text"))
        .drop("preview")
    )


def pending(
    catalog: DataFrame, with_text: DataFrame, key: Sequence[str] = ("source_id",)
) -> DataFrame:
    """Catalog rows that no row of ``with_text`` covers yet."""
    return catalog.join(with_text.select(*key), list(key), "left_anti")


def display_text(df: DataFrame, chars: int = fixed.DISPLAY_CHARS, column: str = "text") -> DataFrame:
    """A text as a reader shows it: behind the front matter, cut to ``chars``, with its
    ``total`` and ``shown`` length.  White space is dropped only where a marker was."""
    body = after_front_matter(F.col(column))
    # Taking a marker off always shortens a text.
    body = F.when(body == F.col(column), body).otherwise(
        F.ltrim(body, F.lit(fixed.WHITE_SPACE))
    )
    cut = df.withColumn("body", body).withColumn("total", F.length("body"))
    return (
        cut.withColumn("shown", F.least("total", F.lit(chars)))
        .withColumn(column, first_chars(F.col("body"), chars))
        .drop("body")
    )
