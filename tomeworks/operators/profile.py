"""Counts, shares and quality profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .skew import HOT_ROWS, with_previous


def counts(df: DataFrame, column: str, total: bool = False) -> DataFrame:
    """Rows per value; with ``total`` one more row, value null and ``is_total`` true.

    The total is rolled up from the counts, not from the rows.
    """
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    if not total:
        return counted
    everything = counted.agg(F.sum("rows").alias("rows")).select(
        F.lit(None).cast(df.schema[column].dataType).alias(column),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.lit(True).alias("is_total"),
    )
    return counted.withColumn("is_total", F.lit(False)).unionByName(everything)


def basis_points(part: Column, whole: Column) -> Column:
    """Share in ten-thousandths, rounded down; exact, since it stays in whole numbers."""
    return F.call_function("div", part * 10000, whole)


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows in basis points, rounded down."""
    counted = counts(df, column)
    total = counted.agg(F.sum("rows").alias("total")).scalar()
    return counted.withColumn("basis_points", basis_points(F.col("rows"), total))


def coverage(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, non-null rows and their share in basis points; one pass."""
    columns = list(columns or df.columns)
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"present_{i}") for i, c in enumerate(columns)],
    )
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(f"present_{i}").alias("present"))
            for i, c in enumerate(columns)
        ]
    )
    share = basis_points(F.col("present"), F.nullif(F.col("rows"), F.lit(0)))
    return seen.select("rows", F.inline(listed)).select(
        "field", "rows", "present", share.alias("basis_points")
    )


def page_profile(raw: DataFrame, requested: int | None = None) -> DataFrame:
    """Records per landed page and whether it holds as many as were requested."""
    per_page = raw.groupBy("provider", "page").agg(F.count(F.lit(1)).alias("returned"))
    capped = F.lit(None).cast("boolean") if requested is None else F.col("returned") < requested
    return per_page.withColumn("below_requested", capped)


def observed_fields(raw: DataFrame, column: str = "raw") -> DataFrame:
    """The merged shape of all records, as one schema string."""
    return raw.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("shape"))


def out_of_order(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: Column, min_rows: int = HOT_ROWS
) -> DataFrame:
    """How many rows have a smaller value than the row before them: 0 means sorted."""
    seen = with_previous(df, key, order, value, "before", min_rows)
    return seen.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value < F.col("before")).alias("out_of_order")
    )


def scan_counters(df: DataFrame, matched: Column) -> DataFrame:
    """Rows scanned and rows matched, over the whole input."""
    return df.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(matched).alias("matched"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def status_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """New, changed and unchanged records in one pass."""
    status = F.col("status")
    return classified.groupBy(*by).agg(
        *[F.count_if(status == s).alias(f"{s}_records") for s in ("new", "changed", "unchanged")]
    )
