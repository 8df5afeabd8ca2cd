"""Profiles of the stored catalog that add up, kept beside its shards.

Every run's partition is profiled once: rows, how many rows have each column, counts of values with few
kinds, and sketches of the ids and of the downloads.  Profiles of all runs merge into that of
the whole catalog, so its coverage, shares, distinct ids and quantiles are read without a
shard.  Counts are exact; the sketches' errors are those their sizes give (about 1.6 % for
distinct ids at the default of 2^12 registers, 1.3 % of rank for quantiles at k = 200).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import PARTITION_COLUMNS, RECORD
from ..session import read_or_empty
from ..sources import read_shards
from .profile import basis_points

# Columns whose values are few enough to be counted one by one.
COUNTED = ("license", "media_type", "text_source", "is_public_domain", "language")
_COLUMNS = tuple(f.name for f in RECORD.fields)
_ROWS = (
    "rows long, present array<struct<field:string,present:long>>, ids binary, downloads binary, "
    "provider string, ingest_date date, run_seq long"
)
_VALUES = "field string, value string, rows long, provider string, ingest_date date, run_seq long"


def _todo(spark: SparkSession, base: str) -> DataFrame:
    """Partitions of the manifest that no profile covers: a row for each run and provider."""
    files = read_or_empty(spark, f"{base}/_manifest", "provider string, ingest_date date, run_seq long, rows long")
    done = read_or_empty(spark, f"{base}/_profiles/rows", _ROWS).select(*PARTITION_COLUMNS)
    return files.select(*PARTITION_COLUMNS).distinct().join(done, list(PARTITION_COLUMNS), "left_anti")


def update_profiles(spark: SparkSession, base: str) -> int:
    """Profile the runs that have none yet; only their partitions are read.  Returns how many."""
    todo = _todo(spark, base).orderBy(*PARTITION_COLUMNS).collect()  # as many as there were runs
    if not todo:
        return 0
    wanted = F.lit(False)
    for r in todo:
        wanted = wanted | (
            (F.col("provider") == r.provider) & (F.col("ingest_date") == F.lit(r.ingest_date)) & (F.col("run_seq") == r.run_seq)
        )
    shards = read_shards(spark, base).where(wanted)
    _write(_rows(shards), f"{base}/_profiles/rows")
    _write(_values(shards), f"{base}/_profiles/values")
    return len(todo)


def _write(df: DataFrame, path: str) -> None:
    """A run that is profiled again replaces its own partition."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS).parquet(path)
    )


def _filled(column: str):
    """Present as a consumer sees it: lists, maps and texts that are empty are not."""
    kind = RECORD[column].dataType.typeName()
    if kind in ("array", "map"):
        return F.when(F.size(column) > 0, True)
    return F.when(F.col(column) != "", True) if kind == "string" else F.col(column)


def _rows(shards: DataFrame) -> DataFrame:
    counted = shards.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(_filled(c)).alias(f"n_{i}") for i, c in enumerate(_COLUMNS)],
        F.hll_sketch_agg("book_uid").alias("ids"),
        F.kll_sketch_agg_bigint(F.coalesce("download_count", F.lit(0))).alias("downloads"),
    )
    present = F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"n_{i}").alias("present")) for i, c in enumerate(_COLUMNS)
    ])
    return counted.select("rows", present.alias("present"), "ids", "downloads", *PARTITION_COLUMNS)


def _values(shards: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in COUNTED])
    return shards.select(F.inline(pairs), *PARTITION_COLUMNS).groupBy("field", "value", *PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("rows")
    ).select("field", "value", "rows", *PARTITION_COLUMNS)


def read_profiles(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The profiles of rows and of values, one part for each run and provider."""
    return read_or_empty(spark, f"{base}/_profiles/rows", _ROWS), read_or_empty(spark, f"{base}/_profiles/values", _VALUES)


def profiled_coverage(rows: DataFrame) -> DataFrame:
    """``field, rows, present, basis_points`` over all profiled parts."""
    total = rows.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    fields = rows.select(F.inline("present")).groupBy("field").agg(F.sum("present").alias("present"))
    share = basis_points(F.col("present"), F.nullif(F.col("rows"), F.lit(0)))
    return fields.withColumn("rows", total).select("field", "rows", "present", share.alias("basis_points"))


def profiled_shares(values: DataFrame, field: str) -> DataFrame:
    """``value, rows, basis_points`` of one of the COUNTED columns."""
    own = values.where(F.col("field") == field)
    total = own.agg(F.sum("rows")).scalar()
    counted = own.groupBy("value").agg(F.sum("rows").alias("rows"))
    return counted.withColumn("basis_points", basis_points(F.col("rows"), total))


def profiled_totals(rows: DataFrame, ranks: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """One row: ``rows``, about how many ``distinct_ids``, and about the ``downloads`` at ``ranks``."""
    merged = rows.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.hll_union_agg("ids").alias("ids"),
        F.kll_merge_agg_bigint("downloads").alias("downloads"),
    )
    at = [F.kll_sketch_get_quantile_bigint("downloads", F.lit(float(r))) for r in ranks]
    some = F.col("rows") > 0
    return merged.select(
        "rows", F.when(some, F.hll_sketch_estimate("ids")).otherwise(0).alias("distinct_ids"),
        F.when(some, F.array(*at)).alias("downloads"),
    )
