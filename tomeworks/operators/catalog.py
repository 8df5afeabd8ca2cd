"""The append-only catalog: writing, reading the latest view, manifests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import fixed, session
from ..functions import all_digits
from ..schema import PARTITION_COLUMNS, RECORD, STORED, conform
from ..sources import read_shards

# Newest first.  ingested_at alone can tie: a record that gains text later keeps the
# time it was listed.  The later run wins, then the later row of the run.
RECENCY = ("ingested_at", "run_seq", "row_seq")


def latest_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so a key
    with a large share of all rows sends one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("place", F.row_number().over(newest)).where("place = 1").drop("place")


def latest_shards(spark: SparkSession, base: str, provider: str | None = None) -> DataFrame:
    """Newest stored version of each record with its partition and arrival columns.

    Most records have one version.  Narrow columns tell which have more; while those fit
    a checked broadcast, the wide rows are filtered where they are read and never
    shuffled.  Beyond that the rows are ranked per key.
    """
    # Rows that agree on everything else still have one newest: a file and row of its own.
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("at_row")
    shards = read_shards(spark, base, provider)
    try:
        narrow = shards.select("book_uid", *RECENCY, place)
    except AnalysisException:
        return shards  # nothing stored yet: an empty table has no files
    rank = F.struct(*RECENCY, "at_row")
    several = (
        narrow.groupBy("book_uid")
        .agg(F.count(F.lit(1)).alias("versions"), F.max(rank).alias("newest"))
        .where("versions > 1")
        .select("book_uid", "newest")
    )
    found = several.limit(session.BROADCAST_ROWS + 1).count()
    if found > session.BROADCAST_ROWS:
        ranked = latest_wins(shards.select("*", place), ["book_uid"], (*RECENCY, "at_row"))
        return ranked.select(*shards.columns)
    marked = shards.select(*shards.columns, place).join(F.broadcast(several), "book_uid", "left")
    newest = F.col("newest").isNull() | rank.eqNullSafe(F.col("newest"))
    return marked.where(newest).select(*shards.columns)


def read_catalog(spark: SparkSession, base: str, provider: str | None = None) -> DataFrame:
    """The deduplicated view for consumers: one canonical record per ``book_uid``."""
    return conform(latest_shards(spark, base, provider), RECORD)


def read_run(spark: SparkSession, base: str, provider: str, day: date, run_seq: int) -> DataFrame:
    """What one run has stored; no other partition is listed or opened."""
    folder = f"{base}/catalog/provider={provider}/ingest_date={day.isoformat()}/run_seq={run_seq}"
    return spark.read.schema(STORED).option("basePath", f"{base}/catalog").parquet(folder)


def append_catalog(
    df: DataFrame,
    base: str,
    rows_per_file: int = fixed.DEFAULT_ROWS_PER_FILE,
    compression: str = fixed.DEFAULT_COMPRESSION,
) -> None:
    """Append the rows of one run.

    ``df`` carries the partition columns; its run_seq belongs to this run alone.  The
    write replaces just the partitions it touches, so a run delivered twice lands once.
    """
    (
        conform(df, STORED)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", max(1, rows_per_file))
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(f"{base}/catalog")
    )


def catalog_state(latest: DataFrame) -> DataFrame:
    """Per provider: number of records and largest numeric id."""
    sid = F.col("source_id")
    return latest.groupBy("provider").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.max(F.when(all_digits(sid), sid.try_cast("bigint"))).alias("max_id_seen"),
    )


def manifest(shards: DataFrame, written_at: datetime | Column) -> DataFrame:
    """One row per written file: provider, date, run, file and its rows.

    A long table, not a list per run: a run may write any number of files.  ``shards``
    is a read of the catalog limited to the runs in question.
    """
    stamp = written_at if isinstance(written_at, Column) else F.lit(written_at)
    return (
        shards.groupBy(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("shard"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("schema_version").alias("schema_version"),
        )
        .withColumn("written_at", stamp)
    )


def manifest_summary(files: DataFrame) -> DataFrame:
    """Shards and rows per provider, date and run."""
    return files.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("shards"), F.sum("rows").alias("rows")
    )


#: Reading and writing exported CSV.  An empty text is quoted, a null is not.
CSV_OPTIONS = {
    "header": True, "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False, "nullValue": "", "emptyValue": '""',
}


def read_export(spark: SparkSession, base: str, schema) -> dict[str, DataFrame]:
    """The three exports of ``export`` by format, with the columns of ``schema``."""
    # a field without quotes reads as this sign, which is no character, and so differs from an empty text
    unset = {"nullValue": "\uffff", "emptyValue": ""}
    return {
        "json": spark.read.schema(schema).json(f"{base}/json"),
        "csv": spark.read.schema(schema).options(**CSV_OPTIONS | unset).csv(f"{base}/csv"),
        "parquet": spark.read.schema(schema).parquet(f"{base}/parquet"),
    }


def export(df: DataFrame, base: str) -> None:
    """The same rows as JSON lines, CSV with a header, and Parquet.

    CSV quotes as other programs do (a quote is doubled) and trims nothing, so texts with line
    ends, quotes and outer blanks come back whole; see CSV_OPTIONS.  JSON keeps null fields out."""
    df.write.json(f"{base}/json")
    df.write.options(**CSV_OPTIONS).csv(f"{base}/csv")
    df.write.parquet(f"{base}/parquet")
