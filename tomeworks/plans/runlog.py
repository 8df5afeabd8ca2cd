"""The run log: reservations made before a run writes, reports written after it."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import RUN_LOG
from ..session import read_or_empty

RESERVED = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("run_seq", T.LongType()),
    ]
)


@dataclass
class RunReport:
    run_id: str
    run_seq: int
    provider: str
    mode: str
    started_at: datetime
    last_page: int = 0
    pages_read: int = 0
    new_records: int = 0
    changed_records: int = 0
    unchanged_records: int = 0
    text_fetched: int = 0
    text_pending: int = 0
    rows_written: int = 0
    quarantined: int = 0
    stopped_reason: str = "completed"
    #: Records on the pages that were read, malformed ones too; not part of the log.
    listed: int = 0

    def as_row(self, spark: SparkSession) -> DataFrame:
        """The report as the one row that the run log keeps of it."""
        values = asdict(self)
        return spark.createDataFrame([tuple(values[f.name] for f in RUN_LOG.fields)], RUN_LOG)


def reserve(spark: SparkSession, base: str, run_id: str, run_ts: datetime) -> tuple[int, datetime]:
    """The sequence number and time of a run.

    Written before the run's data, so that a run delivered again under the same id gets
    the same number and date and replaces its own partition, and no other run ever gets
    its number.  One writer per catalog is assumed.
    """
    path = f"{base}/_reserved"
    taken = read_or_empty(spark, path, RESERVED).agg(
        F.max("run_seq").alias("last"),
        F.max(F.when(F.col("run_id") == run_id, F.struct("run_seq", "run_ts"))).alias("mine"),
    ).first()
    if taken["mine"] is not None:
        mine = taken["mine"]
        return mine["run_seq"], mine["run_ts"].astimezone(timezone.utc)
    run_seq = (taken["last"] or 0) + 1
    row = [(run_id, run_ts, run_seq)]
    spark.createDataFrame(row, RESERVED).coalesce(1).write.mode("append").parquet(path)
    return run_seq, run_ts


def reserved_between(spark: SparkSession, base: str, provider: str, after: int, before: int) -> bool:
    """Whether a run of the provider took a number between the two."""
    taken = read_or_empty(spark, f"{base}/_reserved", RESERVED)
    own = F.endswith("run_id", F.lit(f"/{provider}"))
    return not taken.where(own & (F.col("run_seq") > after) & (F.col("run_seq") < before)).isEmpty()


def read_run_log(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, f"{base}/_runs", RUN_LOG)


def resume_page(spark: SparkSession, base: str, provider: str, before: int) -> int:
    """Last page fully taken by the newest earlier run of the provider; 0 if none."""
    log = read_run_log(spark, base)
    log = log.where((F.col("provider") == provider) & (F.col("run_seq") < before))
    return log.agg(F.max_by("last_page", "run_seq").alias("page")).first()["page"] or 0


def write_report(spark: SparkSession, base: str, report: RunReport) -> None:
    (
        report.as_row(spark)
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_seq", "provider")
        .parquet(f"{base}/_runs")
    )
