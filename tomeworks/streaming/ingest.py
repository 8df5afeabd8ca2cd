"""Continuous ingestion of landed pages, and appending a change log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed
from ..plans.job import RunOptions, ingest
from ..sources import read_listing_stream, read_texts


def ingest_stream(
    spark: SparkSession,
    base: str,
    landing: str,
    checkpoint: str,
    provider: str = fixed.LISTING_SOURCE,
    options: RunOptions = RunOptions(max_rows=None, budget=None, text_cap=None),
    max_files: int | None = None,
    with_texts: bool = True,
) -> StreamingQuery:
    """Take every page that has landed since the last time, then stop.

    Each micro-batch is one run.  Its id is (query, batch): a batch delivered again after
    a failure gets the same run number and replaces what its first attempt wrote.  A batch
    has no page order, so the row cap does not apply; ``max_files`` bounds a batch.
    """
    pages = read_listing_stream(spark, f"{landing}/listing/provider={provider}", max_files)
    if options.max_rows is not None or options.budget is not None:
        raise ValueError("a stream takes whole batches: max_files bounds them, not max_rows or budget")

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        texts = read_texts(session, f"{landing}/texts").where(f"provider = '{provider}'")
        ingest(
            session,
            base,
            batch,
            provider,
            options,
            run_id=f"{query_id(session, checkpoint)}/{batch_id}",
            run_ts=datetime.now(timezone.utc),
            texts=texts if with_texts else None,
        )

    return (
        pages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in the checkpoint; the same across restarts."""
    meta = spark.read.text(f"{checkpoint}/metadata").select(
        F.get_json_object("value", "$.id").alias("id")
    )
    return meta.first()["id"]


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, partition: str = "batch"
) -> StreamingQuery:
    """Append a stream of rows to a Parquet table, one partition per micro-batch.

    A batch delivered again replaces its own partition, so readers see each row once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(partition, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
