"""A bulk snapshot kept current by daily deltas.

A day changes a small part of the snapshot, so a delta is appended, not merged: the
current state is the newest row per key over baseline and deltas, without the volumes whose
newest row marks them as removed.  From time to time the state is written out as the next
baseline and the deltas before it are no longer read.

Baselines are versions.  Each is written to a folder of its own, and becomes the current one by a
row in the log of versions, which is added when the folder is whole.  A reader looks the
version up once and reads that folder to the end, whatever is written meanwhile; older versions
can be read by name until they are retired.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import fixed
from ..operators.snapshots import apply_deltas
from ..session import read_or_empty, remove
from ..sources import read_volumes_stream

_VOLUME = [T.StructField(c, T.StringType()) for c in fixed.VOLUME_COLUMNS]
STORED_VOLUME = T.StructType(
    [
        *_VOLUME, T.StructField("removed", T.BooleanType()), T.StructField("file_date", T.StringType()),
        T.StructField("file", T.StringType()),
    ]
)
VERSIONS = T.StructType(
    [
        T.StructField("commit", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("retired", T.BooleanType()),
    ]
)
_DATE = r"(\d{8})"
_MARK = "removals"


def snapshot_stream(spark: SparkSession, landing: str, base: str, checkpoint: str) -> StreamingQuery:
    """Append the daily files that have landed, each into the partition of its date.

    A file without eight digits in its name fails the batch: it could never be read again.
    Only the partitions of the files in a batch are replaced, each by the same rows, so
    a batch may run again.
    """
    dated = F.nullif(F.regexp_extract("file", _DATE, 1), F.lit(""))
    undated = F.raise_error(F.concat(F.lit("no date in the name of delta file "), F.col("file")))
    volumes = read_volumes_stream(spark, landing).withColumn(
        "file_date", F.coalesce(dated, undated.cast("string"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        append_deltas(batch, base)

    return (
        volumes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_deltas(rows: DataFrame, base: str) -> None:
    """Add daily rows (volume columns, file_date, file), replacing what the same files held before."""
    known = set(rows.columns)
    columns = [F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_VOLUME.fields]
    (
        rows.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_date", "file")
        .parquet(f"{base}/deltas")
    )


def mark_removed(rows: DataFrame, base: str) -> None:
    """Volumes that are gone: rows of htid and the file_date from which on.  A later row of a volume
    brings it back; on one date the mark wins.  Marks of one date replace each other."""
    marks = rows.select("htid", "file_date").distinct()
    append_deltas(marks.withColumns({"removed": F.lit(True), "file": F.lit(_MARK)}), base)


def versions(spark: SparkSession, base: str) -> DataFrame:
    """The baselines that can be read: commit, version, folder, committed_at."""
    log = read_or_empty(spark, f"{base}/versions", VERSIONS)
    gone = log.where("retired").select("folder")
    return log.where("not retired").join(gone, "folder", "left_anti").drop("retired")


def _log(spark: SparkSession, base: str, version: str, folder: str, retired: bool = False) -> None:
    last = read_or_empty(spark, f"{base}/versions", VERSIONS).agg(F.max("commit")).first()[0] or 0
    row = (last + 1, version, folder, datetime.now(timezone.utc), retired)
    spark.createDataFrame([row], VERSIONS).coalesce(1).write.mode("append").parquet(f"{base}/versions")


def _baseline(spark: SparkSession, base: str, version: str | None = None) -> tuple[DataFrame, str]:
    kept = versions(spark, base)
    kept = kept if version is None else kept.where(F.col("version") == version)
    found = kept.agg(F.max_by(F.struct("version", "folder"), "commit").alias("v")).first()["v"]
    if found is None:
        if version is not None:
            raise ValueError(f"no baseline {version!r} can be read")
        return spark.createDataFrame([], STORED_VOLUME), ""
    return spark.read.schema(STORED_VOLUME).parquet(found.folder), found.version


def current_snapshot(
    spark: SparkSession, base: str, version: str | None = None, until: str | None = None
) -> DataFrame:
    """Newest row of each volume: the latest baseline and the deltas after it.

    ``version`` reads an older baseline that is still kept; ``until`` leaves out deltas of later
    dates.
    """
    baseline, covered = _baseline(spark, base, version)
    deltas = read_or_empty(spark, f"{base}/deltas", STORED_VOLUME)
    deltas = deltas.where(F.col("file_date") > covered)
    if until is not None:
        deltas = deltas.where(F.col("file_date") <= until)
    both = deltas.select(*baseline.columns).withColumn("removed", F.coalesce("removed", F.lit(False)))
    # The file name is the last resort for two files of one date.
    newest = apply_deltas(baseline.withColumn("removed", F.lit(False)), both, ("file_date", "removed", "rights_timestamp", "file"))
    return newest.where(~F.col("removed"))


def rebaseline(
    spark: SparkSession, base: str, version: str, snapshot: DataFrame | None = None, keep: int = 2
) -> None:
    """Write a baseline dated ``version``: the published monthly file if given, else the
    state at that date.  Deltas up to that date are covered by it; what a monthly file no longer has is gone.

    The last ``keep`` versions stay readable.  Older ones are retired: logged as such, then removed
    with the deltas that no kept version needs.
    """
    rows = current_snapshot(spark, base, until=version) if snapshot is None else snapshot
    extra = {"file": F.lit("baseline"), "file_date": F.lit(version), "removed": F.lit(False)}
    rows = rows.withColumns({k: v for k, v in extra.items() if k not in rows.columns})
    folder = f"{base}/baselines/{version}-{uuid.uuid4().hex}"
    rows.select(*STORED_VOLUME.names).write.parquet(folder)
    _log(spark, base, version, folder)
    kept = versions(spark, base).orderBy(F.desc("commit")).collect()  # a handful: older ones are retired
    for old in kept[max(1, keep):]:
        _log(spark, base, old.version, old.folder, retired=True)
        remove(spark, old.folder)
    if len(kept) > max(1, keep):
        least = min(r.version for r in kept[: max(1, keep)])
        for r in read_or_empty(spark, f"{base}/deltas", STORED_VOLUME).select("file_date").distinct().collect():
            if r.file_date <= least:  # one folder for each day published
                remove(spark, f"{base}/deltas/file_date={r.file_date}")
