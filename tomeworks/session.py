"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(app: str = "tomeworks", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark.  A cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOMEWORKS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tomeworks-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def work_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tomeworks/{label}-{uuid.uuid4().hex}"


class _Staged(threading.local):
    """Paths staged by this thread; streams of one driver run on threads of their own."""

    def __init__(self):
        self.paths: list[str] = []


_STAGED = _Staged()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The copy is columnar, so later passes read only the columns they need, and it
    outlives any executor.  It stays until ``drop_stages`` or until the cluster cleans
    its checkpoint folder.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    _STAGED.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_so_far() -> int:
    return len(_STAGED.paths)


def drop_stages(spark: SparkSession, since: int = 0) -> None:
    """Remove the copies this thread staged after mark ``since`` (see ``staged_so_far``)."""
    while len(_STAGED.paths) > since:
        remove(spark, _STAGED.paths.pop())


def settle(spark: SparkSession, df: DataFrame, label: str, since: int) -> DataFrame:
    """Stage ``df`` and remove what this thread staged for it after mark ``since``."""
    kept = stage(df, label)
    path = _STAGED.paths.pop()
    drop_stages(spark, since)
    _STAGED.paths.append(path)
    return kept


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, whatever file system it lies in."""
    target, files = _folder(spark, path)
    files.mkdirs(target)


def move_only_file(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one data file of ``folder`` to the place ``target``."""
    source, files = _folder(spark, folder)
    found = [f.getPath() for f in files.listStatus(source) if not f.getPath().getName().startswith(("_", "."))]
    place, _ = _folder(spark, target)
    files.mkdirs(place.getParent())
    if len(found) != 1 or not files.rename(found[0], place):
        raise FileNotFoundError(f"{folder} does not hold one file that can be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    target, files = _folder(spark, path)
    files.delete(target, True)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet under ``path`` with ``schema``; a path not written yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(
    df: DataFrame, max_rows: int | None = None, rows: int | None = None
) -> DataFrame:
    """Broadcast hint for ``df`` only once it is known to have at most ``max_rows`` rows
    (BROADCAST_ROWS unless given).

    ``rows`` is a bound the caller has counted already; without it the rows are counted
    here, so ``df`` should be a narrow key table that is cheap to count.  Beyond the
    bound the frame is returned as it is and the join is left to the planner.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    if rows is None:
        rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df
