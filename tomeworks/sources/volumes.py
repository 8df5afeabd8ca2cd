"""Bulk volume files: headerless tab-separated text with 26 columns, usually gzipped.

The CSV reader is not used: quotes are literal here, rows with too few fields are
dropped while rows with too many keep their first 26, and an empty field is an empty
string.  A gzip file is read by one task; the rows are spread over the cluster right
after the split so that the work behind it is parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed

INDEX = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("full", T.BooleanType()),
        T.StructField("size", T.LongType()),
        T.StructField("created", T.StringType()),
        T.StructField("modified", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)


def parse_volumes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines to 26 string columns, other columns of ``lines`` kept; bytes that are not
    UTF-8 become the replacement mark.

    The split goes through a one-element explode so that it is made once: a filter on a
    projected split would be pushed below the projection and split every line again.
    """
    kept = [c for c in lines.columns if c != column]
    fields = F.split(F.make_valid_utf8(F.col(column)), "\t", -1)
    once = lines.select(*kept, F.explode(F.array(fields)).alias("f"))
    return once.where(F.size("f") >= len(fixed.VOLUME_COLUMNS)).select(
        *[F.col("f")[i].alias(name) for i, name in enumerate(fixed.VOLUME_COLUMNS)], *kept
    )


def read_volumes(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Volume files under ``path``.

    ``partitions`` spreads the rows of unsplittable files.  Leave it unset when rows are
    filtered first or there are at least as many files as cores: the shuffle then costs
    more than it gains.
    """
    volumes = parse_volumes(spark.read.text(path))
    return volumes.repartition(partitions) if partitions else volumes


def read_volumes_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of landed volume files with the name of the file a row came from."""
    lines = spark.readStream.text(path)
    return parse_volumes(lines.select("value", F.col("_metadata.file_name").alias("file")))


def read_file_index(spark: SparkSession, path: str) -> DataFrame:
    """The entries of each index file under ``path`` with their ``position`` in it.  A file that
    is no JSON list gives no rows."""
    whole = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.ArrayType(INDEX))
    return whole.select(F.posexplode(entries).alias("position", "entry")).select("entry.*", "position")


def newest_file(index: DataFrame, full: bool, tie: str | None = None) -> DataFrame:
    """The newest monthly (``full``) or daily file of the index: one row or none.  Of files
    of one time the first entry counts, or the smallest file name where entries have no
    ``position``."""
    tie = tie or ("position" if "position" in index.columns else "filename")
    matching = index.where(F.coalesce(F.col("full"), F.lit(False)) == F.lit(full))
    return matching.orderBy(F.desc("created"), F.asc(tie)).limit(1)
