"""Landed listing pages.

A page is one JSON document ``{"next": …, "results": [ … ]}``.  Pages arrive either as
files ``provider=P/page-000001.run-17.json`` (a page fetched again lands under a new
run, never under an old name; without a run in its name a page is of run 0, and any other
name fails the read) or as rows ``(provider, page, run, payload)`` of a table,
which is the better layout once there are millions of pages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import broadcast_if_small, stage

PAGES = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("run", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)
_FILE = T.StructType([T.StructField("value", T.StringType())])
_NAME = r"^page-(\d+)(?:\.run-(\d+))?\.json$"


def _page() -> Column:
    page = F.regexp_extract("_metadata.file_name", _NAME, 1).try_cast("long")
    unknown = F.concat(F.lit("not the name of a page: "), F.col("_metadata.file_name"))
    return F.coalesce(page, F.raise_error(unknown).cast("long"))


def _run() -> Column:
    return F.coalesce(F.regexp_extract("_metadata.file_name", _NAME, 2).try_cast("long"), F.lit(0))


def _provider() -> Column:
    return F.regexp_extract("_metadata.file_path", r"/provider=([^/]+)/", 1)


def read_pages(
    spark: SparkSession, path: str, from_page: int = 1, to_page: int | None = None
) -> DataFrame:
    """Page files under ``path`` in the given range, newest run of each page.

    The page test is on file metadata, so other pages are not opened.
    """
    wanted = _page() >= max(1, from_page)
    if to_page is not None:
        wanted = wanted & (_page() <= to_page)
    try:
        files = (
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "page-*.json")
            .schema(_FILE)
            .text(path, wholetext=True)
            .where(wanted)
        )
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PAGES)  # nothing has landed yet
    pages = files.select(
        _provider().alias("provider"), _page().alias("page"), _run().alias("run"),
        F.col("value").alias("payload"),
    )
    # File names alone tell which runs are superseded; binaryFile without its content
    # column lists files and reads none.
    names = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "page-*.json")
        .load(path)
        .where(wanted)
        .select(_provider().alias("provider"), _page().alias("page"), _run().alias("run"))
    )
    return newest_pages(pages, names)


def newest_pages(pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Drop pages that a later run fetched again.

    Only the names (provider, page, run) are grouped; payloads are never shuffled for
    it as long as the superseded pages, which are few, fit a checked broadcast.
    """
    if names is None:
        names = pages.select("provider", "page", "run")
    newest = names.groupBy("provider", "page").agg(F.max("run").alias("newest"))
    stale = (
        names.join(newest, ["provider", "page"])
        .where(F.col("run") < F.col("newest"))
        .select("provider", "page", "run")
        .distinct()
    )
    return pages.join(broadcast_if_small(stale), ["provider", "page", "run"], "left_anti")


def one_delivery(pages: DataFrame) -> DataFrame:
    """One payload for each page: the newest fetch of it, however often that was delivered.

    Of payloads that differ under one name the one with the larger hash counts.  Only names
    and hashes are grouped, and only where pages come more than once are rows dropped.
    """
    pages = newest_pages(pages)
    mark = F.xxhash64("payload").alias("mark")
    several = (
        pages.select("provider", "page", mark).groupBy("provider", "page")
        .agg(F.count(F.lit(1)).alias("n"), F.max("mark").alias("mark")).where("n > 1").drop("n")
    )
    several = stage(several, "deliveries")
    if several.isEmpty():
        return pages
    again = broadcast_if_small(several.select("provider", "page"))
    once = pages.join(again, ["provider", "page"], "left_anti")
    chosen = pages.withColumn("mark", mark).join(broadcast_if_small(several), ["provider", "page", "mark"], "left_semi")
    return once.unionByName(chosen.dropDuplicates(["provider", "page"]).drop("mark"))


def explode_pages(pages: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per listed record: (provider, page, has_next, pos, raw), ``raw`` being its
    JSON text.  With ``keep_empty`` a page without records leaves one row without pos.

    A page whose JSON is broken is one malformed record, its payload, and has a successor:
    it goes to quarantine and does not end the listing."""
    fields = "next string, results array<string>, broken string"
    doc = F.from_json("payload", fields, {"columnNameOfCorruptRecord": "broken"})
    explode = F.posexplode_outer if keep_empty else F.posexplode
    broken = F.col("doc").isNull() | F.col("doc.broken").isNotNull()
    ends = F.coalesce(F.col("doc.next"), F.lit("")).isin("", "false", "0")
    return pages.withColumn("doc", doc).select(
        "provider",
        "page",
        (broken | ~ends).alias("has_next"),
        explode(F.when(broken, F.array("payload")).otherwise(F.col("doc.results"))).alias("pos", "raw"),
    )


def page_ends(listed: DataFrame) -> DataFrame:
    """Per provider, the page where a reader following ``next`` stops — before the first
    page without records, after the first page without a successor — with the range and
    number of pages and the number of records.  Expects ``explode_pages(keep_empty=True)``."""
    empty = F.col("pos").isNull()
    return listed.groupBy("provider").agg(
        F.least(
            F.min(F.when(empty, F.col("page") - 1)),
            F.min(F.when(~empty & ~F.col("has_next"), F.col("page"))),
            F.max("page"),
        ).alias("end_page"),
        F.min("page").alias("first_landed"),
        F.max("page").alias("last_landed"),
        F.count("pos").alias("records"),
        F.count_distinct("page").alias("pages"),
    )


def first_gap(listed: DataFrame) -> int | None:
    """Smallest page that has not landed although its predecessor has."""
    pages = listed.select("page").distinct()
    after = pages.select((F.col("page") + 1).alias("page"))
    return after.join(pages, "page", "left_anti").agg(F.min("page")).first()[0]


def read_listing(spark: SparkSession, path: str, from_page: int = 1) -> DataFrame:
    """Raw records of the landed listing in (page, pos) order columns."""
    return explode_pages(read_pages(spark, path, from_page))


def read_listing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed pages.  A file source keeps its own record of files already read."""
    reader = spark.readStream.option("pathGlobFilter", "page-*.json")
    reader = reader.option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.schema(_FILE)
        .text(path, wholetext=True)
        .select(
            _provider().alias("provider"), _page().alias("page"), _run().alias("run"),
            F.col("value").alias("payload"),
        )
    )
