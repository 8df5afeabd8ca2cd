"""Listing and volume records to the canonical and the flat layouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions import (
    author_list,
    first_chars,
    first_plain_text_url,
    issued_timestamp,
    join_tags,
    path_quote,
    record_hash,
    string_list,
    strip_space,
)
from ..functions.parsing import number_of, variant_kind, variant_text
from ..schema import RECORD


def record_uid(source: Column, source_id: Column) -> Column:
    return F.concat(source, F.lit(":"), source_id.cast("string"))


def _flag_text(record: Column, path: str) -> Column:
    """A set flag as text: null when absent, empty, false or zero."""
    value = F.try_variant_get(record, path, "variant")
    text = variant_text(record, path)
    kind = variant_kind(value)
    return (
        F.when(kind == "STRING", F.nullif(text, F.lit("")))
        .when(kind == "BOOLEAN", F.when(text == "true", F.lit("True")))
        .when(text.isin("[]", "{}"), F.lit(None))
        .otherwise(F.when(F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0, text))
    )


def _text_or_absent(record: Column, path: str) -> Column:
    kind = variant_kind(F.try_variant_get(record, path, "variant"))
    return F.coalesce(kind, F.lit("VOID")).isin("STRING", "VOID")


def _whole_or_absent(record: Column, path: str) -> Column:
    """A whole number, a text that is one, or nothing."""
    kind = variant_kind(F.try_variant_get(record, path, "variant"))
    value = F.try_variant_get(record, path, "double")
    text = F.when(kind == "STRING", variant_text(record, path).try_cast("bigint"))
    whole = F.coalesce(value == F.floor(value), F.lit(False)) & kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.coalesce(kind, F.lit("VOID")).isin("VOID") | whole | text.isNotNull()


def _authors_sound(record: Column) -> Column:
    """Every author is a bare name or an object whose name, if given, is a string and whose years,
    if given, are whole numbers."""

    def sound(author: Column) -> Column:
        name = variant_kind(F.try_variant_get(author, "$.name", "variant"))
        is_object = F.startswith(variant_kind(author), F.lit("OBJECT"))
        years = _whole_or_absent(author, "$.birth_year") & _whole_or_absent(author, "$.death_year")
        return ~is_object | ((F.coalesce(name, F.lit("STRING")) == "STRING") & years)

    authors = F.try_variant_get(record, "$.authors", "array<variant>")
    return F.coalesce(F.forall(authors, sound), F.lit(True))


def normalize_listing(
    raw: DataFrame,
    run_ts: datetime | Column,
    chars: int = fixed.PREVIEW_CHARS,
    source: str | Column = fixed.LISTING_SOURCE,
) -> DataFrame:
    """Raw JSON records to canonical records.

    Columns of ``raw`` other than ``raw`` itself are carried along, and ``sound`` tells
    whether the record can be kept: it has an id, its texts are texts, its authors
    have names and their years are whole.  Nothing is dropped here; see ``split_valid``.
    """
    source = F.lit(source) if isinstance(source, str) else source
    run_ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    carried = [c for c in raw.columns if c != "raw"]
    v = F.col("v")
    # Through a one-element explode, so that a filter on the result cannot be pushed below
    # the parse and parse every record once more.
    parsed = raw.select(*carried, "raw", F.explode(F.array(F.try_parse_json("raw"))).alias("v"))
    staged = parsed.select(
        *carried,
        "raw",
        "v",
        variant_text(v, "$.id").alias("source_id"),
        strip_space(F.coalesce(variant_text(v, "$.summary"), F.lit(""))).alias("summary"),
    )
    sid = F.col("source_id")
    values = {
        "book_uid": record_uid(source, sid),
        "source": source,
        "source_id": sid,
        "identifiers": F.create_map(F.lit(fixed.LISTING_ID_KEY), sid),
        "title": F.coalesce(variant_text(v, "$.title"), F.lit("")),
        "alternative_title": variant_text(v, "$.alternative_title"),
        "authors": author_list(v, "$.authors"),
        "publication_year": F.lit(None).cast("int"),
        "language": F.lit(None).cast("string"),
        "subjects": string_list(v, "$.subjects"),
        "categories": string_list(v, "$.bookshelves"),
        "publisher": F.lit(None).cast("string"),
        "download_url": F.coalesce(
            first_plain_text_url(F.col("raw")),
            F.concat(F.lit(fixed.LISTING_PAGE_URL), sid, F.lit(fixed.LISTING_TEXT_SUFFIX)),
        ),
        "source_url": F.concat(F.lit(fixed.LISTING_PAGE_URL), sid),
        "cover_image_url": variant_text(v, "$.cover_image"),
        "media_type": variant_text(v, "$.media_type"),
        "license": F.lit(fixed.LISTING_LICENSE),
        "is_public_domain": F.lit(True),
        "rights_statement": F.lit(fixed.LISTING_RIGHTS),
        "searchable_text": F.nullif(first_chars(F.col("summary"), chars), F.lit("")),
        "text_source": F.when(F.col("summary") != "", F.lit("summary")).otherwise(F.lit("none")),
        "text_char_count": F.length(first_chars(F.col("summary"), chars)),
        "download_count": F.try_variant_get(v, "$.download_count", "bigint"),
        "reading_ease_score": number_of(v, "$.reading_ease_score"),
        "issued_at": issued_timestamp(variant_text(v, "$.issued")),
        "withdrawn_reason": _flag_text(v, "$.removed_from_catalog"),
        "ingested_at": run_ts,
        "provider_version": F.lit(fixed.LISTING_VERSION),
        "schema_version": F.lit(fixed.SCHEMA_VERSION),
    }
    texts = ("$.title", "$.alternative_title", "$.cover_image", "$.media_type")
    sound = F.coalesce(sid, F.lit("")) != ""
    for path in texts:
        sound = sound & _text_or_absent(v, path)
    sound = sound & _authors_sound(v) & _whole_or_absent(v, "$.download_count")
    shaped = staged.select(
        *carried,
        "raw",
        F.coalesce(sound, F.lit(False)).alias("sound"),
        *[
            values[f.name].cast(f.dataType).alias(f.name)
            for f in RECORD.fields
            if f.name in values
        ],
    )
    return shaped.withColumn("content_hash", record_hash())


def split_valid(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records to keep, raw records set aside)."""
    good = normalized.where(F.col("sound")).drop("sound", "raw")
    kept_aside = [c for c in ("provider", "page", "pos", "raw") if c in normalized.columns]
    return good, normalized.where(~F.col("sound")).select(*kept_aside)


def is_public_domain(rights: Column) -> Column:
    return F.coalesce(rights.isin(*fixed.PUBLIC_DOMAIN_CODES), F.lit(False))


def flatten_listing(raw: DataFrame) -> DataFrame:
    """Raw JSON records to the flat 15-column layout; lists joined with ``"; "``."""
    v = F.col("v")
    names = F.transform(author_list(v, "$.authors"), lambda a: a.getField("name"))
    formats = F.from_json("raw", "formats map<string,string>").getField("formats")
    sid = variant_text(v, "$.id")
    return raw.withColumn("v", F.try_parse_json("raw")).select(
        F.lit(fixed.LISTING_SOURCE).alias("source"),
        sid.alias("id"),
        variant_text(v, "$.title").alias("title"),
        join_tags(names).alias("authors"),
        join_tags(string_list(v, "$.subjects")).alias("subjects"),
        join_tags(string_list(v, "$.bookshelves")).alias("bookshelves"),
        variant_text(v, "$.summary").alias("summary"),
        F.try_variant_get(v, "$.download_count", "bigint").alias("download_count"),
        variant_text(v, "$.reading_ease_score").alias("reading_ease_score"),
        variant_text(v, "$.issued").alias("issued"),
        F.lit("pd").alias("rights"),
        F.lit(True).alias("is_public_domain"),
        variant_text(v, "$.cover_image").alias("cover_image"),
        F.try_element_at(formats, F.lit("text/plain")).alias("text_url"),
        F.concat(F.lit(fixed.LISTING_PAGE_URL), sid).alias("source_url"),
    )


def flatten_volumes(volumes: DataFrame) -> DataFrame:
    """Volume rows to the flat 18-column layout."""
    return volumes.select(
        F.lit(fixed.VOLUME_SOURCE).alias("source"),
        F.col("htid").alias("id"),
        "title",
        F.col("author").alias("authors"),
        F.col("rights_date_used").alias("publication_year"),
        F.col("imprint").alias("publisher"),
        F.col("lang").alias("language"),
        "rights",
        "access",
        is_public_domain(F.col("rights")).alias("is_public_domain"),
        "isbn",
        "oclc_num",
        "lccn",
        "bib_fmt",
        "pub_place",
        F.col("source").alias("holding_library"),
        F.concat(F.lit(fixed.VOLUME_PAGE_URL), path_quote(F.col("htid"))).alias("source_url"),
        F.concat(F.lit(fixed.VOLUME_RECORD_URL), F.col("ht_bib_key")).alias("catalog_url"),
    )


def display_info(df: DataFrame) -> DataFrame:
    """``info``: downloads where the source counts them, else the year."""
    count = F.col("download_count").cast("string")
    year = F.col("publication_year").cast("string")
    return df.withColumn(
        "info", F.when(F.col("source") == fixed.LISTING_SOURCE, count).otherwise(year)
    )


def preview_columns(df: DataFrame, wanted: list[str], n: int = 5) -> DataFrame:
    """The wanted columns that exist, first ``n`` rows (a look at the data, unordered)."""
    return df.select(*[c for c in wanted if c in df.columns]).limit(n)
