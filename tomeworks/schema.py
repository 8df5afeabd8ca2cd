"""The canonical record and the tables kept beside it.

The layout is fixed and always passed to readers and writers: a column that is null
throughout one file must not change type there.  New columns go to the end; existing
ones are never retyped or removed, so old files read with nulls in new columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from . import fixed

AUTHOR = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("source_author_id", T.StringType()),
        T.StructField("birth_year", T.IntegerType()),
        T.StructField("death_year", T.IntegerType()),
    ]
)

_TEXT_LIST = T.ArrayType(T.StringType())

RECORD = T.StructType(
    [
        T.StructField("book_uid", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("source_id", T.StringType(), False),
        T.StructField("identifiers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("title", T.StringType(), False),
        T.StructField("alternative_title", T.StringType()),
        T.StructField("authors", T.ArrayType(AUTHOR)),
        T.StructField("publication_year", T.IntegerType()),
        T.StructField("language", T.StringType()),
        T.StructField("subjects", _TEXT_LIST),
        T.StructField("categories", _TEXT_LIST),
        T.StructField("publisher", T.StringType()),
        T.StructField("download_url", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("cover_image_url", T.StringType()),
        T.StructField("media_type", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("is_public_domain", T.BooleanType()),
        T.StructField("rights_statement", T.StringType()),
        T.StructField("searchable_text", T.StringType()),
        T.StructField("text_source", T.StringType()),
        T.StructField("text_char_count", T.IntegerType()),
        T.StructField("download_count", T.LongType()),
        T.StructField("reading_ease_score", T.DoubleType()),
        T.StructField("issued_at", T.TimestampType()),
        T.StructField("withdrawn_reason", T.StringType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("provider_version", T.StringType()),
        T.StructField("content_hash", T.StringType(), False),
        T.StructField("schema_version", T.IntegerType(), False),
    ]
)

# Order of arrival inside the catalog; appended to the record on disk.
ARRIVAL = [T.StructField("row_seq", T.LongType())]
PARTITIONS = [
    T.StructField("provider", T.StringType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("run_seq", T.LongType()),
]
PARTITION_COLUMNS = tuple(f.name for f in PARTITIONS)
STORED = T.StructType(RECORD.fields + ARRIVAL + PARTITIONS)

HASHED = tuple(f.name for f in RECORD.fields if f.name not in fixed.NOT_HASHED)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_seq", T.LongType()),
        T.StructField("provider", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("last_page", T.LongType()),
        T.StructField("pages_read", T.LongType()),
        T.StructField("new_records", T.LongType()),
        T.StructField("changed_records", T.LongType()),
        T.StructField("unchanged_records", T.LongType()),
        T.StructField("text_fetched", T.LongType()),
        T.StructField("text_pending", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("stopped_reason", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """Project ``df`` onto ``schema``: order, types, nulls for absent columns.

    List and map columns never stay null; an absent list is an empty list.
    Columns outside the schema (partition columns, for one) are dropped.
    """
    present = set(df.columns)
    out = []
    for field in schema.fields:
        col = F.col(field.name) if field.name in present else F.lit(None)
        col = col.cast(field.dataType)
        if isinstance(field.dataType, T.ArrayType):
            col = F.coalesce(col, F.array().cast(field.dataType))
        elif isinstance(field.dataType, T.MapType):
            col = F.coalesce(col, F.create_map().cast(field.dataType))
        out.append(col.alias(field.name))
    return df.select(*out)
