"""Listing records to canonical and flat layouts; schema; content hash."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tomeworks import fixed
from tomeworks.operators import filters, normalize
from tomeworks.schema import HASHED, RECORD, STORED, conform

NOW = datetime(2026, 8, 15, tzinfo=timezone.utc)
BOOK = {
    "id": 77041, "title": "A Walk along the Weir", "alternative_title": None,
    "authors": [{"id": 503, "name": "Quill, Osbert"}],
    "subjects": ["Rivers", "Mills -- History"], "bookshelves": ["Local Lore"],
    "formats": {"application/pdf": "p", "text/plain; charset=us-ascii": "https://a.example/weir.txt", "text/plain": "https://a.example/second"},
    "download_count": 23, "issued": "2011-11-05T00:00:00Z", "summary": "\tMills and millers. ",
    "reading_ease_score": "54.75", "cover_image": "https://a.example/weir.png", "removed_from_catalog": None,
}


def normal(spark, *records, chars=4000):
    raw = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(raw, "pos int, raw string")
    return normalize.normalize_listing(df, NOW, chars)


def rows(spark, *records, **options):
    return normal(spark, *records, **options).orderBy("pos").collect()


def test_full_record(spark):
    r = rows(spark, BOOK)[0]
    assert (r.book_uid, r.source, r.source_id, r.sound) == ("gutenberg:77041", "gutenberg", "77041", True)
    assert r.identifiers == {"gutenberg_id": "77041"}
    assert [(a.name, a.source_author_id) for a in r.authors] == [("Quill, Osbert", "503")]
    assert r.categories == ["Local Lore"] and r.subjects == BOOK["subjects"]
    assert r.download_url == "https://a.example/weir.txt"
    assert r.source_url == "https://www.gutenberg.org/ebooks/77041"
    assert (r.searchable_text, r.text_source, r.text_char_count) == ("Mills and millers.", "summary", 18)
    assert (r.reading_ease_score, r.download_count, r.is_public_domain) == (54.75, 23, True)
    assert r.publication_year is None and r.language is None and r.publisher is None
    assert r.withdrawn_reason is None and r.schema_version == 1 and len(r.content_hash) == 64


def test_variants_of_fields(spark):
    bare, cut, gone, nofmt, nulls = rows(
        spark,
        {"id": 7},
        {**BOOK, "summary": "x" * 50},
        {**BOOK, "removed_from_catalog": "claim"},
        {**BOOK, "formats": {"text/html": "h", "text/plain": ""}, "issued": "1993-01-01", "reading_ease_score": 72.5},
        {**BOOK, "summary": None, "formats": None, "subjects": "One", "issued": "soon", "removed_from_catalog": False},
        chars=20,
    )
    assert (bare.book_uid, bare.title, bare.authors, bare.subjects, bare.text_source) == ("gutenberg:7", "", [], [], "none")
    assert bare.sound and bare.text_char_count == 0
    assert (cut.text_char_count, cut.searchable_text) == (20, "x" * 20)
    assert gone.withdrawn_reason == "claim" and gone.sound
    assert nofmt.download_url == "https://www.gutenberg.org/ebooks/77041.txt.utf-8"
    assert nofmt.issued_at.year == 1993 and nofmt.reading_ease_score == 72.5
    assert (nulls.searchable_text, nulls.text_source, nulls.subjects) == (None, "none", ["One"])
    assert nulls.issued_at is None and nulls.withdrawn_reason is None


def test_unsound_records(spark):
    bad = ["not json", {"title": "x"}, {"id": 1, "title": 5}, {"id": 1, "authors": [{"name": None}]}]
    assert [r.sound for r in rows(spark, *bad, {"id": 1, "authors": ["A", {}]})] == [False] * 4 + [True]
    good, aside = normalize.split_valid(normal(spark, *bad, BOOK))
    assert good.count() == 1 and aside.columns == ["pos", "raw"] and aside.count() == 4


def test_hash_follows_metadata_only(spark):
    same = [
        {**BOOK, "download_count": 9}, {**BOOK, "summary": "other"}, dict(reversed(list(BOOK.items()))),
    ]
    other = [
        {**BOOK, "title": "T"}, {**BOOK, "subjects": BOOK["subjects"][::-1]}, {**BOOK, "cover_image": None},
        {**BOOK, "reading_ease_score": 70}, {**BOOK, "issued": "1998-06-02"}, {**BOOK, "removed_from_catalog": "x"},
    ]
    hashes = [r.content_hash for r in rows(spark, BOOK, *same, *other)]
    assert len(set(hashes[:4])) == 1
    assert len(set(hashes)) == 1 + len(other)


def test_schema_is_complete():
    assert len(RECORD.fields) == 30 and len(HASHED) == 22
    assert [f.name for f in RECORD.fields if not f.nullable] == [
        "book_uid", "source", "source_id", "title", "ingested_at", "content_hash", "schema_version"
    ]
    assert [f.name for f in STORED.fields[30:]] == ["row_seq", "provider", "ingest_date", "run_seq"]


def test_conform(spark):
    df = spark.createDataFrame([("u", "2024-01-01", None)], "book_uid string, ingest_date string, subjects array<string>")
    got = conform(df)
    assert [f.dataType for f in got.schema] == [f.dataType for f in RECORD]
    r = got.first()
    assert (r.book_uid, r.subjects, r.authors, r.identifiers, r.title) == ("u", [], [], {}, None)


def test_old_files_read_with_new_columns(spark, tmp_path):
    short = T.StructType(RECORD.fields[:5])
    path = str(tmp_path / "old")
    spark.createDataFrame([("u", "s", "1", {"a": "b"}, "t")], short).write.parquet(path)
    r = spark.read.schema(RECORD).parquet(path).first()
    assert r.title == "t" and r.content_hash is None


def test_years_of_authors(spark):
    given = [1834, "1834", 1834.0, None, 1834.5, "about 1834", [1834], -44]
    got = rows(spark, *[{"id": i, "authors": ["Anon", {"name": "Q", "death_year": y}]} for i, y in enumerate(given)])
    assert [r.sound for r in got] == [True, True, True, True, False, False, False, True]
    assert [r.authors[1].death_year for r in got if r.sound] == [1834, 1834, 1834, None, -44]


def test_flat_listing(spark):
    df = spark.createDataFrame([(json.dumps(BOOK),), ('{"id": 9}',)], "raw string")
    full, bare = normalize.flatten_listing(df).orderBy("id").collect()
    assert full.asDict() == {
        "source": "gutenberg", "id": "77041", "title": BOOK["title"], "authors": "Quill, Osbert",
        "subjects": "Rivers; Mills -- History", "bookshelves": "Local Lore",
        "summary": BOOK["summary"], "download_count": 23, "reading_ease_score": "54.75",
        "issued": BOOK["issued"], "rights": "pd", "is_public_domain": True, "cover_image": "https://a.example/weir.png",
        "text_url": "https://a.example/second", "source_url": "https://www.gutenberg.org/ebooks/77041",
    }
    assert (bare.authors, bare.subjects, bare.text_url, bare.title) == ("", "", None, None)


def test_filters(spark):
    df = spark.createDataFrame(
        [("pd", None, "summary", "a"), ("cc-by", "x", "none", ""), ("pd-pvt", None, "first_chars", None)],
        "rights string, withdrawn_reason string, text_source string, searchable_text string",
    )
    assert filters.filter_public_domain(df).count() == 2
    assert filters.filter_public_domain(df, None).count() == 3
    assert filters.exclude_withdrawn(df).count() == 2
    assert filters.missing_text(df).count() == 2
    assert [r.text_rank for r in filters.text_quality(df).collect()] == [0, 4, 3]
    assert filters.only_sources(df, ["pd"], "rights").count() == 1


def test_display(spark):
    df = spark.createDataFrame(
        [(fixed.LISTING_SOURCE, 5, "1900"), (fixed.VOLUME_SOURCE, 5, "1900")],
        "source string, download_count int, publication_year string",
    )
    assert [r.info for r in normalize.display_info(df).collect()] == ["5", "1900"]
    assert normalize.preview_columns(df, ["source", "nope"]).columns == ["source"]


def test_pushdown_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    conform(normal(spark, BOOK)).write.parquet(path)
    plan = (
        spark.read.schema(RECORD).parquet(path).where("withdrawn_reason IS NULL").select("title")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PushedFilters: [IsNull(withdrawn_reason)]" in plan
    assert "ReadSchema: struct<title:string,withdrawn_reason:string>" in plan
