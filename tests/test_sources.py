"""Readers: landed pages, volume files, the file index, shards and flat tables."""

import csv
import json

from pyspark.sql import functions as F

from tomeworks import fixed, session, sources
from tomeworks.operators import catalog, filters, normalize
from tomeworks.sources.listing import page_ends


def test_pages_newest_run_wins(spark, land):
    folder = f"{land.root}/listing/provider={land.provider}"
    land.listing([{"id": i} for i in range(1, 6)], page_size=2)
    land.listing([{"id": i} for i in range(1, 7)], page_size=2, only={3})
    got = sources.read_listing(spark, folder).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, json.loads(r.raw)["id"]) for r in got] == [
        (1, 0, 1), (1, 1, 2), (2, 0, 3), (2, 1, 4), (3, 0, 5), (3, 1, 6)
    ]
    assert sources.read_pages(spark, folder, 2, 2).count() == 1
    assert sources.read_listing(spark, folder, from_page=3).count() == 2


def test_page_ends(spark):
    pages = spark.createDataFrame(
        [
            ("a", 1, 1, '{"next":"x","results":[{"id":1}]}'), ("a", 2, 1, '{"next":null,"results":[{"id":2}]}'),
            ("a", 3, 1, '{"next":"x","results":[{"id":3}]}'),
            ("b", 1, 1, '{"next":"x","results":[{"id":1}]}'), ("b", 2, 1, '{"next":"x","results":[]}'),
            ("c", 1, 1, '{"next":"x","results":[{"id":1}]}'),
        ],
        "provider string, page long, run long, payload string",
    )
    listed = sources.explode_pages(pages, keep_empty=True)
    assert {r.provider: r.end_page for r in page_ends(listed).collect()} == {"a": 2, "b": 1, "c": 1}
    assert sources.explode_pages(pages).count() == 5


def test_a_broken_page_is_a_record_and_has_a_successor(spark):
    pages = spark.createDataFrame(
        [("c", 1, 1, '{"next":"x","results":[{"id":1}]}'), ("c", 2, 1, "broken"), ("c", 3, 1, '{"results":[{"id":3}]}')],
        "provider string, page long, run long, payload string",
    )
    listed = sources.explode_pages(pages, keep_empty=True)
    assert page_ends(listed).first().end_page == 3
    assert [(r.page, r.raw) for r in listed.orderBy("page").collect()][1] == (2, "broken")


def volume(**values):
    row = {c: "" for c in fixed.VOLUME_COLUMNS} | values
    return "\t".join(row.values()).encode()


def test_volume_lines(spark, gz):
    path = gz(
        "hathi_upd_20260814.txt.gz",
        [
            volume(htid="uc2.ark:/13960/t4", title='A "bare quote', rights="pd", source="UC", author="A"),
            volume(htid="short", rights="pd").rsplit(b"\t", 1)[0],
            volume(htid="long", rights="pdus") + b"\textra\tmore",
            b"",
            volume(htid="bad", rights="ic", title="x").replace(b"x", b"\xff"),
            volume(htid="cc", rights="cc-by-4.0"),
        ],
    )
    got = {r.htid: r for r in sources.read_volumes(spark, path, partitions=3).collect()}
    assert set(got) == {"uc2.ark:/13960/t4", "long", "bad", "cc"}
    assert got["uc2.ark:/13960/t4"].title == 'A "bare quote' and got["bad"].title == "�"
    assert got["long"].author == "" and got["cc"].isbn == ""
    flat = normalize.flatten_volumes(filters.filter_public_domain(sources.read_volumes(spark, path)))
    rows = {r.id: r for r in flat.collect()}
    assert set(rows) == {"uc2.ark:/13960/t4", "long"} and len(flat.columns) == 18
    first = rows["uc2.ark:/13960/t4"]
    assert first.source_url == "https://babel.hathitrust.org/cgi/pt?id=uc2.ark%3A/13960/t4"
    assert (first.holding_library, first.authors, first.is_public_domain) == ("UC", "A", True)


def test_newest_file(spark, tmp_path):
    index = [
        {"filename": "m7", "full": True, "size": 1, "created": "2026-07-01 03:00", "modified": "x", "url": "u"},
        {"filename": "m8", "full": True, "size": 1, "created": "2026-08-01 03:00", "modified": "x", "url": "u"},
        {"filename": "d9", "full": False, "size": 1, "created": "2026-08-17 03:00", "modified": "x", "url": "u"},
    ]
    path = tmp_path / "index.json"
    path.write_text(json.dumps(index))
    files = sources.read_file_index(spark, str(path))
    assert sources.newest_file(files, True).first().filename == "m8"
    assert sources.newest_file(files, False).first().filename == "d9"
    (tmp_path / "two").mkdir()
    for name in ("a.json", "b.json"):
        (tmp_path / "two" / name).write_text(json.dumps(index[::-1], indent=1))
    several = sources.read_file_index(spark, str(tmp_path / "two"))
    assert sorted((r.position, r.filename) for r in several.collect()) == [(0, "d9")] * 2 + [(1, "m8")] * 2 + [(2, "m7")] * 2


def test_exports_come_back_whole(spark, tmp_path):
    texts = ['a "quoted" word', " blanks around ", "two\nlines", "a,b;c\td", "back\\slash \\", "", None, '"', "é 日本"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, text string").repartition(3)
    catalog.export(df, str(tmp_path / "out"))
    for name, back in catalog.read_export(spark, str(tmp_path / "out"), df.schema).items():
        assert sorted(map(tuple, back.collect())) == list(enumerate(texts)), name
    # another program reads the same
    found = [r for p in (tmp_path / "out" / "csv").glob("part-*.csv") for r in csv.DictReader(p.open(newline=""))]
    assert sorted((int(r["n"]), r["text"]) for r in found) == [(i, t or "") for i, t in enumerate(texts)]


def record(spark, rows):
    df = spark.createDataFrame(
        rows, "source_id string, title string, at string, provider string, run_seq long, row_seq long"
    )
    return df.select(
        F.concat("provider", F.lit(":"), "source_id").alias("book_uid"), F.col("provider").alias("source"),
        "source_id", "title", F.to_timestamp("at").alias("ingested_at"), F.lit("h").alias("content_hash"),
        F.lit(1).alias("schema_version"), "provider", F.to_date("at").alias("ingest_date"), "run_seq", "row_seq",
    )


def test_catalog_latest_wins(spark, tmp_path):
    base = str(tmp_path / "b")
    assert catalog.read_catalog(spark, base).count() == 0
    catalog.append_catalog(record(spark, [("1", "Old Title", "2026-08-14", "p", 1, 1), ("2", "Two", "2026-08-14", "p", 1, 2)]), base, 1)
    catalog.append_catalog(record(spark, [("1", "New Title", "2026-08-15", "p", 2, 1), ("1", "Q", "2026-08-15", "q", 2, 1)]), base)
    got = {r.book_uid: r.title for r in catalog.read_catalog(spark, base).collect()}
    assert got == {"p:1": "New Title", "p:2": "Two", "q:1": "Q"}
    assert [r.title for r in catalog.read_catalog(spark, base, "q").collect()] == ["Q"]
    # Equal times: the later run wins, then the later row.
    catalog.append_catalog(record(spark, [("1", "Same time", "2026-08-15", "p", 3, 0), ("1", "Last row", "2026-08-15", "p", 3, 5)]), base)
    assert catalog.read_catalog(spark, base, "p").where("source_id = '1'").first().title == "Last row"
    whole = spark.read.parquet(f"{base}/catalog")
    assert whole.count() == 6 and {"provider", "ingest_date", "run_seq"} <= set(whole.columns)
    files = catalog.manifest(catalog.read_shards(spark, base, "p"), F.current_timestamp())
    assert {r.run_seq: r.rows for r in catalog.manifest_summary(files).collect()} == {1: 2, 2: 1, 3: 2}
    plan = catalog.read_shards(spark, base, "p")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(provider" in plan


def test_latest_view_does_not_move_wide_rows(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "b")
    for run in (1, 2, 3):
        rows = [(str(i), f"t{run}", "2026-08-14", "p", run, i) for i in range(40) if i % run == 0]
        # Row 0 is stored twice in every run with nothing to tell the copies apart.
        catalog.append_catalog(record(spark, [*rows, rows[0]]).repartition(3), base)
    view = catalog.latest_shards(spark, base)
    got = {r.source_id: r.title for r in view.collect()}
    assert view.count() == 40 == len(got)
    assert got == {str(i): "t3" if i % 3 == 0 else "t2" if i % 2 == 0 else "t1" for i in range(40)}
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(book_uid" in plan.split("BroadcastHashJoin")[1]
    assert "SortMergeJoin" not in plan and "Window" not in plan
    monkeypatch.setattr(session, "BROADCAST_ROWS", 3)
    ranked = catalog.latest_shards(spark, base)
    assert "Window" in ranked._jdf.queryExecution().executedPlan().toString()
    assert {r.source_id: r.title for r in ranked.collect()} == got and ranked.count() == 40


def test_rows_per_file(spark, tmp_path):
    rows = [(str(i), "t", "2026-08-14", "p", 1, i) for i in range(12)]
    base = str(tmp_path / "b")
    catalog.append_catalog(record(spark, rows).coalesce(1), base, rows_per_file=5)
    files = catalog.manifest(catalog.read_shards(spark, base), F.current_timestamp())
    assert sorted(r.rows for r in files.collect()) == [2, 5, 5]


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    base = str(tmp_path / "b")
    for _ in range(2):
        catalog.append_catalog(record(spark, [("1", "t", "2026-08-14", "p", 1, 1)]), base)
        catalog.append_catalog(record(spark, [("1", "t", "2026-08-14", "p", 2, 1)]), base)
    assert catalog.read_shards(spark, base).count() == 2


def test_flat_sources(spark, tmp_path):
    one, two = str(tmp_path / "books_aa.parquet"), str(tmp_path / "books_bb.parquet")
    spark.range(2).write.parquet(one)
    spark.range(2).withColumn("source", F.lit("own")).write.parquet(two)
    got = [f.select("source").distinct().first()[0] for f in sources.read_flat_sources(spark, [two, one])]
    assert got == ["aa", "own"]
