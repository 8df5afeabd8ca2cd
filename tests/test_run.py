"""End-to-end scenarios of the incremental run."""

import json
import os
from dataclasses import replace
from datetime import datetime, timezone

import pytest

from tomeworks.operators.catalog import catalog_state, latest_shards, manifest_summary, read_catalog
from tomeworks import session
from tomeworks.plans import job
from tomeworks.plans.job import RunOptions, ingest, run
from tomeworks.plans.runlog import read_run_log
from tomeworks.sources import read_shards
from tomeworks.sources.listing import PAGES

OPTIONS = RunOptions(max_rows=400, budget=60, text_cap=40, rows_per_file=3)
FIRST = 31


def shelf(size, retitled=(), word="Renamed"):
    """``size`` listed works, the later ones wanted less; the places in ``retitled`` have a new name."""
    return [
        {"id": FIRST + i, "title": f"{word if i in retitled else 'Tome'} no. {i}", "download_count": 900 - 7 * i}
        for i in range(size)
    ]


def openings(size):
    return {FIRST + i: f"{i} opens here" for i in range(size)}


def catalog(spark, base):
    rows = read_catalog(spark, base).collect()
    assert len({r.book_uid for r in rows}) == len(rows)
    return {int(r.source_id) - FIRST: r for r in rows}


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "base")


@pytest.fixture
def landed(spark, land):
    """Seven works on pages of three: 3, 3 and 1."""
    return land.listing(shelf(7), page_size=3).texts(spark, openings(7))


def one(spark, base, landed, **changes):
    return run(spark, base, landed.root, options=replace(OPTIONS, **changes))[0]


def test_a_second_run_only_adds_what_is_new(spark, base, landed):
    reports = [one(spark, base, landed), one(spark, base, landed)]
    landed.listing(shelf(9), page_size=3, only={3}).texts(spark, {FIRST + 8: "8 opens here"})
    reports.append(one(spark, base, landed))
    log = read_run_log(spark, base).orderBy("run_seq").collect()
    assert [(r.new_records, r.unchanged_records, r.rows_written, r.text_fetched) for r in log] == [
        (7, 0, 7, 7), (0, 1, 0, 0), (2, 1, 2, 1)
    ]
    assert [(r.last_page, r.pages_read, r.text_pending) for r in reports] == [(3, 3, 0), (3, 1, 0), (3, 1, 1)]
    assert [r.as_row(spark).first().stopped_reason for r in reports] == ["completed"] * 3
    got = catalog(spark, base)
    assert {i: r.searchable_text for i, r in got.items()} == {i: f"{i} opens here" for i in (*range(7), 8)} | {7: None}
    assert {r.text_source for i, r in got.items() if i != 7} == {"first_chars"}
    state = catalog_state(latest_shards(spark, base)).first()
    assert (state.total_records, state.max_id_seen) == (9, FIRST + 8)
    files = manifest_summary(spark.read.parquet(f"{base}/_manifest")).collect()
    assert sum(f.rows for f in files) == 9


def test_only_a_full_run_sees_changes_on_early_pages(spark, base, landed):
    one(spark, base, landed)
    landed.listing(shelf(7, {0, 4}), page_size=3)
    assert one(spark, base, landed).changed_records == 0
    report = one(spark, base, landed, mode="full")
    assert (report.changed_records, report.unchanged_records, report.rows_written) == (2, 5, 2)
    assert {i for i, r in catalog(spark, base).items() if r.title.startswith("Renamed")} == {0, 4}


def test_page_limit_then_the_rest(spark, base, landed):
    first = one(spark, base, landed, budget=2)
    assert (first.new_records, first.text_fetched, first.last_page) == (6, 0, 2)
    assert "page limit 2" in first.stopped_reason
    second = one(spark, base, landed)
    assert (second.new_records, second.unchanged_records, second.text_fetched) == (1, 3, 7)
    got = catalog(spark, base)
    assert len(got) == 7 and all(r.searchable_text for r in got.values())
    # Text that arrives later does not move the time a record was listed.
    seen = {r.source_id: r.ingested_at for r in read_shards(spark, base).where("run_seq = 1").collect()}
    assert got[5].ingested_at == seen[str(FIRST + 5)]


def test_row_limit_ends_on_a_whole_page(spark, base, landed):
    first = one(spark, base, landed, max_rows=4, stages=("metadata",))
    assert (first.new_records, first.last_page) == (6, 2) and "row limit 4 on page 2" in first.stopped_reason
    second = one(spark, base, landed, max_rows=4, stages=("metadata",))
    assert (second.new_records, second.unchanged_records, second.last_page) == (1, 3, 3)
    assert sorted(catalog(spark, base)) == list(range(7))


def test_without_limits_all_is_taken(spark, base, land):
    land.listing(shelf(1200), page_size=400)
    assert run(spark, base, land.root)[0].new_records == 1200


def test_text_goes_to_the_most_wanted(spark, base, land):
    land.listing(shelf(7), page_size=3).texts(spark, {**openings(7), FIRST + 2: " \n "})
    report = one(spark, base, land, text_cap=3)
    # The blank text of a wanted work leaves that work as it is.
    assert (report.text_fetched, report.text_pending) == (2, 5) and "text limit 3" in report.stopped_reason
    assert {i for i, r in catalog(spark, base).items() if r.searchable_text} == {0, 1}
    later = one(spark, base, land)
    assert (later.text_fetched, later.text_pending, later.rows_written) == (4, 1, 4)
    got = catalog(spark, base)
    assert [i for i, r in got.items() if not r.searchable_text] == [2] and got[2].text_source == "none"


def test_dry_run_leaves_no_trace(spark, base, landed):
    report = one(spark, base, landed, dry_run=True)
    assert report.new_records == 7 and "nothing stored" in report.stopped_reason
    assert not os.path.exists(base)


def test_stages_by_themselves(spark, base, landed):
    report = one(spark, base, landed, stages=("metadata",))
    assert (report.new_records, report.text_fetched) == (7, 0)
    assert all(r.searchable_text is None for r in catalog(spark, base).values())
    later = one(spark, base, landed, stages=("text",))
    assert (later.new_records, later.text_fetched) == (0, 7)


def pages(spark, *rows):
    body = [(p, r, json.dumps({"next": "x", "results": [{"id": i, "title": t} for i, t in found]})) for p, r, found in rows]
    return spark.createDataFrame([("gutenberg", *x) for x in body], PAGES)


def test_pages_fetched_again_count_once(spark, base):
    """The newest fetch of a page alone is taken, however often it was delivered."""
    table = pages(
        spark, (1, 1, [(FIRST, "a"), (FIRST + 1, "b")]), (1, 2, [(FIRST + 2, "c"), (FIRST, "a2")]),
        (1, 2, [(FIRST + 2, "c"), (FIRST, "a2")]), (2, 1, [(FIRST + 3, "d")]),
    )
    report = ingest(spark, base, table, "gutenberg", RunOptions(), "r1", datetime(2026, 1, 1, tzinfo=timezone.utc))
    assert (report.new_records, report.rows_written) == (3, 3)
    assert {i: r.title for i, r in catalog(spark, base).items()} == {0: "a2", 2: "c", 3: "d"}


def test_broken_page_is_set_aside_and_passed(spark, base, land):
    land.listing(shelf(9), page_size=3)
    folder = f"{land.root}/listing/provider=gutenberg"
    with open(f"{folder}/page-000002.run-1.json") as page:
        half = page.read()[:60]
    with open(f"{folder}/page-000002.run-2.json", "w") as page:
        page.write(half)
    report = one(spark, base, land, stages=("metadata",))
    assert (report.new_records, report.quarantined, report.last_page) == (6, 1, 3)


def test_page_without_run_in_its_name(spark, base, land):
    land.listing(shelf(2), page_size=2)
    folder = f"{land.root}/listing/provider=gutenberg"
    os.rename(f"{folder}/page-000001.run-1.json", f"{folder}/page-000001.json")
    assert one(spark, base, land, stages=("metadata",)).new_records == 2
    with open(f"{folder}/page-one.json", "w") as page:
        page.write("{}")
    with pytest.raises(Exception, match="not the name of a page"):
        one(spark, base, land, mode="full", stages=("metadata",))


def test_malformed_records_are_set_aside(spark, base, land):
    bad = [{"title": "no id"}, {"id": 9, "title": "x", "authors": [{"name": None}]}, {"id": 8, "title": 5}, "junk"]
    land.listing([*shelf(4), *bad], page_size=5)
    report = one(spark, base, land)
    assert (report.new_records, report.quarantined, report.last_page) == (4, 4, 2)
    aside = spark.read.parquet(f"{base}/quarantine").orderBy("page", "pos").collect()
    assert [(r.page, r.pos) for r in aside] == [(1, 4), (2, 0), (2, 1), (2, 2)]
    assert [json.loads(r.raw) for r in aside[:3]] == bad[:3]


def test_same_id_twice_in_one_run_is_stored_once(spark, base, land):
    land.listing([*shelf(3), {"id": FIRST + 1, "title": "a later copy"}], page_size=3)
    report = one(spark, base, land)
    assert (report.new_records, report.rows_written) == (4, 3)
    assert catalog(spark, base)[1].title == "a later copy"


def test_run_delivered_twice_lands_once(spark, base, landed):
    for _ in range(2):
        report = run(spark, base, landed.root, options=OPTIONS, run_id="same")[0]
        assert (report.run_seq, report.new_records, report.rows_written) == (1, 7, 7)
    assert read_shards(spark, base).count() == 7
    assert read_run_log(spark, base).count() == 1


def test_run_that_died_is_repeated_whole(spark, base, landed, monkeypatch):
    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patched:
        patched.setattr(job, "write_report", die)
        with pytest.raises(RuntimeError):
            run(spark, base, landed.root, options=OPTIONS, run_id="first")
    # Another run comes between and may not take the number of the one that died.
    between = one(spark, base, landed)
    assert (between.run_seq, between.unchanged_records, between.rows_written) == (2, 7, 0)
    again = run(spark, base, landed.root, options=OPTIONS, run_id="first")[0]
    assert (again.run_seq, again.new_records, again.rows_written) == (1, 7, 7)
    assert len(catalog(spark, base)) == 7 and read_shards(spark, base).count() == 7


def test_without_any_broadcast(spark, base, landed, monkeypatch):
    """Batches too large to broadcast take the shuffling joins, with the same result."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(job, "_BROADCAST_PREVIEWS", 0)
    first = one(spark, base, landed, text_cap=1)
    assert (first.new_records, first.text_fetched, first.text_pending) == (7, 1, 6)
    landed.listing(shelf(7, {5}), page_size=3)
    second = one(spark, base, landed, mode="full")
    assert (second.changed_records, second.text_fetched, second.rows_written) == (1, 6, 6)
    got = catalog(spark, base)
    assert got[5].title == "Renamed no. 5" and all(r.searchable_text for r in got.values())


def test_changed_record_without_text(spark, base, landed):
    one(spark, base, landed)
    landed.listing(shelf(7, {2}), page_size=3)
    one(spark, base, landed, mode="full", stages=("metadata",))
    assert catalog(spark, base)[2].searchable_text is None
    landed.listing(shelf(7, {2, 3}, "Recast"), page_size=3)
    one(spark, base, landed, mode="full", stages=("metadata",), carry_text=True)
    got = catalog(spark, base)
    assert got[3].searchable_text == "3 opens here" and got[3].title == "Recast no. 3"
    assert got[2].searchable_text is None and got[2].title == "Recast no. 2"


def test_unknown_provider(spark, base, landed):
    with pytest.raises(ValueError, match="nowhere"):
        run(spark, base, landed.root, providers=("nowhere",))


def test_a_page_still_to_land_is_waited_for(spark, base, land):
    land.listing(shelf(8), page_size=3, only={1, 3})
    first = one(spark, base, land, stages=("metadata",))
    assert (first.new_records, first.last_page) == (3, 1) and "awaiting page 2" in first.stopped_reason
    land.listing(shelf(8), page_size=3, only={2})
    second = one(spark, base, land, stages=("metadata",))
    assert (second.new_records, second.last_page) == (5, 3)


def test_providers_side_by_side(spark, base, land):
    from conftest import Landing
    from tomeworks.plans.providers import listing_provider, register

    register(listing_provider("second"))
    Landing(land.root, "second").listing(shelf(2, {0}), page_size=3)
    reports = run(spark, base, land.root, ("gutenberg", "second"), OPTIONS)
    assert [(r.provider, r.new_records) for r in reports] == [("gutenberg", 0), ("second", 2)]
    land.listing(shelf(3), page_size=3)
    reports = run(spark, base, land.root, ("gutenberg", "second"), OPTIONS)
    assert [(r.new_records, r.unchanged_records) for r in reports] == [(3, 0), (0, 2)]
    uids = {r.book_uid for r in read_catalog(spark, base).collect()}
    assert uids == {f"gutenberg:{FIRST + i}" for i in range(3)} | {f"second:{FIRST + i}" for i in range(2)}


def test_pages_behind_the_end_are_not_read(spark, base, land):
    land.listing(shelf(8), page_size=3)
    land.listing(shelf(4), page_size=3)  # the listing shrank: page 2 is now the last
    assert one(spark, base, land, stages=("metadata",)).last_page == 2
    assert set(catalog(spark, base)) == {0, 1, 2, 3}
