"""The state table: read and rewritten in part, and derived anew whenever it may be behind."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_run import FIRST, OPTIONS, catalog, one, openings, shelf

from tomeworks.plans import job, state
from tomeworks.plans.job import run
from tomeworks.plans.state import STATE, State
from tomeworks.schema import STORED, conform


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "base")


@pytest.fixture
def landed(spark, land):
    return land.listing(shelf(60), page_size=20).texts(spark, openings(50))


def files(base):
    """Data files of every slot with their times."""
    out = {}
    for folder, _, names in os.walk(f"{base}/_state"):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(folder.rsplit("=", 1)[1], set()).add((n, os.stat(f"{folder}/{n}").st_mtime_ns))
    return out


def table_rows(frame):
    return sorted(tuple(r) for r in frame.select(*STATE.names[:-1]).collect())


def agrees(spark, base, seq=1 << 40):
    """The table holds what the shards say."""
    seen = State(spark, base, "gutenberg", "download_count", seq, dry_run=True)
    assert seen.table is not None
    assert table_rows(seen.rows()) == table_rows(seen._from_shards())
    return seen


def closed(*_, **__):
    raise AssertionError("a shard was opened")


def test_a_small_run_opens_no_shard_and_touches_its_slots_alone(spark, base, landed, monkeypatch):
    one(spark, base, landed, text_cap=None)
    before = files(base)
    assert len(before) == state.LEAST_SLOTS
    landed.listing(shelf(62), page_size=20, only={3, 4})
    with monkeypatch.context() as patched:
        patched.setattr(job, "read_shards", closed)
        patched.setattr(state, "read_shards", closed)
        report = one(spark, base, landed)
    assert (report.new_records, report.unchanged_records, report.rows_written, report.text_pending) == (2, 20, 2, 12)
    ids = spark.createDataFrame([(str(FIRST + 60),), (str(FIRST + 61),)], "source_id string")
    touched = {str(r[0]) for r in ids.select(state.slot_of("source_id", state.LEAST_SLOTS)).collect()}
    after = files(base)
    assert {s for s in after if after[s] != before[s]} == touched and len(touched) < state.LEAST_SLOTS
    agrees(spark, base)


def test_records_join_by_their_buckets(spark, base, landed):
    one(spark, base, landed)
    seen = agrees(spark, base)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(5).select((F.col("id") + FIRST).cast("string").alias("source_id"))
        plan = ids.join(seen.near(ids), "source_id", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "PartitionFilters: [isnotnull(slot" in plan.replace(
        "PartitionFilters: [slot", "PartitionFilters: [isnotnull(slot"
    )


def test_a_table_that_is_lost_or_behind_is_derived_anew(spark, base, landed, monkeypatch):
    one(spark, base, landed, text_cap=7)
    landed.listing(shelf(60, {3, 40}), page_size=20)

    def die(*_, **__):
        raise RuntimeError("executor lost")

    # the run stores its rows and dies before the table has them
    with monkeypatch.context() as patched:
        patched.setattr(State, "update", die)
        with pytest.raises(RuntimeError):
            one(spark, base, landed, mode="full")
    assert one(spark, base, landed, mode="full").unchanged_records == 60
    agrees(spark, base)
    # it dies between opening and closing its mark
    landed.listing(shelf(60, {3, 40, 41}), page_size=20)
    with monkeypatch.context() as patched:
        patched.setattr(State, "_put", die)
        with pytest.raises(RuntimeError):
            one(spark, base, landed, mode="full")
    report = one(spark, base, landed, mode="full")
    assert (report.changed_records, report.unchanged_records) == (0, 60)
    agrees(spark, base)
    # marks are all there is of it
    state.remove(spark, f"{base}/_state_marks")
    assert one(spark, base, landed, mode="full").unchanged_records == 60
    agrees(spark, base)


def test_a_repeated_run_leaves_the_table_to_the_next(spark, base, landed):
    first = run(spark, base, landed.root, options=OPTIONS, run_id="first")[0]
    landed.listing(shelf(60, {1}), page_size=20)
    one(spark, base, landed, mode="full")
    again = run(spark, base, landed.root, options=OPTIONS, run_id="first")[0]
    assert (again.run_seq, again.new_records) == (first.run_seq, first.new_records) == (1, 60)
    assert one(spark, base, landed, mode="full").unchanged_records == 60
    agrees(spark, base)
    assert catalog(spark, base)[1].title == "Renamed no. 1"


def test_the_layout_grows_and_another_priority_is_taken(spark, base, landed, monkeypatch):
    monkeypatch.setattr(state, "FILE_ROWS", 1)
    monkeypatch.setattr(state, "GROWTH", 3)
    one(spark, base, landed)
    landed.listing(shelf(66), page_size=22)
    assert one(spark, base, landed, mode="full").new_records == 6
    assert one(spark, base, landed).unchanged_records == 22  # 60 records outgrew 16 files
    seen = agrees(spark, base)
    assert seen.slots * seen.buckets >= 64
    assert one(spark, base, landed, priority="text_char_count").unchanged_records == 22
    seen = State(spark, base, "gutenberg", "text_char_count", 1 << 40, dry_run=True)
    assert {r.wanted for r in seen.rows().where("not owes").collect()} <= {12, 13}
    monkeypatch.undo()
    assert state.layout(0) == (8, 2) and state.layout(10**10) == (8, 4096) and state.layout(10**11) == (64, 4096)


def test_random_histories_agree_with_the_shards(spark, base, land):
    rng = random.Random(5)
    land.texts(spark, openings(3))
    for size in (5, 9, 9, 14):
        land.listing(shelf(size, {rng.randrange(size) for _ in range(3)}, f"Word {rng.random()}"), page_size=4)
        if rng.random() < 0.6:
            land.texts(spark, {FIRST + rng.randrange(size): "late text"})
        one(spark, base, land, mode=rng.choice(["full", "incremental"]), text_cap=rng.choice([2, None]))
        agrees(spark, base)


def test_rows_of_an_update_older_than_the_table_lose(spark, base, landed):
    one(spark, base, landed)
    seen = agrees(spark, base, seq=7)
    stale = spark.sql(
        f"select '{FIRST}' source_id, 'other' content_hash, timestamp'2001-01-01' ingested_at, 6L run_seq, 1L row_seq"
    )
    seen.update(conform(stale, STORED), 0)
    assert seen.rows().where(f"source_id = '{FIRST}'").first().content_hash != "other"
