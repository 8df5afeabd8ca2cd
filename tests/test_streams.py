"""Streams give what the batch jobs give, and may be delivered again."""

import pytest

from tomeworks import fixed, streaming
from tomeworks.operators.catalog import read_catalog
from tomeworks.plans.job import RunOptions, run
from tomeworks.plans.runlog import read_run_log
from tomeworks.sources import read_shards


def titles(spark, base):
    return {r.source_id: (r.title, r.searchable_text) for r in read_catalog(spark, base).collect()}


def test_stream_equals_batch_and_resumes(spark, land, tmp_path):
    records = [{"id": i, "title": f"Book {i}"} for i in range(1, 6)]
    land.listing(records, page_size=2).texts(spark, {i: f"text {i}" for i in range(1, 6)})
    base, check = str(tmp_path / "s"), str(tmp_path / "c")

    def take(**options):
        streaming.ingest_stream(spark, base, land.root, check, **options).awaitTermination()

    take(max_files=2)
    log = read_run_log(spark, base).collect()
    assert len(log) == 2 and sum(r.new_records for r in log) == 5
    other = str(tmp_path / "b")
    run(spark, other, land.root, options=RunOptions(max_rows=None))
    assert titles(spark, base) == titles(spark, other)

    take()  # nothing has landed
    assert read_run_log(spark, base).count() == 2
    land.listing([*records, {"id": 6, "title": "Book 6"}], page_size=2, only={3})
    take()
    last = read_run_log(spark, base).orderBy("run_seq").collect()[-1]
    assert (last.new_records, last.unchanged_records, last.run_seq) == (1, 1, 3)
    assert read_shards(spark, base).count() == 6


def test_append_stream_replaces_a_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(src)
    for check in ("c1", "c2"):  # a lost checkpoint delivers batch 0 again
        rows = spark.readStream.schema("id long").parquet(src)
        streaming.append_stream(rows, out, str(tmp_path / check)).awaitTermination()
    assert spark.read.parquet(out).count() == 10


@pytest.fixture
def daily(gz):
    def write(day, *rows):
        lines = []
        for htid, rights in rows:
            row = {c: "" for c in fixed.VOLUME_COLUMNS} | {"htid": htid, "rights": rights}
            lines.append("\t".join(row.values()).encode())
        return gz(f"daily/hathi_upd_{day}.txt.gz", lines)

    return write


def test_snapshot_with_deltas_and_rebaseline(spark, daily, tmp_path):
    base, check, landing = str(tmp_path / "b"), str(tmp_path / "c"), str(tmp_path / "daily")

    def state():
        return {r.htid: r.rights for r in streaming.current_snapshot(spark, base).collect()}

    def take():
        streaming.snapshot_stream(spark, landing, base, check).awaitTermination()

    daily("20260801", ("a", "ic"), ("b", "pd"))
    daily("20260802", ("a", "pd"), ("c", "und"))
    take()
    assert state() == {"a": "pd", "b": "pd", "c": "und"}
    streaming.rebaseline(spark, base, "20260802")
    assert state() == {"a": "pd", "b": "pd", "c": "und"}
    daily("20260803", ("a", "ic"))
    take()
    assert state() == {"a": "ic", "b": "pd", "c": "und"}
    full = streaming.current_snapshot(spark, base).where("htid <> 'b'").select(*fixed.VOLUME_COLUMNS)
    streaming.rebaseline(spark, base, "20260901", full)
    assert state() == {"a": "ic", "c": "und"}
