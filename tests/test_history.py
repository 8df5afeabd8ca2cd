"""Histories, versions of a snapshot and the search index, against plain walks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tomeworks import streaming
from tomeworks.operators import history, search, search_index
from tomeworks.streaming import append_deltas, current_snapshot, mark_removed, rebaseline, versions


def walk(changes):
    """Intervals of every key, by walking its changes."""
    out = {}
    for key, at, tie, value in sorted(changes, key=lambda c: (c[0], c[1], c[2])):
        held = out.setdefault(key, {})
        held[at] = value
    rows = []
    for key, held in out.items():
        open_ = None
        for at in sorted(held):
            if open_ is None or held[at] != open_[1]:
                if open_ is not None and open_[1] is not None:
                    rows.append((key, open_[1], open_[0], at))
                open_ = (at, held[at])
        if open_[1] is not None:
            rows.append((key, open_[1], open_[0], None))
    return sorted(rows, key=str)


@pytest.mark.parametrize("min_rows", [5_000_000, 20])
def test_validity_and_values(spark, min_rows):
    """Ordinary keys and one with a third of all rows; ties, repeats, removals."""
    rng = random.Random(4)
    changes = [(rng.choice([1, 1, 1, *range(2, 9)]), rng.randrange(60), rng.randrange(9), rng.choice(["a", "b", None])) for _ in range(300)]
    changes = list({(k, at, tie): (k, at, tie, v) for k, at, tie, v in changes}.values())
    df = spark.createDataFrame([*changes, (None, 3, 0, "a"), (2, None, 0, "a")], "k long, day int, tie int, rights string")
    held = history.validity(df.repartition(5), "k", "day", "rights", ["tie"], min_rows)
    want = walk(changes)
    assert sorted(((r.k, r.rights, r.since, r.until) for r in held.collect()), key=str) == want

    asked = [(i, rng.choice([1, 1, 2, 5, 77, None]), rng.choice([*range(-2, 64), None])) for i in range(200)]
    got = history.value_at(spark.createDataFrame(asked, "row long, k long, on int"), held, "k", "on", "rights", min_rows)
    assert got.columns == ["row", "k", "on", "rights"]
    for r in got.collect():
        fits = [v for k, v, a, b in want if None not in (r.k, r.on) and k == r.k and a <= r.on and (b is None or r.on < b)]
        assert [r.rights] == (fits or [None])
    assert got.count() == 200
    moves = {(r.old_value, r.new_value): r.rows for r in history.moves_between(held, "k", "rights", 10, 40).collect()}
    at = lambda d: {k: v for k, v, a, b in want if a <= d and (b is None or d < b)}
    first, second = at(10), at(40)
    count = {}
    for k in first.keys() | second.keys():
        pair = (first.get(k), second.get(k))
        if pair[0] != pair[1]:
            count[pair] = count.get(pair, 0) + 1
    assert moves == count


def state(df):
    return {r.htid: r.rights for r in df.collect()}


def deltas(spark, base, date, **rights):
    rows = [(h, r, date, "daily") for h, r in rights.items()]
    append_deltas(spark.createDataFrame(rows, "htid string, rights string, file_date string, file string"), base)


def test_removed_volumes_go_and_come_back(spark, tmp_path):
    base = str(tmp_path)
    deltas(spark, base, "20260101", a="ic", b="pd", c="pd")
    gone = spark.createDataFrame([("a", "20260102"), ("b", "20260102"), ("b", "20260102"), ("x", "20260103")], "htid string, file_date string")
    mark_removed(gone, base)
    deltas(spark, base, "20260102", a="pd")
    assert state(current_snapshot(spark, base)) == {"c": "pd"}  # on one date the mark wins
    deltas(spark, base, "20260103", a="und")
    assert state(current_snapshot(spark, base)) == {"a": "und", "c": "pd"}
    rebaseline(spark, base, "20260103")
    assert state(current_snapshot(spark, base)) == {"a": "und", "c": "pd"}
    deltas(spark, base, "20260104", b="ic")
    assert state(current_snapshot(spark, base)) == {"a": "und", "b": "ic", "c": "pd"}


def test_a_reader_keeps_its_version_while_others_are_written(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    deltas(spark, base, "20260101", a="ic")
    rebaseline(spark, base, "20260101")
    deltas(spark, base, "20260102", a="pd", b="pd")
    reader = current_snapshot(spark, base)
    rebaseline(spark, base, "20260102")
    assert state(reader) == {"a": "pd", "b": "pd"}
    # a rebaseline that dies before its log row changes nothing for anyone
    with monkeypatch.context() as patched:
        patched.setattr(streaming.snapshots, "_log", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rebaseline(spark, base, "20260103", spark.createDataFrame([("z", "pd")], "htid string, rights string").select(
                "htid", "rights", *[F.lit(None).cast("string").alias(c) for c in streaming.snapshots.fixed.VOLUME_COLUMNS if c not in ("htid", "rights")]
            ))
    assert state(current_snapshot(spark, base)) == {"a": "pd", "b": "pd"}
    assert state(current_snapshot(spark, base, version="20260101", until="20260101")) == {"a": "ic"}
    assert state(current_snapshot(spark, base, version="20260101")) == {"a": "pd", "b": "pd"}


def test_old_versions_are_retired_with_their_deltas(spark, tmp_path):
    base = str(tmp_path)
    for n in range(1, 5):
        deltas(spark, base, f"2026010{n}", **{f"v{n}": "pd"})
        rebaseline(spark, base, f"2026010{n}", keep=2)
    assert sorted(r.version for r in versions(spark, base).collect()) == ["20260103", "20260104"]
    assert len(os.listdir(f"{base}/baselines")) == 2
    assert sorted(d for d in os.listdir(f"{base}/deltas") if "=" in d) == ["file_date=20260104"]
    assert set(state(current_snapshot(spark, base))) == {"v1", "v2", "v3", "v4"}
    with pytest.raises(ValueError, match="20260101"):
        current_snapshot(spark, base, version="20260101")


def books(spark, rows):
    return spark.createDataFrame(rows, "uid string, title string, authors string, subjects string, publisher string, source string")


@pytest.mark.parametrize("pushed", [1000, 1])
def test_the_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch, pushed):
    monkeypatch.setattr(search_index, "IDS_PUSHED", pushed)
    monkeypatch.setattr(search_index, "SLOTS", 4)
    base, rng = str(tmp_path / "i"), random.Random(9)
    word = lambda: "".join(rng.choice("abÄ ") for _ in range(rng.randrange(9)))
    rows = [(str(i), word(), word() if i % 3 else None, word(), "Verlag", rng.choice(["x", "y"])) for i in range(80)]
    renamed = [(u, "new title", *rest) for u, _, *rest in rows[:9]]
    latest = books(spark, renamed + rows[9:])
    empty = books(spark, [])
    assert search_index.search_index(spark, base, "abc").collect() == []
    for part in (rows[:50], rows[50:], [], renamed):
        search_index.add_to_index(books(spark, part) if part else empty, base)
    asked = [("ab", "x"), ("aba", "all"), ("Ä a", "all"), ("VERLAG", "x"), ("new title", "all"), ("zzzz", "all"), ("", "all")]
    for _ in range(2):
        for q, source in asked:
            got = sorted(r.uid for r in search_index.search_index(spark, base, q, source).collect())
            assert got == sorted(r.uid for r in search.search(latest, q, source).collect()), (q, source)
        search_index.merge_index(spark, base)
        asked = [("aba", "all"), ("new title", "all")]
    assert len(os.listdir(f"{base}/data")) == 1


def test_only_slots_of_the_candidates_are_read(spark, tmp_path):
    base = str(tmp_path / "i")
    search_index.add_to_index(books(spark, [(str(i), f"common words {i}", "", "", "", "x") for i in range(300)]), base)
    found = search_index.search_index(spark, base, "words 217")
    assert [r.uid for r in found.collect()] == ["217"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(slot" in plan.replace("isnotnull(slot", "(slot").replace("[slot", "[(slot")


def test_postings_are_gathered_by_gram_and_repeated_ids_count_once(spark, tmp_path):
    base, text = str(tmp_path / "i"), "a😀bc" * 50_000
    rows = [(str(i % 40), "many words 😀x", "", "", "", "x") for i in range(80)] + [("long", text, None, "", "", "x"), ("none", None, None, None, None, "x")]
    search_index.add_to_index(books(spark, rows).coalesce(1), base)
    (place,) = search_index._places(spark, base)
    kept = spark.read.parquet(f"{place}/postings")
    held = {(r.gram, u) for r in kept.collect() for u in r.uids}
    expected = {(b[i : i + 3], u) for u, t, a, *_ in rows for b in [f"{t or ''} {a or ''}  "] for i in range(len(b) - 2)}
    assert held == expected
    shares = kept.groupBy("gram").count().agg({"count": "max"}).first()[0]
    assert shares <= 40  # a row for each share of the texts, not for each record
    assert kept.selectExpr("sum(size(uids))").first()[0] == len(expected)
    for q, ids in (("c" + text[:9], {"long"}), ("S 😀X", {str(i) for i in range(40)})):
        assert {r.uid for r in search_index.search_index(spark, base, q).collect()} == ids
