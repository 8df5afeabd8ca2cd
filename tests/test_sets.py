"""Snapshots, works, search, vectors and profiles on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tomeworks.operators import changes, enrich, profile, search, snapshots, vectors, works


def snap(spark, rows):
    return spark.createDataFrame(rows, "htid string, rights string")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_snapshot_differences(spark):
    old = snap(spark, [("a", "ic"), ("b", "pd"), ("c", None), ("d", "und"), ("e", "pd")])
    new = snap(spark, [("a", "pd"), ("b", "pd"), ("c", None), ("e", "ic"), ("f", "pd")])
    diff = snapshots.snapshot_diff(old, new, ["rights"])
    assert got(diff) == [
        ("a", "changed", "ic", "pd"), ("b", "same", "pd", "pd"), ("c", "same", None, None),
        ("d", "removed", "und", None), ("e", "changed", "pd", "ic"), ("f", "added", None, "pd"),
    ]
    assert got(snapshots.missing_ids(old, new)) == [("d",)]
    moves = snapshots.transitions(old, new, "rights")
    assert got(moves) == [("ic", "pd", 1), ("pd", "ic", 1)]
    assert got(snapshots.public_domain_flow(moves)) == [("entering", 1), ("leaving", 1)]
    assert got(snapshots.delta_share(old, new)) == [("modified", 4, 8000), ("new", 1, 2000)]
    # Order of rows has no say.
    assert got(snapshots.snapshot_diff(old.orderBy(F.desc("htid")), new, ["rights"])) == got(diff)


def test_deltas_upsert(spark):
    schema = "htid string, rights string, day int"
    base = spark.createDataFrame([("a", "ic", 1), ("b", "pd", 1)], schema)
    delta = spark.createDataFrame([("a", "pd", 2), ("c", "und", 2), ("c", "pd", 3)], schema)
    assert got(snapshots.apply_deltas(base, delta, ["day"])) == [("a", "pd", 2), ("b", "pd", 1), ("c", "pd", 3)]


def test_delta_gaps(spark):
    days = spark.createDataFrame([("2026-08-01",), ("2026-08-02",), ("2026-08-02",), ("2026-08-06",)], "file_date string")
    assert [(str(r.before), str(r.after), r.missing_days) for r in snapshots.delta_gaps(days).collect()] == [
        ("2026-08-02", "2026-08-06", 3)
    ]


def test_works(spark):
    df = spark.createDataFrame(
        [("v1", "77", "T", "A"), ("v2", "77", "Other", "B"), ("v3", "", " The\xa0 Title ", "AUTHOR"), ("v4", None, "the title", "author"), ("v5", "", "x", "y")],
        "htid string, oclc_num string, title string, author string",
    )
    keyed = works.with_work_key(df)
    assert got(works.collapse_works(keyed).select("volumes", "first_id")) == [(1, "v5"), (2, "v1"), (2, "v3")]
    known = keyed.where("htid IN ('v1', 'v4')")
    for min_rows in (0, 10**9):
        left = works.drop_known(keyed, known, min_rows=min_rows)
        assert [r.htid for r in left.collect()] == ["v5"]


def test_search(spark):
    one = spark.createDataFrame([("g", 1, "Emma", "Austen", 5)], "source string, id int, title string, authors string, download_count int")
    two = spark.createDataFrame([("h", "x", "Walden", "Thoreau", "Boston")], "source string, id string, title string, authors string, publisher string")
    merged = search.union_sources([one.withColumn("subjects", F.lit("Novels")), two])
    found = lambda q, s="all": [r.uid for r in search.search(merged, q, s).orderBy("uid").collect()]
    assert found("AUSTEN") == ["g:1"] and found("bos") == ["h:x"] and found("") == ["g:1", "h:x"]
    assert found("", "h") == ["h:x"] and found("novels", "h") == []
    assert search.lookup(merged, "g:1").count() == 1
    assert got(profile.counts(merged, "source", total=True)) == [("g", 1, False), ("h", 1, False), (None, 2, True)]
    numbers = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert got(search.nan_to_null(numbers)) == [(1.0,), (None,), (None,)]


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    data, asked = rng.normal(size=(300, 8)), rng.normal(size=(4, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(asked)], "query_id string, embedding array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    order = np.argsort(-(unit(asked) @ unit(data).T), axis=1)[:, :7]
    want = sorted((f"q{q}", int(order[q, p]), p + 1) for q in range(4) for p in range(7))
    assert sorted(map(tuple, vectors.nearest(df, queries, 7).collect())) == want
    assert vectors.nearest(df, queries.limit(0), 7).count() == 0
    joined = search.join_vectors(spark.createDataFrame([("u", 3)], "book_uid string, vec_id long"), df.withColumn("book_uid", F.lit("u")).where("vec_id = 3"), "book_uid")
    assert joined.count() == 1


def test_queries_in_several_blocks(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [float(i), 9.0]) for i in range(1, 8)], "vec_id int, embedding array<double>")
    queries = rows.withColumnRenamed("vec_id", "query_id")
    whole = sorted(map(tuple, vectors.nearest(rows, queries, 2).collect()))
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 3)
    assert sorted(map(tuple, vectors.nearest(rows, queries, 2).collect())) == whole and len(whole) == 14


def test_vectors_that_cannot_be_compared(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id int, embedding array<double>")
    for bad in ([0.0, 0.0], None, [float("nan"), 1.0]):
        queries = spark.createDataFrame([(1, bad)], "query_id int, embedding array<double>")
        with pytest.raises(ValueError):
            vectors.nearest(rows, queries, 1)
    queries = spark.createDataFrame([(1, [1.0])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="length"):
        vectors.nearest(rows, queries, 1).collect()


def test_classify(spark):
    incoming = spark.createDataFrame([("p", "1", "a", 1), ("p", "2", "b", 2), ("p", "3", "c", 3), ("p", "3", "d", 4)], "provider string, source_id string, content_hash string, pos int")
    known = spark.createDataFrame([("p", "2", "x"), ("p", "3", "c")], "provider string, source_id string, content_hash string")
    want = [(1, "new"), (2, "changed"), (3, "unchanged"), (4, "changed")]
    for options in ({}, {"spread_by": ["pos"], "min_rows": 1}):
        assert got(changes.classify_changes(incoming, known, **options).select("pos", "status")) == want
    counted = profile.status_counts(changes.classify_changes(incoming, known)).first()
    assert tuple(counted) == (1, 2, 1)


def test_back_and_forth_counts_twice(spark):
    rows = [("u", 1, "A"), ("u", 2, "B"), ("u", 3, "A"), ("u", 4, "A")]
    df = spark.createDataFrame(rows, "uid string, run int, content_hash string")
    seq = changes.change_sequence(df, ["uid"], ["run"]).orderBy("run").collect()
    assert [r.status for r in seq] == ["new", "changed", "changed", "unchanged"]


def test_previews(spark):
    texts = spark.createDataFrame([("1", " Hello "), ("2", "   "), ("1", " Hello "), ("9", "x")], "source_id string, text string")
    chosen = spark.createDataFrame([("1",), ("2",), ("3",)], "source_id string")
    for at_most in (None, 3):
        previews = enrich.fetch_previews(chosen, texts, 3, ["source_id"], at_most)
        assert got(previews) == [("1", "Hel")]
    full = spark.createDataFrame([("  *** START OF THE PROJECT GUTENBERG EBOOK X ***  ab",), ("  cd",)], "text string")
    assert got(enrich.display_text(full, 1)) == [(" ", 4, 1), ("a", 2, 1)]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "k string, v int")
    assert got(profile.shares(df, "k")) == [("a", 2, 6666), ("b", 1, 3333)]
    assert got(profile.coverage(df)) == [("k", 3, 3, 10000), ("v", 3, 2, 6666)]
    assert tuple(profile.shape(df).first()) == (3, 2)
    assert tuple(profile.scan_counters(df, F.col("k") == "a").first()) == (3, 2)
    assert got(profile.coverage(df.limit(0), ["k"])) == [("k", 0, 0, None)]
    ids = spark.createDataFrame([("g", 1, 5), ("g", 2, 7), ("g", 3, 6), ("h", 1, 1)], "src string, pos int, id int")
    assert tuple(profile.out_of_order(ids, ["src"], ["pos"], F.col("id")).first()) == (4, 1)
    raw = spark.createDataFrame([("p", 1, '{"id":1,"a":"x"}'), ("p", 1, '{"id":2}'), ("p", 2, '{"id":3}')], "provider string, page int, raw string")
    assert got(profile.page_profile(raw, 2)) == [("p", 1, 2, False), ("p", 2, 1, True)]
    assert profile.observed_fields(raw).first().shape == "OBJECT<a: STRING, id: BIGINT>"
