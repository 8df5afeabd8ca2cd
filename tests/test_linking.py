"""Works by linked identifiers, against a plain union of sets."""

import random

import pytest
from pyspark.sql import functions as F

from tomeworks.operators import linking, works


def brute(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    by_link = {}
    for node, link in pairs:
        if node is None or link is None:
            continue
        find(node)
        if link in by_link:
            a, b = sorted((find(node), find(by_link[link])))
            root[b] = a
        by_link[link] = node
    return {x: find(x) for x in root}


def roots(spark, pairs, kind="long", **options):
    df = spark.createDataFrame(pairs, f"node {kind}, link string")
    got = linking.linked(df, **options).collect()
    assert len({r.node for r in got}) == len(got)
    return {r.node: r.root for r in got}


@pytest.mark.parametrize("min_rows", [5_000_000, 3])
def test_any_shape(spark, min_rows):
    """A long chain, a hub with half of all rows, loose rows, repeats; hot links and nodes spread or not."""
    rng = random.Random(2)
    chain = [(i, f"c{i // 2 + k}") for i in range(0, 120, 2) for k in (0, 1)]
    hub = [(1000 + i, "hub") for i in range(150)] + [(1007, f"spoke{i}") for i in range(40)] + [(2000 + i, f"spoke{i}") for i in range(40)]
    loose = [(3000 + i, f"l{rng.randrange(40)}") for i in range(60)] + [(9, None), (None, "hub"), (5000, "alone"), (5000, "alone")]
    pairs = chain + hub + loose
    rng.shuffle(pairs)
    assert roots(spark, pairs, min_rows=min_rows) == brute(pairs)


def test_texts_as_nodes_and_nothing_at_all(spark):
    assert roots(spark, [("b", "x"), ("a", "x"), ("c", "y")], "string") == {"a": "a", "b": "a", "c": "c"}
    assert roots(spark, []) == {}


def test_works_fold_over_any_shared_number(spark):
    rows = [
        ("v1", "12,34", "A", "x"), ("v2", "34, 56", "B", "x"), ("v3", "56", "C", "x"), ("v4", None, "  c ", "X"),
        ("v5", "", "Only", ""), ("v6", None, None, None), ("v7", " , ", "", ""), ("v8", "99", "only ", None), (None, "12", "A", "x"),
    ]
    volumes = spark.createDataFrame(rows, "htid string, oclc_num string, title string, author string")
    got = {r.htid: r.work_id for r in works.with_work(volumes).collect()}
    assert got == {**dict.fromkeys(("v1", "v2", "v3", "v4"), "v1"), "v5": "v5", "v8": "v5", "v6": "v6", "v7": "v7", None: None}
    folded = works.collapse_works(works.with_work(volumes.where(F.col("htid").isNotNull())), key="work_id")
    assert {(r.work_id, r.volumes, r.first_id) for r in folded.collect()} == {
        ("v1", 4, "v1"), ("v5", 2, "v5"), ("v6", 1, "v6"), ("v7", 1, "v7")
    }
