import math
import random

from pyspark.sql import functions as F

from tomeworks.llm import topk


def by_hand(rows, k=10):
    good = [
        (i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i % 5 == 0}:
        found = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def search(spark, rows):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0).collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        # long and short vectors, and near copies, so that all three ways of pruning are taken
        scale = rnd.choice([0.1, 1, 1, 4])
        v = [rnd.gauss(0, scale) for _ in range(6)]
        if i % 3 == 0 and i:
            v = [x + rnd.gauss(0, 0.02) for x in rows[rnd.randrange(i)][1]]
        rows.append((i, v))
    assert search(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
        (6, [-1.0, 0.0]), (7, [0.0, 0.0]), (10, [0.0, 0.0]), (15, [1.0, 1.0, 1.0]), (20, []), (None, [1.0, 1.0]),
    ]
    assert search(spark, rows) == by_hand(rows)
    assert search(spark, []) == [] and search(spark, [(1, [1.0])]) == []
