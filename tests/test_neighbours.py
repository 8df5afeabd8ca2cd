import numpy as np
import pytest
from pyspark.sql import functions as F

from tomeworks.operators import neighbours as nb

SCHEMA = "vec_id long, embedding array<double>, n int, cell string"


def frames(spark, data, asked, parts=4):
    df = spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 1, "x") for i, v in data], SCHEMA)
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in asked], "query_id string, embedding array<double>")
    return df.repartition(parts), queries


def by_hand(data, asked, k):
    unit = lambda v: np.asarray(v, float) / max(np.linalg.norm(v), 1e-300)
    out = []
    for q, a in asked:
        ranked = sorted((-round(float(unit(a) @ unit(v)), 9), i) for i, v in data)
        out += [(q, i, p) for p, (_, i) in enumerate(ranked[:k], 1)]
    return sorted(out)


def clusters(rng, n, each, dims=6):
    centres = rng.normal(size=(n, dims)) * 5
    return [(c * each + i, centres[c] + rng.normal(size=dims) * 0.05) for c in range(n) for i in range(each)]


def test_clusters_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_BYTES", 8 * 6 * 20)
    rng = np.random.default_rng(3)
    data = clusters(rng, 12, 60)
    # a third of all vectors are copies of one, and one has no direction
    data += [(10_000 + i, data[5][1]) for i in range(300)] + [(20_000, np.zeros(6))]
    asked = [(f"q{i}", v) for i, v in data[:720:9]] + [("q0", data[100][1])]
    df, queries = frames(spark, data, asked)
    assert sorted(map(tuple, nb.neighbours(df, queries, 7).collect())) == by_hand(data, asked, 7)


def test_far_blocks_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_BYTES", 8 * 6 * 20)
    seen = []
    real = nb.worth_scoring

    def spy(pairs, groups, floors):
        left = real(pairs, groups, floors)
        seen.append((pairs.count(), left.count()))
        return left

    monkeypatch.setattr(nb, "worth_scoring", spy)
    data = clusters(np.random.default_rng(4), 20, 60)
    df, queries = frames(spark, data, [(str(i), v) for i, v in data])
    assert nb.neighbours(df, queries, 5).count() == 5 * len(data)
    (every, left), = seen
    assert left < every / 4


def test_even_directions_and_few_vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, v) for i, v in enumerate(rng.normal(size=(200, 16)))]
    asked = [(f"q{i}", v) for i, v in enumerate(rng.normal(size=(30, 16)))]
    for rows, k in ((data, 9), (data[:3], 9), (data[:1], 1), ([(7, np.zeros(16))], 2)):
        df, queries = frames(spark, rows, asked)
        assert sorted(map(tuple, nb.neighbours(df, queries, k).collect())) == by_hand(rows, asked, k)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(3, [1.0, 2.0]), (2, [2.0, 4.0]), (5, [1e200, -1e200]), (6, [1e-200, 0.0])]
    data = [*good, (8, None), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [])]
    df, queries = frames(spark, data, [("a", [1.0, 2.0]), ("b", [0.0, 1.0])])
    got = sorted(nb.neighbours(df, queries, 10).collect(), key=lambda r: (r[0], r[2]))
    assert [r[1] for r in got] == [2, 3, 6, 5, 2, 3, 6, 5]
    assert nb.neighbours(df.where("vec_id > 7"), queries, 2).collect() == []
    assert nb.neighbours(df, queries.limit(0), 2).collect() == []
    with_null = df.union(spark.createDataFrame([(2, [2.0, None], 1, "x")], SCHEMA))
    assert nb.neighbours(with_null, queries, 10).count() == 8


@pytest.mark.parametrize("bad", ([0.0, 0.0], None, [float("nan"), 1.0], [1.0]))
def test_queries_that_cannot_be_compared(spark, bad):
    df, _ = frames(spark, [(1, [1.0, 2.0])], [])
    queries = spark.createDataFrame([(1, bad)], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="a query is"):
        nb.neighbours(df, queries, 1).collect()


def test_vectors_of_another_length(spark):
    df, queries = frames(spark, [(1, [1.0, 2.0]), (2, [1.0])], [("a", [1.0, 2.0])], 1)
    with pytest.raises(Exception, match="a vector is not of length"):
        nb.neighbours(df.orderBy(F.size("embedding").desc()), queries, 1).collect()


def test_blocks_grow_with_the_table(spark, monkeypatch):
    """A table of many blocks has a bounded number of them, and so are the copies that pairs need."""
    monkeypatch.setattr(nb, "BLOCK_BYTES", 8 * 6 * 4)
    monkeypatch.setattr(nb, "SCORES_AT_ONCE", 100)
    data = clusters(np.random.default_rng(8), 40, 50)
    df, queries = frames(spark, data, [(f"q{i}", v) for i, v in data[::40]])
    numbers, whole = [], nb._bounds
    monkeypatch.setattr(nb, "_bounds", lambda g, b: numbers.append(b.count()) or whole(g, b))
    asked = [(f"q{i}", v) for i, v in data[::40]]
    assert sorted(map(tuple, nb.neighbours(df, queries, 5).collect())) == by_hand(data, asked, 5)
    assert numbers[0] <= nb.BLOCKS + nb.PIVOTS + 1 + nb.BLOCKS // nb.PACKED_BLOCKS + 1  # 500 blocks of BLOCK_BYTES


def test_the_best_scores_without_sorting_all(monkeypatch):
    rng, rounded, real = np.random.default_rng(9), [], np.round
    monkeypatch.setattr(np, "round", lambda x, *a: rounded.append(np.size(x)) or real(x, *a))
    score = rng.integers(-50, 50, (40, 3000)) / 50 + rng.integers(-1, 2, (40, 3000)) * 2e-13
    score[5:, 5:] = rng.normal(size=(35, 2995))
    floor = np.where(np.arange(40) % 2, -np.inf, real(np.sort(score, axis=1)[:, -9], nb.DIGITS))
    for k in (1, 4, 3000, 5000):
        value = real(score, nb.DIGITS)
        top = np.argsort(-value, axis=1, kind="stable")[:, :k]
        want = [
            (i, int(p), value[i, p]) for i in range(40) for p in top[i] if value[i, p] >= floor[i]
        ]
        rounded.clear()
        assert list(zip(*(x.tolist() for x in nb.best_of(score, floor, k)))) == want
        if k < 5:
            assert sum(rounded) < score.size / 20
