"""Hot keys: the spread-out routes give what the plain ones give."""

import pytest
from pyspark.sql import Window, functions as F

from tomeworks.operators import changes, skew


@pytest.fixture(scope="module")
def hot(spark):
    """4,000 rows, a third of them under one key, some under a null key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 97 == 0, None).otherwise(F.concat(F.lit("k"), n % 50))
    return spark.range(4000).select(
        key.alias("key"), n, F.pmod(F.xxhash64("id"), F.lit(1000)).alias("at"), (F.hash("id") % 3).alias("state")
    ).repartition(7).persist()


def pairs(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("min_rows", [100, 10**9])
def test_with_previous_matches_a_window(hot, min_rows):
    w = Window.partitionBy("key").orderBy("at", "id")
    want = hot.select("key", "id", F.lag("state").over(w).alias("previous"))
    got = skew.with_previous(hot, ["key"], ["at", "id"], F.col("state"), min_rows=min_rows)
    assert pairs(got.select("key", "id", "previous")) == pairs(want)


def test_hot_history_is_cut(hot, spark):
    pieces = skew.range_pieces(hot.where("key = 'hot'"), [F.col("key"), F.col("at"), F.col("id")])
    sizes = [r["count"] for r in pieces.groupBy("piece").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 2 * min(sizes)


def test_change_sequence_of_a_hot_key(hot):
    plain = changes.change_sequence(hot, ["key"], ["at", "id"], "state")
    cut = changes.change_sequence(hot, ["key"], ["at", "id"], "state", min_rows=100)
    assert pairs(plain.select("id", "status")) == pairs(cut.select("id", "status"))
    assert {r.status for r in plain.collect()} == {"new", "changed", "unchanged"}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_matches_a_join(hot, spark, how):
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), ("zz", 4), (None, 5)], "key string, v int")
    want = hot.join(right, ["key"], how)
    got = skew.salted_join(hot, right, ["key"], how, ["id"], min_rows=100, salts=8)
    assert got.columns == want.columns
    assert pairs(got) == pairs(want)
    spread = skew.salted_join(hot, right, ["key"], "inner", ["id"], 100, 8)
    assert spread.count() == want.count() if how == "inner" else True


@pytest.mark.parametrize("partition", [(), ("key",)])
@pytest.mark.parametrize("k", [0, 1, 40, 700, 5000])
def test_top_rows_routes_agree(hot, partition, k):
    order = [F.desc("at"), F.asc("id")]
    got = skew.top_rows(hot, k, order, partition, early_limit=10)
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    want = hot.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
    assert pairs(got) == pairs(want)
    assert pairs(skew.top_rows(hot, k, order, partition, early_limit=10**6)) == pairs(want)


def test_top_rows_with_one_value_everywhere(hot):
    same = hot.withColumn("at", F.lit(1))
    got = skew.top_rows(same, 1500, [F.desc("at"), F.asc("id")], early_limit=10)
    assert sorted(r.id for r in got.collect()) == list(range(1500))


def test_hot_keys_are_bounded(hot):
    assert [r.key for r in skew.hot_keys(hot, ["key"], 100).collect()] == ["hot"]
    assert skew.hot_keys(hot, ["key"], 1, most=5).count() == 5


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_page_cap_in_blocks(spark, block):
    rows = spark.range(60).select(
        F.when(F.col("id") < 40, "a").otherwise("b").alias("provider"),
        (F.col("id") % 40 / 4).cast("int").alias("page"),
        (F.col("id") % 4 != 0).alias("kept"),
        "id",
    )
    cut = {r.provider: r.cut_page for r in changes.cap_pages(rows, 16, pages_per_block=block).collect()}
    assert cut == {"a": 5}  # three kept per page: 15 after page 4, 18 after page 5; b has 15
    kept = changes.page_cap(rows, 16, pages_per_block=block)
    assert kept.where("provider = 'a'").count() == 24 and kept.where("provider = 'b'").count() == 20
    assert changes.page_cap(rows, None).count() == 60


def test_resumed_page_lets_one_more_through(spark):
    rows = spark.range(8).select(F.lit("a").alias("provider"), (F.col("id") / 2 + 3).cast("int").alias("page"), F.lit(True).alias("kept"))
    plain = changes.cap_pages(rows, 2, resumed_page=3).first().cut_page
    over = changes.cap_pages(rows, 2, resumed_page=3, match_resume_overshoot=True).first().cut_page
    later = changes.cap_pages(rows, 3, resumed_page=3, match_resume_overshoot=True).first().cut_page
    assert (plain, over, later) == (3, 4, 4)


def test_windows_over_many_rows_have_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    df = spark.range(5000).selectExpr("id % 700 key", "id at", "id value")
    for out in (
        skew.with_previous(df, ["key"], ["at"], F.col("value")), skew.carry_forward(df, ["key"], ["at"], F.col("value")),
    ):
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 400  # of 5000 in 8 partitions: 625 and more
        assert out.count() == 5000
