import datetime

from pyspark.sql import functions as F

from tomeworks.llm import urls


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


ENTRIES = [
    ("spam", "bad.example", "add", day(10)), ("spam", "bad.example", "add", day(10)), ("spam", "bad.example", "remove", day(20)),
    ("spam", "bad.example", "add", day(30)), ("allow", "good.bad.example", "add", day(12)),
    ("adult", "mixed.example/x", "add", day(5)), ("adult", "mixed.example/x", "remove", day(5)),
    ("adult", "mixed.example/y", "add", day(5)), (None, "bad.example", "add", day(0)), ("spam", None, "add", day(0)), ("spam", "z", "add", None),
]
CAPTURES = [
    (1, "http://bad.example/a", day(9), False), (2, "https://www.BAD.example:8080/a?b", day(10), True), (3, "http://bad.example/", day(20), False),
    (4, "http://u@bad.example#x", day(31), True), (5, "http://good.bad.example/a", day(13), False), (6, "http://good.bad.example/a", day(11), True),
    (7, "http://mixed.example/x/1", day(6), False), (8, "http://mixed.example//y/1", day(6), True), (9, "http://mixed.example/yy", day(6), False),
    (10, None, day(6), False), (11, "no url", day(6), False), (12, "http://bad.example/", None, False), (2, "https://www.BAD.example:8080/a?b", day(10), True),
    (13, "http://notbad.example/", day(15), False), (14, "http:///x", day(15), False), (15, "http://bad.example/" + "p/" * 300, day(15), True),
]


def frames(spark, captures):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched date, want boolean").withColumn("list", F.lit("own"))
    return c, spark.createDataFrame(ENTRIES, "list string, pattern string, action string, dated date")


def test_entries_active_at_fetch_time(spark, monkeypatch):
    for rows in (urls.BROADCAST_ROWS, 0):  # both ways of the join
        monkeypatch.setattr(urls, "BROADCAST_ROWS", rows)
        found = urls.evaluate(*frames(spark, CAPTURES)).collect()
        assert len(found) == len(CAPTURES)
        assert [r.page_id for r in found if r.blocked != r.want] == []
    assert urls.evaluate(*frames(spark, CAPTURES[:0])).collect() == []


def test_no_entries_block_nothing(spark):
    captures, entries = frames(spark, CAPTURES)
    assert not any(r.blocked for r in urls.evaluate(captures, entries.limit(0)).collect())
