"""Column helpers against literal values."""

import datetime as dt
import sys
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tomeworks import fixed, functions as fn
from tomeworks.functions.parsing import author_list, string_list


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_white_space_is_complete():
    assert set(fixed.WHITE_SPACE) == {chr(c) for c in range(sys.maxunicode) if chr(c).isspace()}


def test_strip_space(spark):
    texts = ["  a b ", "\xa0\x1cx　", "", "\n\t", None, "né "]
    assert apply(spark, texts, fn.strip_space) == [t and t.strip() for t in texts]


def test_first_chars_counts_code_points(spark):
    assert apply(spark, ["a𝒳é𝒳b", "ab"], lambda c: fn.first_chars(c, 3)) == ["a𝒳é", "ab"]


def test_first_number(spark):
    values = ["Reading ease score: 69.2 (8th grade)", "72.5", "-3", "none", "", None, "1."]
    assert apply(spark, values, fn.first_number) == [69.2, 72.5, -3.0, None, None, None, 1.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_issued_timestamp(spark, zone):
    cases = {
        "1998-06-01T00:00:00Z": (1998, 6, 1), "1993-01-01": (1993, 1, 1), "19980601": (1998, 6, 1),
        "1998-6-1": (1998, 6, 1), " 1998-06-01 ": (1998, 6, 1), "1998-06-01T02:00:00+02:00": (1998, 6, 1),
        "1998-06-01 02:00+0200": (1998, 6, 1), "1998-06-01T10:30": (1998, 6, 1, 10, 30),
        "1998": None, "1998-06": None, "1998-02-30": None, "": None, "June 1": None, None: None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(spark, list(cases), lambda c: F.unix_micros(fn.issued_timestamp(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = [v and int(dt.datetime(*v, tzinfo=dt.timezone.utc).timestamp() * 10**6) for v in cases.values()]
    assert got == want


def test_front_matter(spark):
    marker = "*** START OF THE PROJECT GUTENBERG EBOOK EMMA ***"
    texts = [
        f"Licence\n{marker}\n\nChapter 1 *** end ***",
        f"x {marker.lower()} body",
        "***  start of this project gutenberg ebook\nlong\ntitle *** rest",
        "no marker *** here",
        "a" * 19_990 + marker + " late",
        "a" * 100 + marker + "b" * 30_000,
        None,
    ]
    assert apply(spark, texts, fn.after_front_matter) == [
        "\n\nChapter 1 *** end ***", " body", " rest", texts[3], texts[4], "b" * 30_000, None
    ]


def test_preview(spark):
    assert apply(spark, ["  " + "x" * 500, "   ", None, "short\n"], lambda c: fn.preview(c, 50)) == [
        "x" * 50, None, None, "short"
    ]


def test_path_quote(spark):
    values = ["uc2.ark:/13960/t4mk66f1d", "a b+c*d~e.f_g-h", "é%&?=#", "mdp.39015", ""]
    assert apply(spark, values, fn.path_quote) == [quote(v) for v in values]


def test_tags(spark):
    assert apply(spark, ["a; b", "", None, "; x; "], fn.split_tags) == [["a", "b"], [], [], ["x"]]
    assert apply(spark, [["a", "b"], []], fn.join_tags, "array<string>") == ["a; b", ""]


def test_all_digits_and_dates(spark):
    assert apply(spark, ["12", "1a", ""], fn.all_digits) == [True, False, False]
    assert apply(spark, ["1998-06-01T00:00:00Z"], fn.iso_date) == ["1998-06-01"]


def test_text_ladder(spark):
    rows = [("s", "d", "i", "f"), ("", "d", "i", "f"), (None, "", "i", "f"), (None, None, None, "f"), (None,) * 4]
    df = spark.createDataFrame(rows, "s string, d string, i string, f string")
    cols = [F.col(c) for c in "sdif"]
    got = df.select(fn.text_ladder(*cols).alias("t"), fn.text_ladder_origin(*cols).alias("o")).collect()
    assert [(r.t, r.o) for r in got] == [
        ("s", "summary"), ("d", "description"), ("i", "intro"), ("f", "first_chars"), (None, "none")
    ]


def test_search_blob_keeps_separators(spark):
    df = spark.createDataFrame([("A", None, "C")], "a string, b string, c string")
    assert df.select(fn.search_blob(*[F.col(c) for c in "abc"])).first()[0] == "a  c"


def test_string_list_shapes(spark):
    values = ['{"s":["a",null,"",3]}', '{"s":"b"}', '{"s":null}', "{}", '{"s":""}']
    got = apply(spark, values, lambda c: string_list(F.try_parse_json(c), "$.s"))
    assert got == [["a", "3"], ["b"], [], [], []]


def test_author_shapes(spark):
    values = ['{"a":[{"name":"Quill, Osbert","id":503,"birth_year":1834},"Anon",{}]}', '{"a":null}', "{}"]
    got = apply(spark, values, lambda c: author_list(F.try_parse_json(c), "$.a"))
    assert [tuple(a) for a in got[0]] == [
        ("Quill, Osbert", "503", 1834, None), ("Anon", None, None, None), ("", None, None, None)
    ]
    assert got[1:] == [[], []]


def test_text_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a\x1f", "")], "a string, b string")
    hashes = [r[0] for r in df.select(fn.text_hash(F.col("a"), F.col("b"))).collect()]
    assert len(set(hashes)) == 3
