import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tomeworks.llm import langid

FILE = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    rows = {p: i for i, p in enumerate(["a", "b", "ab", langid.START, langid.START + "a"])}
    p = np.array([[0.2, 0.3], [0.1, 0.1], [0.3, 0.2], [0.25, 0.25], [0.15, 0.15]])
    got = np.exp(langid.score_words(["ab", "c"], langid.Pieces(rows), np.log(p)))
    start, a, b, ab, start_a = p[3], p[0], p[1], p[2], p[4]
    assert np.allclose(got[0], start * a * b + start * ab + start_a * b)
    assert np.allclose(got[1], start * langid.RARE)


def test_expected_counts_are_the_posterior_of_segmentations():
    rows = {p: i for i, p in enumerate(["a", "b", "ab", langid.START])}
    logp = np.log(np.array([[0.2], [0.1], [0.3], [0.4]]))
    got = langid.expected_counts(["ab"], np.array([0]), np.array([10.0]), langid.Pieces(rows), logp)
    one = 0.3 / (0.3 + 0.2 * 0.1)
    assert np.allclose(got[:, 0], [10 * (1 - one), 10 * (1 - one), 10 * one, 10])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.pmod("doc_id", F.lit(3)) == 0
    model = langid.fit(docs.filter(~held), FILE, rounds=2)
    found = langid.predict(docs.filter(held), model, keep={"lang": F.col("lang")}).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.9 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(spark, odd):
    learned = spark.createDataFrame(
        [(1, "the dog and the cat", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None)],
        "doc_id long, text string, lang string",
    )
    found = langid.predict(odd, langid.fit(learned, FILE, rounds=1)).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (3, 4, 5, 6))
    assert by_id[1].lang_pred == "en"
    nothing = langid.predict(odd, langid.fit(learned.limit(0), FILE)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_long_pieces_are_in_the_sums():
    assert max(map(len, langid.vocabulary(FILE))) > 8
    long = "abcdefghijkl"
    rows = {p: i for i, p in enumerate([langid.START, long, langid.START + long])}
    p = np.array([[0.2], [0.3], [0.4]])
    got = np.exp(langid.score_words([long], langid.Pieces(rows), np.log(p)))
    assert np.allclose(got[0], 0.2 * 0.3 + 0.4 + 0.2 * langid.RARE ** 12)
