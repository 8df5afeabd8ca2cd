import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import ODD_TEXTS

from tomeworks.llm import resample

TARGET = [(1, "the quick brown fox of New York"), (2, None), (3, ""), (4, "words, words: naïve 日本語")]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(text):
    w = words_of(text)
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(rows, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for _, text in target:
        t.update(buckets(text))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        own = buckets(text)
        weight = sum(gain[b] for b in own)
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words_of(text)), len(own), weight, score, None])
    open_ = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(open_[: percent * len(open_) // 100], 1):
        row[5] = rank
    return out


def key(r):
    return [(x is None, x or 0) for x in r]


MORE = [(100 + i, f"The quick brown fox {i} " * (i % 9) + "of New York " * 5) for i in range(150)]


@pytest.mark.parametrize("percent", [5, 50, 100, 0])
def test_against_brute_force(table, spark, monkeypatch, percent):
    rows = ODD_TEXTS + MORE + MORE[:40]
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    monkeypatch.setattr(resample, "FLUSH_CHARS", 700)
    monkeypatch.setattr(resample, "RANK_ROWS", 20)
    got = resample.resample(table(rows), target, percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, brute(rows, TARGET, percent)), key=key)


def test_empty_tables(table, spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(table([]), target).collect() == []
    rows = ODD_TEXTS + MORE
    got = resample.resample(table(rows), target, 30).collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, brute(rows, [], 30)), key=key)


def test_rows_tied_in_all_but_their_place(spark):
    """A third of the rows are one row; exactly the wanted number of them is drawn, each with a rank."""
    scored = spark.range(0, 90, numPartitions=5).selectExpr(
        "if(id % 3 = 0, 7, id) AS doc_id", "if(id % 3 = 0, 50L, id % 40) AS score", "id AS place", "1 AS extra"
    )
    got = resample.draw(scored, resample.F.lit(True), 20).collect()
    drawn = sorted((r.rank, r.doc_id, r.score) for r in got if r.rank is not None)
    assert len(got) == 90 and drawn == [(k, 7, 50) for k in range(1, 19)]


def test_checksums_of_parts():
    sums = resample.Checksums()
    parts = [(b"a", b""), (b"", b"b"), (b"ab" * 50, b"\x00" * 64), (b"x", b"y" * 65), (b"naive", bytes(range(256)) * 3)]
    joined = sums.join(
        np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([zlib.crc32(b) for _, b in parts], np.uint32),
        np.array([len(b) for _, b in parts]),
    )
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_chunks_lose_and_repeat_nothing():
    text = "a bb ccc dddd " * 40 + "z" * 90 + " q r"
    whole = Counter(buckets(text))
    for limit in (1, 7, 50, 10_000):
        got = Counter()
        for owner, bucket, _ in resample.features(["x y", text, "", "p"], resample.Checksums(), limit):
            got.update(bucket[owner == 1].tolist())
        assert got == whole
