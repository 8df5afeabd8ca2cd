import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm_rows import ODD_TEXTS
from test_bpe import EXTRA
from tokenizers import Tokenizer

from tomeworks.llm import tokenfile

FILE = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tokenizer = Tokenizer.from_file(FILE)
    ids = {}
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_files_against_the_library(table, monkeypatch, small):
    if small:
        monkeypatch.setattr(tokenfile, "FILE_BYTES", 9_000)
        monkeypatch.setattr(tokenfile, "FLUSH_CHARS", 500)
        monkeypatch.setattr(tokenfile, "CACHE_WORDS", 20)
        monkeypatch.setattr(tokenfile, "FILES_TOGETHER", 3)
        monkeypatch.setattr(tokenfile, "READ_TOKENS", 50)
    rows = [r for r in ODD_TEXTS + EXTRA if r[0] != 2] + [(-5, "below zero"), (2**62, "far"), (None, "again without")]
    docs = table(rows)
    nulls = [tuple(r) for r in docs.select("doc_id", "text").collect() if r.doc_id is None]
    want = brute(nulls + sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]))
    got = tokenfile.digests(docs, FILE, public_tokenizers.PATTERN).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_repeated_ids_keep_all_rows(table):
    rows = [(7, "same text here")] * 40 + [(7, "other text")] * 3 + [(1, "first")]
    got = sorted(tuple(r) for r in tokenfile.digests(table(rows), FILE, public_tokenizers.PATTERN).select("start", "n_tokens", "doc_id", "ids_crc32").collect())
    assert [r[0] for r in got] == np.cumsum([0, *[r[1] for r in got]])[:-1].tolist()
    assert sorted(r[1:] for r in got) == sorted((n, i, c) for i, _, n, c in brute(rows))


def test_empty_table_and_whole_documents(table):
    assert tokenfile.digests(table([]), FILE, public_tokenizers.PATTERN).collect() == []
    files = tokenfile.write(table([(1, "one text"), (2, None)]), FILE, public_tokenizers.PATTERN)
    got = {r.doc_id: r.tokens for r in tokenfile.documents(files).collect()}
    assert got == {1: [*Tokenizer.from_file(FILE).encode("one text").ids, 0], 2: [0]}


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = tokenfile.digests(docs, FILE, public_tokenizers.PATTERN).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def round_trip(values):
    stream = tokenfile.Stream()
    for part in np.array_split(np.array(values, np.uint64), 3):
        stream.add(part)
    body = b"".join(tokenfile.file_bytes(stream, tokenfile.Stream(), tokenfile.Stream(), -3, 2))
    read = tokenfile.TokenFile(io.BytesIO(body))
    assert read.n_tokens == len(values) and read.doc_ids() == [None, None] and len(read.sizes()) == 0
    return read, body


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700), st.data())
def test_numbers_come_back(values, data):
    read, _ = round_trip(values)
    assert read.numbers(0).tolist() == values
    a, b = data.draw(st.integers(0, len(values))), data.draw(st.integers(0, len(values)))
    assert read.numbers(0, a, b).tolist() == values[a:b]


def test_outliers_go_to_exceptions_and_blocks_are_read_alone():
    rng = np.random.default_rng(3)
    values = rng.integers(1000, 1016, 256 * 40).astype(np.uint64)
    values[::97] = 2**40
    read, body = round_trip(values)
    assert len(body) < 256 * 40 * 1.4  # four bits each, and the outliers
    seen = []
    reader = read._read
    read._read = lambda a, b: seen.append(b - a) or reader(a, b)
    assert read.numbers(0, 5000, 5100).tolist() == values[5000:5100].tolist()
    assert sum(seen) < 700
    assert (np.diff(read.tables[0][1:]) > 0).all() and len(read.tables[0]) == 42


def test_broken_files_are_refused(tmp_path):
    _, body = round_trip(range(10))
    for bad in (b"", body[:-1], b"x" + body[1:]):
        with pytest.raises(ValueError):
            tokenfile.TokenFile(io.BytesIO(bad))
