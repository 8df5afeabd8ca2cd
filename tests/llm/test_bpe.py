import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tomeworks.llm import bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
EXTRA = [
    (20, "héllo <|endoftext|>wörld  \n\n x <|endoftext|><|endoftext|>"), (21, "don't can't we'll \t\t\n  12.5 ½ ² x²"),
    (22, "\x00\x01 nul\x1c\x1f\x85 "), (23, "  lead trail  "), (24, "a b c　d"), (25, "Ǆ ǅ ʰ ˈ Ω я"),
]


def check(docs):
    tokenizer = Tokenizer.from_file(FILE)
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id or 0, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.digests(docs, FILE, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, *r[1:]) for r in got) == sorted(want)


def test_odd_rows(table, monkeypatch):
    from llm_rows import ODD_TEXTS

    check(table(ODD_TEXTS + EXTRA))
    monkeypatch.setattr(bpe, "FLUSH_CHARS", 200)
    monkeypatch.setattr(bpe, "SHARD_BYTES", 20_000)
    check(table(ODD_TEXTS + EXTRA))
    check(table([]))


def test_small_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_pieces_undo_ids():
    table = bpe.pieces(FILE)
    assert len(table) == 50257 and bpe.decode(np.array([50256]), table) == "<|endoftext|>"
    assert sorted(p for p in table if len(p) == 1) == [bytes([b]) for b in range(256)]
