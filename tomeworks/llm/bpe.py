"""Byte-level BPE encoding and decoding by a table of distinct words.

The documents of a partition are read in flushes of bounded size.  A flush sends each of its
distinct words (pre-tokens) once, to the shard of the word's hash.  A shard encodes each of
its distinct words once and answers every flush in the order it asked.  Texts and answers of
a flush meet again, and the ids are joined back by the position of the words.  Decoding joins
the ids with the table of pieces.

Texts are read twice, for the words and for the join; a flush is named by its partition and
its number there, so ``docs`` must be a scan of files (any other frame is staged by the
caller first).  A flush whose words and answers do not fit raises an error.

Defined results: a null text is an empty one, an empty one has no ids; rows are encoded one by
one, so repeated rows get equal results; a special token in a text is one id, as the library
does it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Numbers, expand, flushes, parts_for, text_bytes

# Characters of a flush, and bytes of text for each shard of the word table.
FLUSH_CHARS = 4_000_000
SHARD_BYTES = 16_000_000
# Signs whose class is the same in every version of Unicode, and their letters, numbers and spaces.
_ODD = re.compile("[^\x00-ɏ‐-‧]")
_CLASSES = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"\p{N}": "0-9²³¹¼-¾", r"\s": "\t-\r \x85\xa0"}


class Splitter:
    """Cuts a text into the words that the tokenizer merges within."""

    def __init__(self, tokenizer_file: str, pattern: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.find = re.compile(narrowed(pattern)).findall
        self.shown = str.maketrans({chr(b): c for c, b in byte_signs().items()})
        self.merge = self.tokenizer.model.tokenize
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def plain(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return self.find(text)
        # signs whose class may differ between versions of Unicode: as the library cuts them
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return [w for i, x in enumerate(parts) if x for w in ([x] if i % 2 else self.plain(x))]

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of single words."""
        shown = [w.encode().decode("latin-1").translate(self.shown) for w in words]
        special = self.special.fullmatch if self.special else lambda w: None
        return [
            [self.tokenizer.token_to_id(w)] if special(w) else [t.id for t in self.merge(s)]
            for w, s in zip(words, shown)
        ]


def narrowed(pattern: str) -> str:
    """``pattern`` with the classes of letters, numbers and spaces spelled out."""

    def put(m: re.Match) -> str:
        if m[0][0] != "[":
            return f"[^{_CLASSES[r'\s']}]" if m[0] == r"\S" else f"[{_CLASSES[m[0]]}]"
        out = m[0]
        for name, signs in _CLASSES.items():
            out = out.replace(name, signs)
        return out

    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s|\\S", put, pattern)


def byte_signs() -> dict[str, int]:
    """A byte-level vocabulary writes each byte as one sign: printable ones as themselves, the
    others as the signs from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(tokenizer_file: str) -> list[bytes]:
    """The bytes of every id."""
    from tokenizers import Tokenizer

    byte_of = byte_signs()
    vocab = Tokenizer.from_file(tokenizer_file).get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        known = all(c in byte_of for c in piece)
        table[i] = bytes(byte_of[c] for c in piece) if known else piece.encode()
    return table


def _pack(texts: list[str]) -> tuple[bytes, bytes]:
    import zstandard

    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.uint32)
    return sizes.tobytes(), zstandard.ZstdCompressor(level=3).compress(b"".join(raw))


def _unpack(sizes: bytes, body: bytes) -> list[str]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(body)
    ends = np.cumsum(np.frombuffer(sizes, np.uint32).astype(np.int64)).tolist()
    return [raw[a:b].decode() for a, b in zip([0, *ends], ends)]


def _shards(words: list[str], shards: int) -> np.ndarray:
    import xxhash

    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    return (h % np.uint64(shards)).astype(np.int64)


def _flushed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    from pyspark import TaskContext


    part = TaskContext.get().partitionId()
    size = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
    for k, batch in enumerate(flushes(batches, size, FLUSH_CHARS)):
        yield part << 32 | k, batch


def encode(
    docs: DataFrame, tokenizer_file: str, pattern: str, result, schema: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``result(doc_ids, texts, ids)`` for the documents of each flush, a frame of ``schema``;
    ``ids`` is a list of unsigned arrays, and a null id is None."""
    scan = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = text_bytes(scan)
    shards = parts_for(total, SHARD_BYTES)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(tokenizer_file, pattern)
        for flush, batch in _flushed(batches):
            words = list(dict.fromkeys(chain.from_iterable(map(splitter.words, batch["text"]))))
            shard = _shards(words, shards)
            rows = []
            for s in np.unique(shard):
                rows.append((int(s), flush, *_pack([words[i] for i in np.flatnonzero(shard == s)])))
            yield pd.DataFrame(rows, columns=["shard", "flush", "sizes", "body"])

    def answer(asked: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        splitter = Splitter(tokenizer_file, pattern)
        number = Numbers()
        each = [
            np.array([*map(number.__getitem__, _unpack(sizes, body))], np.int64)
            for sizes, body in zip(asked["sizes"], asked["body"])
        ]
        counts, flat = np.zeros(len(number), np.int64), []
        words = list(number)
        for lo in range(0, len(words), 20_000):
            found = splitter.encode(words[lo : lo + 20_000])
            counts[lo : lo + len(found)] = [len(x) for x in found]
            flat.append(np.fromiter(chain.from_iterable(found), np.uint32))
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        starts = np.cumsum(counts) - counts
        pack = zstandard.ZstdCompressor(level=3).compress
        return pd.DataFrame({
            "flush": asked["flush"], "shard": asked["shard"], "ids": None,
            "sizes": [counts[x].astype(np.uint32).tobytes() for x in each],
            "body": [pack(flat[expand(starts[x], counts[x])].tobytes()) for x in each],
        })

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for flush, batch in _flushed(batches):
            sizes, body = _pack(batch["text"].fillna("").tolist())
            null = batch["doc_id"].isna().to_numpy()
            ids = batch["doc_id"].fillna(0).to_numpy(np.int64).tobytes() + null.tobytes()
            yield pd.DataFrame([(flush, -1, ids, sizes, body)], columns=["flush", "shard", "ids", "sizes", "body"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        own = rows["shard"].to_numpy() == -1
        if own.sum() != 1:
            raise RuntimeError("the texts were not scanned in the same order twice")
        mine = rows[own].iloc[0]
        texts = _unpack(mine["sizes"], mine["body"])
        n = len(texts)
        null = np.frombuffer(mine["ids"], np.bool_, offset=8 * n)
        doc_ids = np.array(np.frombuffer(mine["ids"], np.int64, n), object)
        doc_ids[null] = None
        splitter = Splitter(tokenizer_file, pattern)
        number = Numbers()
        lists = [np.array([*map(number.__getitem__, splitter.words(t))], np.int64) for t in texts]
        shard = _shards(list(number), shards)
        counts, starts, flat, before = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64), [], 0
        answers = {r.shard: r for r in rows[~own].itertuples()}
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            sizes = np.frombuffer(answers[s].sizes, np.uint32).astype(np.int64)
            if len(sizes) != len(at):
                raise RuntimeError("the texts were not scanned in the same order twice")
            ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(answers[s].body), np.uint32)
            counts[at], starts[at] = sizes, before + np.cumsum(sizes) - sizes
            flat.append(ids)
            before += len(ids)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        return result(doc_ids, texts, (flat[expand(starts[x], counts[x])] for x in lists))

    asked = scan.mapInPandas(ask, "shard int, flush long, sizes binary, body binary")
    row = "flush long, shard int, ids binary, sizes binary, body binary"
    answers = asked.repartition(shards, "shard").groupBy("shard").applyInPandas(answer, row)
    both = scan.mapInPandas(send, row).union(answers)
    return both.repartition(parts_for(total, FLUSH_CHARS), "flush").groupBy("flush").applyInPandas(join, schema)


def decode(ids: np.ndarray, table: list[bytes]) -> str:
    """The text of a sequence of ids; bytes that are no UTF-8 become replacement signs."""
    return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def digests(docs: DataFrame, tokenizer_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: all documents encoded and decoded."""

    def result(doc_ids, texts, ids) -> pd.DataFrame:
        from hashlib import sha256

        table = pieces(tokenizer_file)
        n, packed, decoded = [], [], []
        for own in ids:
            n.append(len(own))
            packed.append(sha256(own.astype("<u4").tobytes()).hexdigest())
            decoded.append(sha256(decode(own, table).encode()).hexdigest())
        return pd.DataFrame({
            "doc_id": pd.array(doc_ids, "Int64"), "n_tokens": np.array(n, np.int64),
            "ids_sha256": np.array(packed, object), "decoded_sha256": np.array(decoded, object),
        })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(docs, tokenizer_file, pattern, result, schema, id_col, text_col)
