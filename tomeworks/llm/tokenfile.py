"""Token ids in binary files of patched frame-of-reference blocks, and back.

Documents are dealt out by ranges of their id; each task encodes its range and writes one file.
A file holds three streams of unsigned numbers (the token ids of all its documents one after
another, the number of ids of each document, and the steps from one document id to the
next), each in blocks of ``BLOCK`` numbers, then a footer.  Of a block the minimum is
subtracted; what is left is packed at the width that covers ``COVERED`` percent of its numbers.
Numbers that need more bits have their low bits in the pack, and their place and what is above
the width in the block's exception list.  The footer holds where each block starts, so any range of a
stream is read by its blocks alone.

Layout, all little-endian: the magic; blocks; for each stream its length (8 bytes) and the
starts of its blocks and its end (8 bytes each); the three places of these tables, the first
document id, the number of documents without an id (8 bytes each), and the magic again.  A block is
its minimum (8 bytes), width (1), bytes of an exception (1), number of exceptions (2), the
packed numbers, the places of the exceptions (a byte each) and what of them is above the width.

A file is written under another name and moved into place whole, and the table that
``write`` returns names the files, so a task may run twice.  ``start`` comes from a running sum
over that table, one row a file.

Defined results: documents are in ascending order of id, those without an id first; rows
that share an id are in the order of the scan; a null or empty text is the end id alone;
an empty table has no files.  Very long texts are encoded in one piece; a task holds the packed
file of its range and a flush of texts.  Columns other than id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import Splitter
from .common import Numbers, expand, flushes, parts_for, stage, text_bytes
from ..session import work_path

BLOCK, COVERED = 256, 90
# Bytes of text for each file, and characters encoded at a time.
FILE_BYTES, FLUSH_CHARS = 64_000_000, 2_000_000
# Words whose ids a task remembers at most, and files whose starts are added up together.
CACHE_WORDS, FILES_TOGETHER = 1_000_000, 1000
# Ids read from a file at a time.
READ_TOKENS = 1_000_000
MAGIC = b"PFORTOK1"
END_ID = 0
_HEAD = np.dtype([("least", "<u8"), ("width", "u1"), ("over", "u1"), ("n", "<u2")])


def _bits(x: np.ndarray) -> np.ndarray:
    """How many bits each number needs."""
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    top = int(x.max()).bit_length() if x.size else 0
    return np.searchsorted(powers[:top], x, side="right")


def _pack(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers as rows of bytes, ``width`` bits a number, low bits first.

    Number j of every row goes to the same bits, so each step packs one number of all rows.
    """
    n = x.shape[1]
    out = np.zeros(((n * width + 63) // 64 + 1, len(x)), np.uint64)
    for j, column in enumerate(np.ascontiguousarray(x.T)):
        word, bit = divmod(j * width, 64)
        out[word] |= column << np.uint64(bit)
        if bit + width > 64:
            out[word + 1] |= column >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8)[:, : (n * width + 7) // 8]


def _unpack(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    words = np.zeros((len(packed), 8 * ((n * width + 63) // 64 + 1)), np.uint8)
    words[:, : packed.shape[1]] = packed
    words = np.ascontiguousarray(words.view("<u8").T)
    out = np.zeros((n, len(packed)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(n):
        word, bit = divmod(j * width, 64)
        out[j] = words[word] >> np.uint64(bit)
        if bit + width > 64:
            out[j] |= words[word + 1] << np.uint64(64 - bit)
        out[j] &= mask
    return out.T


def pack_blocks(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of a stream and the size of each; the last one may be shorter than BLOCK."""
    values = np.asarray(values, np.uint64)
    whole = len(values) // BLOCK * BLOCK
    parts = [values[:whole].reshape(-1, BLOCK), values[None, whole:]]
    done = [_pack_rows(p) for p in parts if p.size]
    return b"".join(d[0] for d in done), np.concatenate([np.zeros(0, np.int64), *(d[1] for d in done)])


def _pack_rows(rows: np.ndarray) -> tuple[bytes, np.ndarray]:
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    need = _bits(rest)
    kth = -(-rows.shape[1] * COVERED // 100) - 1
    width = np.partition(need, kth, axis=1)[:, kth]
    row, place = np.nonzero(need > width[:, None])
    many = np.bincount(row, minlength=len(rows))
    high = rest[row, place] >> width[row].astype(np.uint64)
    # bytes of an exception: what the largest one of its block needs
    over = np.zeros(len(rows), np.int64)
    np.maximum.at(over, row, (_bits(high) + 7) // 8)
    heads = np.zeros(len(rows), _HEAD)
    heads["least"], heads["width"], heads["over"], heads["n"] = least, width, over, many
    packed = (rows.shape[1] * width + 7) // 8
    sizes = _HEAD.itemsize + packed + many * (1 + over)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(_HEAD.itemsize)] = heads.view(np.uint8).reshape(len(rows), -1)
    body = starts + _HEAD.itemsize
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        low = rest[at] & np.uint64((1 << int(w)) - 1)
        out[body[at][:, None] + np.arange(int(packed[at[0]]))] = _pack(low, int(w))
    odd = body + packed
    out[expand(odd, many)] = place.astype(np.uint8)
    for k in np.unique(over[over > 0]):
        own = over[row] == k
        at = np.flatnonzero(over == k)
        out[expand((odd + many)[at], many[at] * k)] = high[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].reshape(-1)
    return out.tobytes(), sizes


def unpack_blocks(data: bytes, starts: np.ndarray, total: int) -> np.ndarray:
    """The numbers of whole blocks that start at ``starts`` in ``data``; ``total`` numbers in all."""
    out = np.zeros(total, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    if not len(starts):
        return out
    heads = raw[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).reshape(-1)
    sizes = np.full(len(starts), BLOCK)
    sizes[-1] = total - BLOCK * (len(starts) - 1)
    body = starts + _HEAD.itemsize
    for n in np.unique(sizes):
        for w in np.unique(heads["width"][sizes == n]):
            at = np.flatnonzero((sizes == n) & (heads["width"] == w))
            packed = (int(n) * int(w) + 7) // 8
            x = _unpack(raw[body[at][:, None] + np.arange(packed)], int(w), int(n)) + heads["least"][at][:, None]
            out[(at[:, None] * BLOCK + np.arange(n)).reshape(-1)] = x.reshape(-1)
    width, many, over = (heads[c].astype(np.int64) for c in ("width", "n", "over"))
    odd = body + (sizes * width + 7) // 8
    block = np.repeat(np.arange(len(starts)), many)
    place = raw[expand(odd, many)].astype(np.int64)
    for k in np.unique(over[over > 0]):
        at = np.flatnonzero(over == k)
        high = np.zeros((int(many[at].sum()), 8), np.uint8)
        high[:, :k] = raw[expand((odd + many)[at], many[at] * k)].reshape(-1, k)
        own = over[block] == k
        out[block[own] * BLOCK + place[own]] += high.view("<u8").reshape(-1) << width[block[own]].astype(np.uint64)
    return out


class Stream:
    """Blocks of one stream while a file is written."""

    def __init__(self):
        self.held, self.parts, self.sizes, self.n = np.zeros(0, np.uint64), [], [], 0

    def add(self, values: np.ndarray) -> None:
        self.n += len(values)
        self.held = np.concatenate([self.held, np.asarray(values, np.uint64)])
        self._flush(len(self.held) // BLOCK * BLOCK if len(self.held) >= 64 * BLOCK else 0)

    def _flush(self, upto: int) -> None:
        if upto:
            body, sizes = pack_blocks(self.held[:upto])
            self.parts.append(body)
            self.sizes.append(sizes)
            self.held = self.held[upto:]

    def close(self) -> tuple[list[bytes], np.ndarray]:
        """The packed blocks and the size of each."""
        self._flush(len(self.held))
        return self.parts, np.concatenate([np.zeros(0, np.int64), *self.sizes])


def file_bytes(tokens: Stream, sizes: Stream, steps: Stream, first_id: int, n_null: int) -> Iterator[bytes]:
    """A whole file, part by part."""
    yield MAGIC
    at, tables = len(MAGIC), []
    for stream in (tokens, sizes, steps):
        parts, each = stream.close()
        ends = at + np.cumsum(np.r_[0, each])
        tables.append(np.r_[stream.n, ends].astype("<i8").tobytes())
        yield from parts
        at = int(ends[-1])
    places = at + np.cumsum([0, *map(len, tables)])[:3]
    yield from tables
    yield np.array([*places, first_id, n_null], "<i8").tobytes() + MAGIC


class TokenFile:
    """Reads ranges of a file's streams; ``source`` is an open file that can seek."""

    TAIL = 5 * 8 + len(MAGIC)

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        if size < self.TAIL + len(MAGIC):
            raise ValueError("no token file: too short")
        tail = self._read(size - self.TAIL, size)
        if tail[-len(MAGIC) :] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("no token file: the magic is missing")
        *places, self.first_id, self.n_null = np.frombuffer(tail, "<i8", 5).tolist()
        ends = [*places[1:], size - self.TAIL]
        self.tables = [np.frombuffer(self._read(a, b), "<i8") for a, b in zip(places, ends)]

    def _read(self, start: int, end: int) -> bytes:
        self.source.seek(start)
        return self.source.read(end - start)

    def numbers(self, stream: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Numbers ``start`` to ``stop`` of a stream; only their blocks are read."""
        n, starts = int(self.tables[stream][0]), self.tables[stream][1:]
        stop = n if stop is None else min(stop, n)
        if start >= stop:
            return np.zeros(0, np.uint64)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        data = self._read(int(starts[first]), int(starts[last + 1]))
        total = min(n, (last + 1) * BLOCK) - first * BLOCK
        return unpack_blocks(data, starts[first : last + 1] - starts[first], total)[start - first * BLOCK : stop - first * BLOCK]

    @property
    def n_tokens(self) -> int:
        return int(self.tables[0][0])

    def tokens(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        return self.numbers(0, start, stop).astype(np.uint32)

    def sizes(self) -> np.ndarray:
        return self.numbers(1).astype(np.int64)

    def doc_ids(self) -> list[int | None]:
        """The ids of the documents in order; None for those without."""
        with np.errstate(over="ignore"):
            known = (np.cumsum(self.numbers(2), dtype=np.uint64) + np.int64(self.first_id).astype(np.uint64)).astype(np.int64)
        return [None] * self.n_null + known.tolist()


class Encoder:
    """Ids of texts; a word's ids are remembered until CACHE_WORDS words are."""

    def __init__(self, tokenizer_file: str, pattern: str):
        self.splitter = Splitter(tokenizer_file, pattern)
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, END_ID after each, and how many each text has."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        lists = [self.splitter.words(t) for t in texts]
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        old = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int64, int(n.sum()))
        self._learn(list(islice(self.known, old, None)))
        counts = np.diff(self.starts)[at]
        ids = self.flat[expand(self.starts[at], counts)]
        stops = np.r_[0, np.cumsum(counts)][np.cumsum(n)]
        return np.insert(ids, stops, END_ID), np.diff(np.r_[0, stops]) + 1

    def _learn(self, words: list[str]) -> None:
        flat, counts = [self.flat], []
        for lo in range(0, len(words), 20_000):
            found = self.splitter.encode(words[lo : lo + 20_000])
            counts += map(len, found)
            flat.append(np.fromiter(chain.from_iterable(found), np.uint32))
        self.flat = np.concatenate(flat)
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(np.array(counts, np.int64))]


def _open(uri: str):
    """The file system of ``uri`` and the path there."""
    from pyarrow import fs

    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def write(
    docs: DataFrame, tokenizer_file: str, pattern: str, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode all documents into files under ``folder`` (a new one in the shared folder unless
    named): ``file, path, n_docs, n_tokens, n_bytes, start``, a row for each file.

    ``start`` is the number of ids in the files before.  The tasks open files through pyarrow, by the
    scheme of the folder's name.
    """
    folder = folder or work_path(docs.sparkSession, "tokens")
    own = F.col(id_col).cast("long")
    scan = docs.select(
        own.isNotNull().alias("known"), F.coalesce(own, F.lit(0)).alias("id"),
        F.monotonically_increasing_id().alias("place"), F.col(text_col).cast("string").alias("text"),
    )
    files = parts_for(text_bytes(scan), FILE_BYTES)
    order = ["known", "id", "place"]

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokens, sizes, steps = Stream(), Stream(), Stream()
        encoder, last, first_id, n_null = None, None, 0, 0
        length = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
        for batch in flushes(batches, length, FLUSH_CHARS):
            encoder = encoder or Encoder(tokenizer_file, pattern)
            ids, n = encoder.encode(batch["text"].fillna("").tolist())
            tokens.add(ids)
            sizes.add(n)
            known = batch["known"].to_numpy(bool)
            n_null += int((~known).sum())
            own = batch["id"].to_numpy(np.int64)[known]
            if len(own):
                first_id = int(own[0]) if last is None else first_id
                back = np.r_[own[0] if last is None else last, own[:-1]]
                with np.errstate(over="ignore"):
                    steps.add(own.astype(np.uint64) - back.astype(np.uint64))
                last = own[-1]
        if not sizes.n:
            return
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:07d}.pfor"
        system, path = _open(name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        draft, many = f"{path}.{uuid.uuid4().hex}.draft", 0
        with system.open_output_stream(draft) as out:
            for piece in file_bytes(tokens, sizes, steps, first_id, n_null):
                out.write(piece)
                many += len(piece)
        system.move(draft, path)
        yield pd.DataFrame([(part, name, sizes.n, tokens.n, many)], columns=["file", "path", "n_docs", "n_tokens", "n_bytes"])

    dealt = scan.repartitionByRange(files, *order).sortWithinPartitions(*order)
    written = stage(dealt.mapInPandas(put, "file int, path string, n_docs long, n_tokens long, n_bytes long"), "token-files")
    return with_starts(written)


def with_starts(files: DataFrame) -> DataFrame:
    """``files`` with ``start``, the sum of ``n_tokens`` over the files of lower number: within
    groups of files, then over the groups."""
    group = F.floor(F.col("file") / FILES_TOGETHER)
    inner = Window.partitionBy("__group").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)  # a row a group
    rows = files.withColumn("__group", group)
    sums = rows.groupBy("__group").agg(F.sum("n_tokens").alias("__n"))
    sums = sums.select("__group", F.coalesce(F.sum("__n").over(outer), F.lit(0)).alias("__before"))
    return rows.join(sums, "__group").withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)) + F.col("__before")
    ).drop("__group", "__before")


def read(files: DataFrame, result, schema: str) -> DataFrame:
    """``result(doc_ids, starts, sizes, tokens)`` for some documents after another, frames of
    ``schema``; each file is read by one task, some blocks at a time.  ``starts`` count from the first
    document of all files."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                system, path = _open(row.path)
                with system.open_input_file(path) as source:
                    found = TokenFile(source)
                    ids, sizes = found.doc_ids(), found.sizes()
                    if found.n_tokens != row.n_tokens or len(ids) != row.n_docs or int(sizes.sum()) != found.n_tokens:
                        raise ValueError(f"{row.path} is not the file that was written")
                    ends = np.cumsum(sizes)
                    lo = 0
                    while lo < len(sizes):
                        start = int(ends[lo] - sizes[lo])
                        hi = max(lo + 1, int(np.searchsorted(ends, start + READ_TOKENS, side="right")))
                        tokens = found.tokens(start, int(ends[hi - 1]))
                        yield result(ids[lo:hi], row.start + ends[lo:hi] - sizes[lo:hi], sizes[lo:hi], tokens)
                        lo = hi

    count = files.count()
    dealt = files.select("file", "path", "n_docs", "n_tokens", "start").repartitionById(max(1, count), F.col("file"))
    return dealt.mapInPandas(get, schema)


def documents(files: DataFrame) -> DataFrame:
    """``doc_id, tokens, start`` of every document in the files."""

    def result(ids, starts, sizes, tokens) -> pd.DataFrame:
        cut = np.split(tokens.astype(np.int64), np.cumsum(sizes)[:-1])
        return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "start": starts, "tokens": [*cut]})

    return read(files, result, "doc_id long, start long, tokens array<long>")


def digests(
    docs: DataFrame, tokenizer_file: str, pattern: str, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: all documents written to files and read back."""

    def result(ids, starts, sizes, tokens) -> pd.DataFrame:
        ends = np.cumsum(sizes)
        raw = memoryview(tokens.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "start": starts, "n_tokens": sizes, "ids_crc32": np.array(crc, np.int64),
        })

    files = write(docs, tokenizer_file, pattern, folder, id_col, text_col)
    return read(files, result, "doc_id long, start long, n_tokens long, ids_crc32 long")
