"""Exact substring deduplication by fixed-block anchors.

A window is ``size`` consecutive words.  A window that starts earlier somewhere else (smaller
id, or earlier in the same document) is a repeat, and the words it covers go.

1. Index: the non-overlapping blocks of size / 2 words of every document.  Any window holds a
   whole block of its document, so of two equal windows each holds the other's block.
2. Probe: every rolling window of a block's length is looked up in the index.  Hashes are
   packed by shard, once for each flush of documents; hashes that a flush holds twice are hits
   at once, so a passage in a third of all documents is one entry for each flush.
3. Extend: the windows around the hits, and only those, are compared by a 96-bit hash of
   their words, which joins overlapping hits to maximal repeats.  The earliest occurrence of
   each stays; all others are covered.  Windows are dealt by the least block hash inside, so
   neighbouring windows travel together.

A flush is named by its partition and number, so ``docs`` must be a scan of files.

Defined results: a null text has no words; a text of fewer words than ``size`` is kept whole; a
null id comes before all others; rows that share an id are ordered by a hash of their text, and
rows equal in both are one document and get its result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import expand, flushes, hashes, keyed, mix, parts_for, runs, text_bytes

FLUSH_CHARS = 8_000_000
# Bytes of text for each shard of the index, and of the repeated windows.
SHARD_BYTES = 16_000_000
TABLE, HITS = 0, 1


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _rolling(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive values."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return mix(out, out)


def _within(sizes: np.ndarray, n: int) -> np.ndarray:
    """Positions where ``n`` words of one document start."""
    starts = np.cumsum(sizes) - sizes
    return expand(starts, np.maximum(sizes - n + 1, 0))


def _hashed(batch: pd.DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and their sizes; texts below ``least`` words count as empty."""
    lists = [_words(t) for t in batch["text"]]
    lists = [x if len(x) >= least else [] for x in lists]
    return hashes([w for x in lists for w in x]), np.array([len(x) for x in lists], np.int64)


def _ids(batch: pd.DataFrame) -> np.ndarray:
    """Ids as numbers, null as the least."""
    return batch["doc_id"].astype("Int64").fillna(np.iinfo(np.int64).min).to_numpy(np.int64)


def _named(ids: np.ndarray) -> pd.Series:
    return pd.Series(ids, dtype="Int64").mask(ids == np.iinfo(np.int64).min)


def _u16(at: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted positions as low halves, and how many there are of each high half."""
    high = np.bincount(at >> 16) if len(at) else np.zeros(0, np.int64)
    return (at & 0xFFFF).astype(np.uint16).tobytes(), high.astype(np.uint32).tobytes()


def _from_u16(low: bytes, high: bytes) -> np.ndarray:
    counts = np.frombuffer(high, np.uint32)
    return np.frombuffer(low, np.uint16).astype(np.int64) + (np.repeat(np.arange(len(counts)), counts) << 16)


def candidates(docs: DataFrame, size: int, shards: int) -> DataFrame:
    """``doc_id, text_key, spans``: ranges of starts of the windows near a hit."""
    block = size // 2

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        length = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
        for k, batch in enumerate(flushes(batches, length, FLUSH_CHARS)):
            flush = part << 32 | k
            h, sizes = _hashed(batch, size)
            if len(h) < size:
                continue
            at = _within(sizes, block)
            value = _rolling(h, block)[at]
            starts = np.cumsum(sizes) - sizes
            offset = at - np.repeat(starts, np.maximum(sizes - block + 1, 0))
            aligned = offset % block == 0
            order = np.argsort(value, kind="stable")
            first = runs(value[order])
            count = np.diff(np.r_[first, len(order)])
            single = np.zeros(len(at), bool)
            single[order[first[count == 1]]] = True
            indexed = np.logical_or.reduceat(aligned[order], first)
            again = value[order[first[(count > 1) & indexed]]]
            low, high = _u16(at[~single])
            table = (flush % shards, flush, TABLE, np.stack([_ids(batch), batch["text_key"].to_numpy(np.int64), sizes]).tobytes(),
                     low, high, b"")
            rows = [table]
            value, at, aligned = value[single], at[single], aligned[single]
            shard = (value & np.uint64(0xFFFFFFFF)) % np.uint64(shards)
            own = (again & np.uint64(0xFFFFFFFF)) % np.uint64(shards)
            order, again = np.argsort(shard, kind="stable"), again[np.argsort(own, kind="stable")]
            met = np.union1d(shard, own)
            ends = [(np.searchsorted(x, met), np.searchsorted(x, met, "right")) for x in (shard[order], np.sort(own))]
            for s, lo, hi, first, last in zip(met.tolist(), *ends[0], *ends[1]):
                mine = order[lo:hi]
                low, high = _u16(at[mine])
                tail = np.r_[value[mine], again[first:last]] >> np.uint64(32)
                flags = np.packbits(aligned[mine]).tobytes()
                rows.append((s, flush, HITS, tail.astype(np.uint32).tobytes(), low, high, flags))
            yield pd.DataFrame(rows, columns=["shard", "flush", "kind", "a", "b", "c", "d"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        probes = rows[rows["kind"] == HITS]
        out = [rows[rows["kind"] == TABLE].drop(columns=["shard", "d"])]
        if len(probes):
            tails = [np.frombuffer(a, np.uint32) for a in probes["a"]]
            singles = [len(b) // 2 for b in probes["b"]]
            flags = [
                np.r_[np.unpackbits(np.frombuffer(d, np.uint8), count=n).astype(bool), np.ones(len(t) - n, bool)]
                for d, n, t in zip(probes["d"], singles, tails)
            ]
            tail, flag = np.concatenate(tails), np.concatenate(flags)
            order = np.argsort(tail, kind="stable")
            first = runs(tail[order])
            of_run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
            total = np.add.reduceat(flag[order].astype(np.int64), first)[of_run]
            hit = np.zeros(len(tail), bool)
            hit[order] = total - flag[order] > 0
            found, before = [], 0
            for r, n, t in zip(probes.itertuples(), singles, tails):
                at = _from_u16(r.b, r.c)[hit[before : before + n]]
                before += len(t)
                if len(at):
                    found.append((r.flush, HITS, b"", *_u16(at)))
            out.append(pd.DataFrame(found, columns=["flush", "kind", "a", "b", "c"]))
        return pd.concat(out, ignore_index=True)

    def spans(rows: pd.DataFrame) -> pd.DataFrame:
        table = rows[rows["kind"] == TABLE]
        if len(table) != 1:
            raise RuntimeError("a flush has lost its table of documents")
        ids, keys, sizes = np.frombuffer(table.iloc[0]["a"], np.int64).reshape(3, -1)
        starts = np.cumsum(sizes) - sizes
        near = np.zeros(int(sizes.sum()) + 1, np.int64)
        for low, high in zip(rows["b"], rows["c"]):
            at = _from_u16(low, high)
            doc = np.searchsorted(starts, at, "right") - 1
            # a window that holds the block at p starts from p - size + block to p
            np.add.at(near, np.maximum(at - size + block, starts[doc]), 1)
            last = np.minimum(at, starts[doc] + sizes[doc] - size)
            np.add.at(near, last + 1, -1)
        open_ = np.cumsum(near) > 0
        edge = np.flatnonzero(np.diff(np.r_[False, open_, False].astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        # a range over the end of a document is cut there
        doc = np.searchsorted(starts, begin, "right") - 1
        last = np.searchsorted(starts, end - 1, "right") - 1
        n = last - doc + 1
        which = expand(doc, n)
        begin, end = np.maximum(np.repeat(begin, n), starts[which]), np.minimum(np.repeat(end, n), starts[which] + sizes[which])
        ok = end > begin
        which, begin, end = which[ok], begin[ok] - starts[which[ok]], end[ok] - starts[which[ok]]
        first = runs(which)
        pairs = np.stack([begin, end], axis=1).astype(np.int32)
        packed = [p.tobytes() for p in np.split(pairs, first[1:])] if len(first) else []
        return pd.DataFrame({"doc_id": _named(ids[which[first]]), "text_key": keys[which[first]], "spans": packed})

    columns = "kind tinyint, a binary, b binary, c binary"
    asked = docs.mapInPandas(ask, f"shard int, flush long, {columns}, d binary")
    answers = asked.repartitionById(shards, F.col("shard")).groupBy("shard").applyInPandas(answer, f"flush long, {columns}")
    found = answers.repartition(shards, "flush").groupBy("flush")
    # rows equal in id and text have equal spans
    return found.applyInPandas(spans, "doc_id long, text_key long, spans binary").dropDuplicates(["doc_id", "text_key"])


def repeats(near: DataFrame, size: int, shards: int) -> DataFrame:
    """``doc_id, text_key, at``: starts of the windows that start earlier elsewhere, one row for
    each document of ``near(doc_id, text_key, text, spans)`` that has any.

    A shard judges the windows dealt to it and sends what goes to the homes of the documents,
    packed in one row for each home; a home is a share of the documents by a hash of their ids."""
    block = size // 2

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
        for batch in flushes(batches, length, FLUSH_CHARS):
            h, sizes = _hashed(batch, size)
            starts = np.cumsum(sizes) - sizes
            pairs = [np.frombuffer(s, np.int32).reshape(-1, 2).astype(np.int64) for s in batch["spans"]]
            doc = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
            pairs = np.concatenate(pairs)
            width = pairs[:, 1] - pairs[:, 0]
            at, doc = expand(pairs[:, 0] + starts[doc], width), np.repeat(doc, width)
            inside = _rolling(h, block)
            least = inside[: len(h) - size + 1].copy()
            for k in range(1, size - block + 1):
                np.minimum(least, inside[k : k + len(least)], out=least)
            one, two = _rolling(h, size)[at], (_rolling(mix(h, h), size)[at] >> np.uint64(32)).astype(np.uint32)
            ids, keys = _ids(batch)[doc], batch["text_key"].to_numpy(np.int64)[doc]
            pos = (at - starts[doc]).astype(np.uint32)
            lost = _later(one, two, ids, keys, pos)
            # repeats within a flush are settled and go home; the first of each is judged
            yield from _sent(JUDGED, least[at] % np.uint64(shards), one, two, ids, keys, pos, ~lost)
            yield from _sent(SETTLED, _home(ids, keys, shards), one, two, ids, keys, pos, lost)

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        settled = rows[rows["kind"] == SETTLED]
        open_ = rows[rows["kind"] == JUDGED]
        if not len(open_):
            return settled
        one, two, ids, keys, pos = (np.concatenate([np.frombuffer(x, k) for x in open_[n]]) for n, k in _COLUMNS)
        lost = _later(one, two, ids, keys, pos)
        return pd.concat([settled, *_sent(SETTLED, _home(ids, keys, shards), one, two, ids, keys, pos, lost)])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return _by_document(*(np.concatenate([np.frombuffer(x, k) for x in rows[n]]) for n, k in _COLUMNS[2:]))

    schema = "kind tinyint, shard int, one binary, two binary, ids binary, keys binary, pos binary"
    judged = near.mapInPandas(ask, schema).repartitionById(shards, F.col("shard")).groupBy("shard").applyInPandas(judge, schema)
    homes = judged.select("shard", "ids", "keys", "pos").repartitionById(shards, F.col("shard")).groupBy("shard")
    return homes.applyInPandas(gather, "doc_id long, text_key long, at binary")


JUDGED, SETTLED = 0, 1


def _home(ids: np.ndarray, keys: np.ndarray, homes: int) -> np.ndarray:
    return mix(ids.view(np.uint64), keys.view(np.uint64)) % np.uint64(homes)


_COLUMNS = (("one", np.uint64), ("two", np.uint32), ("ids", np.int64), ("keys", np.int64), ("pos", np.uint32))


def _later(one, two, ids, keys, pos) -> np.ndarray:
    """Which windows have an equal one before them."""
    order = np.lexsort((pos, keys, ids, two, one))
    new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    lost = np.zeros(len(one), bool)
    lost[order] = (ids[order] != ids[head]) | (keys[order] != keys[head]) | (pos[order] != pos[head])
    return lost


def _sent(kind: int, shard, one, two, ids, keys, pos, which) -> Iterator[pd.DataFrame]:
    """The windows of the mask ``which``, packed in one row for each shard; settled ones need no hashes."""
    picked = np.flatnonzero(which)
    if not len(picked):
        return
    picked = picked[np.lexsort((pos[picked], keys[picked], ids[picked], shard[picked]))]
    parts = np.split(picked, runs(shard[picked])[1:])
    told = kind == JUDGED
    yield pd.DataFrame({
        "kind": kind, "shard": [int(shard[p[0]]) for p in parts],
        "one": [one[p].tobytes() if told else b"" for p in parts],
        "two": [two[p].tobytes() if told else b"" for p in parts],
        "ids": [ids[p].tobytes() for p in parts], "keys": [keys[p].tobytes() for p in parts],
        "pos": [pos[p].tobytes() for p in parts],
    })


def _by_document(ids, keys, pos) -> pd.DataFrame:
    order = np.lexsort((pos, keys, ids))
    ids, keys, pos = ids[order], keys[order], pos[order]
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])])
    parts = [p.tobytes() for p in np.split(pos, first[1:])]
    return pd.DataFrame({"doc_id": _named(ids[first]), "text_key": keys[first], "at": parts})


def kept_words(docs: DataFrame, result, schema: str, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``result(batch, words, gone)`` for every row: lists of words and masks of those that go."""
    scan = keyed(docs, id_col, text_col)
    shards = parts_for(text_bytes(scan), SHARD_BYTES)
    spans = candidates(scan, size, shards)
    same = F.expr("d.doc_id <=> x.doc_id and d.text_key = x.text_key")
    near = scan.alias("d").join(spans.alias("x"), same).select("d.doc_id", "d.text_key", "d.text", "x.spans")
    all_ = scan.alias("d").join(repeats(near, size, shards).alias("x"), same, "left").select("d.doc_id", "d.text_key", "d.text", "x.at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [_words(t) for t in batch["text"]]
            gone = []
            for own, at in zip(words, batch["at"]):
                change = np.zeros(len(own) + size + 1, np.int64)
                if at is not None:
                    pos = np.frombuffer(at, np.uint32).astype(np.int64)
                    np.add.at(change, pos, 1)
                    np.add.at(change, pos + size, -1)
                gone.append(np.cumsum(change)[: len(own)] > 0)
            yield result(batch, words, gone)

    return all_.mapInPandas(run, schema)


def digests(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""

    def result(batch, words, gone) -> pd.DataFrame:
        from hashlib import sha256

        kept = [b" ".join([w for w, g in zip(own, out.tolist()) if not g]) if out.any() else b" ".join(own) for own, out in zip(words, gone)]
        return pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "n_words": [len(x) for x in words],
            "n_removed": [int(x.sum()) for x in gone], "kept_sha256": [sha256(k).hexdigest() for k in kept],
        })

    return kept_words(docs, result, "doc_id long, n_words long, n_removed long, kept_sha256 string", size, id_col, text_col)
