"""Language-model scores from an interpolated modified Kneser-Ney n-gram model.

Counting.  The documents of a partition are read in flushes; a flush sends each of its
n-grams once, with its count, to the shard of the n-gram's context; what goes to one shard
lists its tokens once, and the n-grams as sorted places in that list.  A shard adds the counts
up, writes its n-grams and contexts as sorted hash arrays into the shared folder, and sends
every distinct n-gram on as one continuation count of the next lower order.  The contexts
that a sample shows to be frequent (and the empty one) are dealt by the whole n-gram, so that
no shard gathers them; their sums are added up from all shards.  The sample decides where
rows go, never what they hold.

Scoring.  Workers map the arrays into memory and look the n-grams of a flush up in sorted
order.  So the shared folder must be a mounted one, whatever it is mounted from; any other is
refused.  A file is written under another name and moved into place whole, so a task may run
twice.

Defined results: a null or empty text has the end token alone; an unknown word shares the
mass of order one with all words alike; every row is scored, repeated rows alike; a model
without any training text gives every token the same probability.  Discounts whose counts of
counts are zero are 0.5, 1 and 1.5.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import work_path
from .common import drop_stages, flushes, hashes, mix, parts_for, runs, settle, staged_so_far, words_of

FLUSH_CHARS = 16_000_000
SHARD_BYTES = 24_000_000
# Documents whose contexts decide which ones are dealt by the whole n-gram.
SAMPLE_DOCS = 2000
START, END = (np.uint64(x) for x in hashes([b" start", b" end"]))
_NGRAMS, _STATS = 0, 1


@dataclass
class Model:
    """Where the arrays are, the sums over all shards, and the frequent contexts' sums."""

    folder: str
    order: int
    shards: int
    tokens: int = 0
    words: int = 0
    hot: dict[int, np.ndarray] = field(default_factory=dict)
    hot_sums: dict[int, np.ndarray] = field(default_factory=dict)
    discounts: dict[int, np.ndarray] = field(default_factory=dict)


def mounted(path: str) -> str:
    """The shared folder as a path that workers can open."""
    at = urlparse(path)
    if at.scheme not in ("", "file"):
        raise ValueError(f"the n-gram arrays need a mounted shared folder, not {at.scheme}:")
    return unquote(at.path)


def _tokens(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end token closing each text, and the texts' sizes."""
    parts, sizes = [], []
    for lo in range(0, len(batch), 256):
        lists = [words_of(t) for t in batch["text"].iloc[lo : lo + 256]]
        h = hashes([w for x in lists for w in x])
        n = np.array([len(x) for x in lists], np.int64)
        parts.append(np.insert(h, np.cumsum(n), END))
        sizes.append(n + 1)
    return np.concatenate(parts), np.concatenate(sizes)


def _before(h: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """The tokens 1, ... order - 1 places before each; start signs stand before a text."""
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(h))
    out = []
    for m in range(1, order):
        before = np.full(len(h), START)
        before[m:] = h[: len(h) - m]
        before[at - m < starts] = START
        out.append(before)
    return out


def _folded(before: list[np.ndarray], n: int) -> list[np.ndarray]:
    """Hash of none, the nearest, the nearest two, ... of the tokens before each of ``n``."""
    out = [np.zeros(n, np.uint64)]
    for tokens in before:
        out.append(mix(out[-1], tokens))
    return out


def _contexts(h: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the 0, 1, ... order - 1 tokens before each."""
    return _folded(_before(h, sizes, order), len(h))


def _deal(ctx: np.ndarray, key: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    spread = np.isin(ctx, hot) if len(hot) else np.zeros(len(ctx), bool)
    return np.where(spread, key, mix(ctx, ctx)) % np.uint64(shards)


def _planes(x: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next, ..."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _pack(level: int, top: int, shard: np.ndarray, before: list[np.ndarray], word, count, raw) -> Iterator[tuple]:
    """Rows for the shards of a level.  A row lists its tokens once, the frequent ones first,
    and names them by their places in that list."""
    import zlib

    order = np.argsort(shard, kind="stable")
    cuts = runs(shard[order])
    for part in np.split(order, cuts[1:]) if len(order) else []:
        n = len(part)
        tokens, place, times = np.unique(
            np.concatenate([x[part] for x in (*before, word)]), return_inverse=True, return_counts=True
        )
        rank = np.argsort(-times, kind="stable")
        named = np.empty(len(rank), np.uint32)
        named[rank] = np.arange(len(rank), dtype=np.uint32)
        columns = named[place].reshape(level, n)
        rows = np.lexsort(columns[::-1])
        columns = columns[:, rows]
        columns[0, 1:] -= columns[0, :-1].copy()
        planes = [_planes(np.ascontiguousarray(x)) for x in columns] + [_planes(count[part][rows].astype(np.uint32))]
        if level < top:
            planes.append(_planes(raw[part][rows].astype(np.uint64)))
        sizes = np.array([n, len(tokens)], np.uint64).tobytes()
        yield int(shard[part[0]]), _NGRAMS, b"", sizes + tokens[rank].tobytes() + zlib.compress(b"".join(planes), 1)


_COLUMNS = ["shard", "kind", "ctx", "data"]
_SCHEMA = "shard int, kind tinyint, ctx binary, data binary"


def _unpack(rows: pd.DataFrame, level: int, top: int):
    """The tokens before (the nearest first), the words, their counts and raw counts."""
    import zlib

    parts = []
    for data in rows["data"]:
        n, many = (int(x) for x in np.frombuffer(data, np.uint64, 2))
        tokens = np.frombuffer(data, np.uint64, many, 16)
        planes, at, own = zlib.decompress(memoryview(data)[16 + 8 * many :]), 0, []
        for kind in [np.uint32] * (level + 1) + [np.uint64] * (level < top):
            size = np.dtype(kind).itemsize
            x = np.frombuffer(planes, np.uint8, n * size, at).reshape(size, n)
            own.append(np.ascontiguousarray(x.T).view(kind)[:, 0])
            at += n * size
        own[0] = np.cumsum(own[0], dtype=np.uint32)
        own[:level] = [tokens[x] for x in own[:level]]
        parts.append([*own[:level], own[level].astype(np.uint64), own[-1].astype(np.uint64)])
    *before, word, count, raw = (np.concatenate(x) for x in zip(*parts))
    return before, word, count, raw


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _write_coded(path: str, name: str, array: np.ndarray) -> None:
    """Values that come again and again: the distinct ones, and for each row which it is."""
    key = array
    if array.ndim > 1:
        key = array[:, 0]
        for k in range(1, array.shape[1]):
            key = mix(key, array[:, k])
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    _write(f"{path}.{name}-values.npy", array[first])
    _write(f"{path}.{name}.npy", _narrow(which))


def _write(path: str, array: np.ndarray) -> None:
    import uuid

    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, path)


def _sums(ctx: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each context (sorted): the sum of counts, and how many n-grams have count 1, 2, 3+."""
    order = np.argsort(ctx, kind="stable")
    first = runs(ctx[order])
    count = count[order]
    add = lambda x: np.add.reduceat(x.astype(np.uint64), first) if len(first) else np.zeros(0, np.uint64)
    return ctx[order[first]], np.stack([add(count), add(count == 1), add(count == 2), add(count >= 3)], axis=1)


def fit(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count the n-grams of all ``docs`` and write the model's arrays."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_docs, size = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    shards = parts_for(size or 0, SHARD_BYTES)
    folder = mounted(work_path(spark, "ngrams"))
    hot = _frequent(texts, order, shards, min(1.0, SAMPLE_DOCS / max(1, n_docs)))
    model = Model(folder, order, shards, hot=hot)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
        for batch in flushes(batches, length, FLUSH_CHARS):
            h, sizes = _tokens(batch)
            before = _before(h, sizes, order)
            ctx = _folded(before, len(h))[-1]
            key = mix(ctx, h)
            order_ = np.argsort(key, kind="stable")
            first = runs(key[order_])
            count = np.diff(np.r_[first, len(key)])
            at = order_[first]
            shard = _deal(ctx[at], key[at], hot[order], shards)
            yield pd.DataFrame(list(_pack(order, order, shard, [x[at] for x in before], h[at], count, count)), columns=_COLUMNS)

    mark = staged_so_far()
    rows = texts.select("text").mapInPandas(ask, _SCHEMA)
    for level in range(order, 0, -1):
        # written, so that the shuffle files of a level are gone before the next one begins
        rows = rows.repartition(shards, "shard").groupBy("shard").applyInPandas(_reducer(model, level), _SCHEMA)
        rows = settle(spark, rows, "ngram-rows", mark)
    found = rows.filter(F.col("kind") == _STATS).select("shard", "ctx", "data").toPandas()
    drop_stages(spark, mark)
    totals: dict[int, np.ndarray] = {}
    sums: dict[int, dict[int, np.ndarray]] = {m: {} for m in range(1, order + 1)}
    for level, ctx, stats in zip(found["shard"], found["ctx"], found["data"]):
        values = np.frombuffer(stats, np.uint64)
        if ctx is None or not len(ctx):
            totals[-level] = totals.get(-level, 0) + values
        else:
            own = int(np.frombuffer(ctx, np.uint64)[0])
            sums[-level][own] = sums[-level].get(own, 0) + values
    for level in range(1, order + 1):
        total = totals.get(level, np.zeros(6, np.uint64))
        model.discounts[level] = _discounts(total[:4].astype(float))
        model.hot_sums[level] = np.array(
            [sums[level].get(int(c), np.zeros(4, np.uint64)) for c in hot[level]], float
        ).reshape(-1, 4)
    model.words, model.tokens = (int(x) for x in totals.get(1, np.zeros(6, np.uint64))[4:])
    return model


def _discounts(n: np.ndarray) -> np.ndarray:
    """Of counts 0, 1, 2 and 3+, from the counts of counts 1 to 4."""
    out = np.array([0, 0.5, 1, 1.5])
    if (n > 0).all():
        y = n[0] / (n[0] + 2 * n[1])
        out[1:] = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return np.clip(out, [0, 0.01, 0.01, 0.01], [0, 1, 2, 3])


def _frequent(texts: DataFrame, order: int, shards: int, share: float) -> dict[int, np.ndarray]:
    """Contexts of each level that make up over a quarter of a shard in the sample; sorted."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, sizes = _tokens(batch)
            for level, ctx in enumerate(_contexts(h, sizes, order), 1):
                value, n = np.unique(ctx, return_counts=True)
                yield pd.DataFrame({"level": level, "ctx": value.view(np.int64), "n": n})

    out = {1: np.zeros(1, np.uint64)} | {m: np.zeros(0, np.uint64) for m in range(2, order + 1)}
    if shards > 1 and order > 1:
        seen = texts.filter(place < share).select("text").mapInPandas(count, "level int, ctx long, n long")
        seen = seen.filter("level > 1").groupBy("level", "ctx").agg(F.sum("n").alias("n"))
        total = F.sum("n").over(_by("level"))
        # more than 4 shards of contexts above 1 / (4 shards) there cannot be
        for level, own in seen.withColumn("total", total).filter(F.col("n") * 4 * shards > F.col("total")).toPandas().groupby("level"):
            out[level] = np.sort(own["ctx"].to_numpy(np.int64).view(np.uint64))
    return out


def _by(name: str):
    from pyspark.sql import Window

    return Window.partitionBy(name)


def _reducer(model: Model, level: int):
    hot, lower = model.hot[level], model.hot.get(level - 1)

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        out = [tuple(r) for r in rows[rows["kind"] == _STATS][_COLUMNS].itertuples(index=False)]
        rows = rows[rows["kind"] == _NGRAMS]
        if not len(rows):
            return pd.DataFrame(out, columns=_COLUMNS)
        shard = int(rows["shard"].iloc[0])
        before, word, count, raw = _unpack(rows, level, model.order)
        folded = _folded(before, len(word))
        ctx, up = folded[-1], folded[max(0, level - 2)]
        key = mix(ctx, word)
        order = np.argsort(key, kind="stable")
        first = runs(key[order])
        count, raw = (np.add.reduceat(x[order], first) for x in (count, raw))
        at = order[first]
        key, ctx, up, word, before = key[at], ctx[at], up[at], word[at], [x[at] for x in before[:-1]]
        base = f"{model.folder}/{level}/{shard % 1000}/{shard}"
        _write(f"{base}.keys.npy", key)
        _write_coded(base, "counts", count)
        if level == 1:
            _write_coded(base, "raw", raw)
        own, sums = _sums(ctx, count)
        spread = np.isin(own, hot)
        _write(f"{base}.contexts.npy", own[~spread])
        _write_coded(base, "sums", sums[~spread])
        few = [int((count == k).sum()) for k in (1, 2, 3, 4)]
        out.append((-level, _STATS, b"", np.array([*few, len(key), int(raw.sum())], np.uint64).tobytes()))
        for c, s in zip(own[spread], sums[spread]):
            out.append((-level, _STATS, c.tobytes(), s.tobytes()))
        if level > 1:
            # one row here for each (shorter context, word): how many n-grams end in it
            end = mix(up, word)
            order = np.argsort(end, kind="stable")
            first = runs(end[order])
            at = order[first]
            n = np.diff(np.r_[first, len(end)])
            total = np.add.reduceat(raw[order], first)
            dealt = _deal(up[at], end[at], lower, model.shards)
            out += _pack(level - 1, model.order, dealt, [x[at] for x in before], word[at], n, total)
        return pd.DataFrame(out, columns=_COLUMNS)

    return reduce


class Lookup:
    """The arrays of a model, mapped into memory as they are asked for."""

    def __init__(self, model: Model):
        self.model = model
        self.maps: dict[tuple, np.ndarray] = {}

    def _map(self, level: int, shard: int, name: str) -> np.ndarray | None:
        at = (level, shard, name)
        if at not in self.maps:
            path = f"{self.model.folder}/{level}/{shard % 1000}/{shard}.{name}.npy"
            self.maps[at] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.maps[at]

    def find(self, level: int, shard: np.ndarray, key: np.ndarray, names: str, *values: str) -> list[np.ndarray]:
        """The values of sorted distinct keys; 0 where a key is not there."""
        out = [None] * len(values)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, runs(shard[order])[1:]) if len(order) else []:
            keys = self._map(level, int(shard[part[0]]), names)
            if keys is None or not len(keys):
                continue
            at = np.searchsorted(keys, key[part])
            at[at == len(keys)] = 0
            hit = keys[at] == key[part]
            for i, name in enumerate(values):
                which = self._map(level, int(shard[part[0]]), name)
                table = self._map(level, int(shard[part[0]]), f"{name}-values")
                if out[i] is None:
                    out[i] = np.zeros((len(key), *table.shape[1:]), np.float64)
                out[i][part[hit]] = table[which[at[hit]]]
        return out

    def level(self, level: int, ctx: np.ndarray, word: np.ndarray):
        """Of every token: its count and its context's sums (and its raw count at level 1)."""
        model, hot = self.model, self.model.hot[level]
        key, back = np.unique(mix(ctx, word), return_inverse=True)
        at = np.zeros(len(key), np.int64)
        at[back] = np.arange(len(back))
        values = ("counts", "raw") if level == 1 else ("counts",)
        found = self.find(level, _deal(ctx[at], key, hot, model.shards), key, "keys", *values)
        found = [np.zeros(len(key)) if x is None else x for x in found]
        own, to = np.unique(ctx, return_inverse=True)
        (sums,) = self.find(level, _deal(own, own, hot[:0], model.shards), own, "contexts", "sums")
        sums = np.zeros((len(own), 4)) if sums is None else sums
        if len(hot):
            place = np.searchsorted(hot, own)
            place[place == len(hot)] = 0
            spread = hot[place] == own
            sums[spread] = model.hot_sums[level][place[spread]]
        return [x[back] for x in found], sums[to]


def score_tokens(lookup: Lookup, h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each token, and how often it occurs in training."""
    model = lookup.model
    p = np.full(len(h), 1 / (model.words + 1))
    raw = np.zeros(len(h))
    for level, ctx in enumerate(_contexts(h, sizes, model.order), 1):
        found, sums = lookup.level(level, ctx, h)
        if level == 1:
            raw = found[1]
        d = model.discounts[level]
        count, total = found[0], sums[:, 0]
        own = np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0)
        seen = total > 0
        safe = np.where(seen, total, 1)
        p = np.where(seen, own / safe + (sums[:, 1:] @ d[1:]) / safe * p, p)
    return p, raw


def score(docs: DataFrame, model: Model, keep: dict[str, Column] | None = None, text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` (by default ``doc_id``) and ``n_tokens, n_known, base_score,
    score`` (log10 of the text's probability) of every row."""
    keep = keep or {"doc_id": F.col("doc_id")}
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).cast("string").alias("text"))
    names = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(model)
        length = lambda b: b["text"].str.len().fillna(0).astype(int) + 1
        for batch in flushes(batches, length, FLUSH_CHARS // 2):
            if not len(batch):
                continue
            h, sizes = _tokens(batch)
            p, raw = score_tokens(lookup, h, sizes)
            add = lambda x: np.add.reduceat(x, np.cumsum(sizes) - sizes)  # noqa: E731, B023
            base = np.log10((raw + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
            out = batch[names].copy()
            out["n_tokens"], out["n_known"] = sizes, add((raw > 0).astype(np.int64))
            out["base_score"], out["score"] = add(base), add(np.log10(p))
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInPandas(run, f"{schema}, n_tokens long, n_known long, base_score double, score double")
