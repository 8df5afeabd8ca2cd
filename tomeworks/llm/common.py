"""Helpers that several operators share: keys, sizes, packed arrays and components."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .. import session
from ..session import drop_stages, staged_so_far

__all__ = ["stage", "settle", "staged_so_far", "drop_stages"]

WORD = r"[^\x20\x09-\x0D]+"


#: Spark removes the shuffle files of a query as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _tidily(write, spark):
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return write()
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """``session.stage``, and the shuffle files of that write are removed once it has ended:
    the copy in the shared folder is read from then on, never those files."""
    return _tidily(lambda: session.stage(df, label), df.sparkSession)


def settle(spark, df: DataFrame, label: str, since: int) -> DataFrame:
    """``session.settle`` likewise."""
    return _tidily(lambda: session.settle(spark, df, label, since), spark)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, text`` alone: other columns and their names cannot clash.

    ``text_key`` tells rows apart that share an id.  Rows equal in both are one document.
    """
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def parts_for(size: int, each: int, least: int = 1) -> int:
    """How many parts of ``each`` make up ``size``; the count grows with the data."""
    return max(least, math.ceil(size / each))


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z in lower case; words are what stands between ASCII white space."""
    return text.encode().lower().split() if text else []


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs (the finalizer of splitmix64 over a linear combination)."""
    with np.errstate(over="ignore"):
        x = np.asarray(a, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, np.uint64)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Numbers(dict):
    """Numbers new words in the order they come."""

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        return number


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions of the ranges [start, start + count), one range after another."""
    total = int(counts.sum())
    before = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total) - before + np.repeat(starts, counts)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges: every node with the least node of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            break
        low, high = np.minimum(rx[open_], ry[open_]), np.maximum(rx[open_], ry[open_])
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node it reaches.

    Random contraction: in each round every node moves to the neighbour (or itself) with the
    least value of a hash that changes from round to round, and the edges between what is
    left are taken on.  The rounds are about logarithmic in the number of nodes for any
    shape, a hub included.  Each round is written to the shared folder, so a lost executor
    costs one round.  Nodes are any type that Spark can order.
    """
    kind = edges.select("a").schema[0].dataType
    spark = edges.sparkSession
    live = stage(
        edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        label,
    )
    moves: list[DataFrame] = []
    salt = 0
    while not live.isEmpty():
        salt += 1
        both = live.union(live.select("b", "a"))
        weigh = lambda c: F.struct(F.xxhash64(c, F.lit(salt)), F.col(c))
        best = both.groupBy("a").agg(F.min(weigh("b")).alias("other"))
        own = weigh("a")
        to = F.when(F.col("other") < own, F.col("other.b")).otherwise(F.col("a"))
        move = stage(best.select(F.col("a").alias("node"), to.alias("to")), label)
        moves.append(move)
        left = move.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        live = stage(
            live.join(left, "a").join(right, "b").filter("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            label,
        )
    if not moves:
        return spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    path = moves[0]
    for move in moves[1:]:
        step = move.select(F.col("node").alias("to"), F.col("to").alias("next"))
        path = path.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    path = stage(path, label)
    least = path.groupBy("to").agg(F.min("node").alias("root"))
    return path.join(least, "to").select("node", "root")


def flushes(batches: Iterable[pd.DataFrame], size, limit: int) -> Iterator[pd.DataFrame]:
    """Regroup the batches of a partition into frames whose ``size(frame)`` sums to ``limit``
    at most; a row beyond it stands alone."""
    held, total = [], 0
    for batch in batches:
        sizes = size(batch)
        start = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                held.append(batch.iloc[start:i])
                yield pd.concat(held, ignore_index=True)
                held, total, start = [], 0, i
            total += n
        held.append(batch.iloc[start:])
    if total or any(len(x) for x in held):
        yield pd.concat(held, ignore_index=True)


def by_length(column: str):
    """The size of each row for ``flushes``: the length of its text."""
    return lambda batch: batch[column].str.len().fillna(0).astype(int) + 1
