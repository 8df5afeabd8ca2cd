"""SimHash near-duplicates by a binary trie self-join.

Fingerprints that differ in at most ``budget`` bits are linked.  The distinct fingerprints
are sorted and cut into trie nodes (ranges of bounded size with their common prefix).  Two
nodes are a pair of work if their prefixes do not already exceed the budget.  Inside a
task, all node pairs descend together, one bit at a time: the differing bits add up, a pair
beyond the budget is dropped, and small pairs are compared outright.  A fingerprint has a
bounded number of neighbours within the budget, so the work grows with the number of
distinct fingerprints, however large a group of copies is.

Defined results: null and empty texts have fingerprint zero and are linked like any other;
rows with the same fingerprint are one class; a null id is kept, and is never the name of a
group that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import components, forest, keyed, parts_for, popcount, stage, words_of

# Fingerprints of one trie node at most; two nodes meet in one row of work.
NODE_ROWS = 4096
# Pairs of nodes with at most so many combinations are compared outright.
OUTRIGHT = 64
# Neighbours of a prefix at most; beyond it a shorter prefix is joined and the rest filtered.
MOST_FLIPS = 512
# Node pairs that descend together at once; bounds the memory of a task.
FRONTIER = 1 << 16


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 hashes (seed 42)."""
    import xxhash

    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[: len(words) - shingle]].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops)], np.uint64)
    votes = np.zeros(64, np.int64)
    for part in np.array_split(h, 1 + len(h) // 65536):
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * votes > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, fp`` (the 64 bits as a signed long) for every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([fingerprint(words_of(t), shingle) for t in batch["text"]], np.uint64)
            out = batch[["doc_id", "text_key"]].astype({"doc_id": "Int64"})
            yield out.assign(fp=values.view(np.int64))

    return keyed(docs, id_col, text_col).mapInPandas(run, "doc_id long, text_key long, fp long")


def _common_prefix(low: int, high: int) -> int:
    return 64 - (int(low) ^ int(high)).bit_length()


def _cut(fps: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """Ranges of sorted fingerprints: trie nodes of NODE_ROWS at most, ``base`` deep at least."""
    todo = [(0, len(fps), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if lo == hi:
            continue
        deep = _common_prefix(fps[lo], fps[hi - 1])
        if hi - lo <= NODE_ROWS and deep >= base:
            yield lo, hi
            continue
        level = max(depth, min(deep, 63))
        bit = np.uint64(1) << np.uint64(63 - level)
        stem = (fps[lo] >> np.uint64(63 - level)) << np.uint64(63 - level) | bit
        mid = lo + int(np.searchsorted(fps[lo:hi], stem))
        todo += [(mid, hi, level + 1), (lo, mid, level + 1)]


def trie_nodes(distinct: DataFrame, base: int, parts: int) -> DataFrame:
    """``stem, depth, fps`` rows from distinct ``fp``: sorted ranges cut into nodes.

    The ranges are of equal size, so a dense region is spread over many of them.  A prefix
    that lies across two ranges gives two nodes, which meet as any other pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b["fp"].to_numpy(np.int64).view(np.uint64) for b in batches]
        if not held:
            return
        fps = np.sort(np.concatenate(held))
        rows = []
        for lo, hi in _cut(fps, base):
            deep = _common_prefix(fps[lo], fps[hi - 1])
            rows.append((int(fps[lo].view(np.int64)), deep, fps[lo:hi].tobytes()))
        yield pd.DataFrame(rows, columns=["stem", "depth", "fps"])

    # flipping the first bit makes the signed order of ranges the unsigned order
    flipped = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return distinct.repartitionByRange(parts, flipped).mapInPandas(run, "stem long, depth int, fps binary")


def _join_nodes(pairs: list[tuple[np.ndarray, np.ndarray]], budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked fingerprints of the node pairs; all pairs descend the trie together."""
    every = np.unique(np.concatenate([x for pair in pairs for x in pair]))
    at = lambda x: (np.searchsorted(every, x[0]), np.searchsorted(every, x[-1]) + 1)
    start = np.array([(*at(a), *at(b)) for a, b in pairs], np.int64)
    todo = [(0, start, np.zeros(len(start), np.int64))]
    while todo:
        level, box, spent = todo.pop()
        if len(box) > FRONTIER:
            half = len(box) // 2
            # the part that waits is a copy, so that the whole can go
            todo += [(level, box[half:].copy(), spent[half:].copy()), (level, box[:half].copy(), spent[:half].copy())]
            del box, spent
            continue
        size = (box[:, 1] - box[:, 0]) * (box[:, 3] - box[:, 2])
        small = (size <= OUTRIGHT) | (level == 64)
        if small.any():
            yield from _outright(every, box[small], budget)
            box, spent = box[~small], spent[~small]
        if not len(box):
            continue
        bit = np.uint64(63 - level)
        mid = []
        for lo, hi in ((box[:, 0], box[:, 1]), (box[:, 2], box[:, 3])):
            stem = ((every[lo] >> bit) | np.uint64(1)) << bit
            mid.append(np.clip(np.searchsorted(every, stem), lo, hi))
        a, b = mid
        sides = [
            (np.array([box[:, 0], a, box[:, 2], b]).T, 0, None),
            (np.array([a, box[:, 1], b, box[:, 3]]).T, 0, None),
            (np.array([box[:, 0], a, b, box[:, 3]]).T, 1, None),
            (np.array([a, box[:, 1], box[:, 2], b]).T, 1, (box[:, 0] != box[:, 2]) | (box[:, 1] != box[:, 3])),
        ]  # a node met with itself needs only one of the two crossed children
        boxes, costs = [], []
        for child, cost, once in sides:
            ok = (child[:, 1] > child[:, 0]) & (child[:, 3] > child[:, 2]) & (spent + cost <= budget)
            ok &= True if once is None else once
            boxes.append(child[ok])
            costs.append(spent[ok] + cost)
        todo.append((level + 1, np.concatenate(boxes), np.concatenate(costs)))


def _outright(every, box, budget):
    na, nb = box[:, 1] - box[:, 0], box[:, 3] - box[:, 2]
    size = na * nb
    for part in np.array_split(np.arange(len(box)), 1 + int(size.sum()) // (1 << 19)):
        n = size[part]
        which = np.repeat(part, n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        a = every[box[which, 0] + k // nb[which]]
        b = every[box[which, 2] + k % nb[which]]
        near = (a < b) & (popcount(a ^ b) <= budget) | (a > b) & (popcount(a ^ b) <= budget)
        yield a[near], b[near]


def linked(distinct: DataFrame, budget: int, label: str = "simhash") -> DataFrame:
    """``(a, b)`` edges that connect all fingerprints within ``budget`` bits of one another.

    Each batch of node pairs gives a spanning forest of its links, never all pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in _unpacked(batches):
            left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for a, b in _join_nodes(pairs, budget):
                if len(a):
                    a, b = forest(a, b)
                    left.append(a)
                    right.append(b)
            a, b = forest(np.concatenate(left), np.concatenate(right))
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return _node_pairs(distinct, budget, label).mapInPandas(run, "a long, b long")


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    for batch in batches:
        for lo in range(0, len(batch), 16):
            part = batch.iloc[lo : lo + 16]
            yield [(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(part["fa"], part["fb"])]


def _node_pairs(distinct: DataFrame, budget: int, label: str) -> DataFrame:
    """``fa, fb``: the fingerprints of every two trie nodes whose prefixes are within the budget."""
    distinct = stage(distinct, label)
    count = distinct.count()
    base = (count // NODE_ROWS).bit_length()
    while base and sum(comb(base, i) for i in range(budget + 1)) > MOST_FLIPS:
        base -= 1
    nodes = stage(trie_nodes(distinct, base, parts_for(count, 8 * NODE_ROWS)), label)
    # the first fingerprint of a node, its stem, is in no other node and so names it
    stem = F.col("stem")
    top = F.shiftrightunsigned(stem, 64 - base) if base else F.lit(0).cast("long")
    mine = nodes.select(stem.alias("a"), F.col("depth").alias("da"), top.alias("top"))
    near = nodes.select(
        stem.alias("b"), F.col("depth").alias("db"),
        F.explode(F.array(*[top.bitwiseXOR(F.lit(f).cast("long")) for f in _flips(base, budget)])).alias("top"),
    )
    shared = F.least("da", "db")
    differing = F.when(shared == 0, 0).otherwise(
        F.bit_count(F.expr("shiftrightunsigned(a ^ b, 64 - least(da, db))"))
    )
    pairs = mine.join(near, "top").filter("a <= b").filter(differing <= budget).select("a", "b")
    fa = nodes.select(stem.alias("a"), F.col("fps").alias("fa"))
    fb = nodes.select(stem.alias("b"), F.col("fps").alias("fb"))
    return pairs.join(fa, "a").join(fb, "b").select("fa", "fb")


def _flips(bits: int, budget: int) -> list[int]:
    return [sum(1 << i for i in c) for n in range(budget + 1) for c in combinations(range(bits), n)]


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of ``near_duplicates``: the least id (null last), then
    the least hash of the text.  Null and empty texts are one group."""
    found = stage(near_duplicates(docs, shingle, budget, id_col, text_col), "simhash")
    last = F.lit((1 << 63) - 1)
    own = F.struct(F.coalesce("doc_id", last).alias("i"), F.col("text_key").alias("k"))
    # the root tells groups apart whose least ids are equal or null
    best = found.groupBy("root").agg(F.min(own).alias("keep"))
    keep = stage(best.select(F.when(F.col("keep.i") != last, F.col("keep.i")).alias("__id"), F.col("keep.k").alias("__key")), "simhash")
    # rows equal in id and text are in one group, and only one of them stays
    times = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1")
    twins = stage(times.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")), "simhash")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__key"))
    left = docs.join(keep, same, "left_semi")
    if twins.isEmpty():
        return left
    return left.join(twins, same, "left_anti").unionByName(left.join(twins, same, "left_semi").dropDuplicates([id_col, text_col]))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` for every row: the least fingerprint and
    the least id reachable."""
    prints = stage(fingerprints(docs, shingle, id_col, text_col), "simhash")
    roots = components(linked(prints.select("fp").distinct(), budget), "simhash")
    # a copy of a fingerprint is one row here, however many documents have it
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = stage(named, "simhash")
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.join(group, "root").select("fp", "root", "component_id")
    return prints.join(names, "fp").select("doc_id", "text_key", "fp", "root", "component_id")
