"""Nearest records by embedding for query tables of any size: exact, in blocks, pruned by pivots.

``vectors.nearest`` sends its queries to every task.  Here queries and vectors are both rows of
bounded blocks.  The angle between two vectors is a distance, so by the triangle inequality the
angles to a pivot bound the angle of a pair from both sides:

1. PIVOTS vectors, the least by a hash of the id, are pivots.  They are all that the driver holds.
2. Every vector goes to the cell of its nearest pivot.  Cells are sorted by the angle to it and cut
   into blocks, so a cell with a third of all vectors is many blocks.
3. Every block of queries is scored against the SEEDS blocks with the least upper bounds.  The k-th
   best score so far is the least score that a vector must reach.
4. Of the other blocks only those are scored whose lower bound does not exceed that angle.

A pair of blocks takes the queries of one to the vectors of the other, so the bytes that are moved
are those of the table times its blocks: blocks grow with the table as far as a task can hold
some, and only beyond that does their number grow.

How much is pruned follows from the data: vectors in clusters are, evenly spread directions of many
dimensions hardly so.  The list of block pairs has one narrow row each; blocks meet by joins.

Defined results: scores are rounded to 12 digits and ties go to the smaller id (null first); vectors
that are null, empty or hold null or non-finite components take no part; a zero vector scores 0;
a query of that kind or of another length fails the job, as does a vector of another length; every
query row is answered, also if its id repeats; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

PIVOTS = 32
SEEDS = 4
# Bytes of the vectors of a block, at least and at most; between them a table makes BLOCKS blocks.
BLOCK_BYTES, LARGEST_BYTES = 256 * 1024, 4 << 20
BLOCKS = 48
# Blocks that a task packs at most, and at least if its vectors are more than the bytes.
BLOCKS_PER_TASK, PACKED_BLOCKS, PACKED_BYTES = 16, 4, 4 << 20
# Scores of a pair of blocks that a task holds at once.
SCORES_AT_ONCE = 2_000_000
DIGITS = 12
# More than the rounding of an angle can be.
_SLACK = 1e-5


def neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_column: str = "query_id",
) -> DataFrame:
    """The ``k`` vectors with the highest cosine to each query: (query, id, place)."""
    stored = _finite(vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v")))
    asked = queries.select(F.col(query_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    first = stored.select(F.size("v")).first()
    if first is None:
        kinds = [(c, df.schema[c].dataType.simpleString()) for df, c in ((queries, query_column), (vectors, id_column))]
        return vectors.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in kinds) + ", place int")
    stored = _checked(stored, F.size("v") == first[0], f"a vector is not of length {first[0]}")
    sound = (F.size("v") == first[0]) & _sound() & F.exists("v", lambda x: x != 0)
    asked = _checked(asked, sound, f"a query is null, zero, not finite or not of length {first[0]}")

    pivots = _pivots(stored, first[0])
    blocks = _blocks(stored, pivots, first[0])
    groups = _blocks(asked, pivots, first[0])
    pairs = stage(_bounds(groups, blocks), "neighbours")
    least = Window.partitionBy("g").orderBy("upper", "b")
    seeds = pairs.withColumn("place", F.row_number().over(least)).where(F.col("place") <= SEEDS)
    seeds = stage(seeds.select("g", "b"), "neighbours")
    best = Window.partitionBy("g", "i").orderBy(F.desc("score"), F.asc("id"))
    near = stage(_scored(seeds, groups.withColumn("floors", F.lit(None).cast("map<int,double>")), blocks, k), "neighbours")
    floors = stage(_floors(near.withColumn("place", F.row_number().over(best)).where(F.col("place") == k)), "neighbours")

    rest = worth_scoring(pairs, groups, floors).join(seeds, ["g", "b"], "left_anti")
    more = _scored(rest, groups.join(floors.select(F.col("g").alias("b"), "floors"), "b", "left"), blocks, k)
    ranked = near.union(more).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    names = groups.select(F.col("b").alias("g"), F.posexplode("ids").alias("i", query_column))
    return ranked.join(names, ["g", "i"]).select(query_column, F.col("id").alias(id_column), "place")


def worth_scoring(pairs: DataFrame, groups: DataFrame, floors: DataFrame) -> DataFrame:
    """The pairs of blocks that may hold one of the k nearest: where not all queries of a block have
    k vectors yet, or the lower bound is within the angle of the least k-th score."""
    sizes = groups.select(F.col("b").alias("g"), F.col("n").alias("asked"))
    known = pairs.join(sizes, "g").join(floors.select("g", "known", "least"), "g", "left")
    widest = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "least"))) + _SLACK
    near = (F.coalesce("known", F.lit(0)) < F.col("asked")) | (F.col("lower") <= widest)
    return known.where(near).select("g", "b")


def _sound() -> Column:
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False)) & (F.size("v") > 0)


def _finite(df: DataFrame) -> DataFrame:
    return df.where(_sound())


def _checked(df: DataFrame, holds: Column, message: str) -> DataFrame:
    return df.where(F.when(F.coalesce(holds, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def _pivots(stored: DataFrame, dims: int) -> np.ndarray:
    """Unit vectors, PIVOTS at most; the first axis if no vector has a direction."""
    nonzero = stored.where(F.exists("v", lambda x: x != 0))
    rows = nonzero.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    if not rows:
        return np.eye(1, dims)
    return np.unique(_units(np.array([r["v"] for r in rows], float).reshape(-1, dims)), axis=0)


def _units(m: np.ndarray) -> np.ndarray:
    # the largest component first, so that no square overflows or vanishes
    m = m / np.maximum(np.abs(m).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), np.finfo(float).tiny)


def _blocks(rows: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """``b, cell, low, high, n, ids, data, to_low, to_high``: blocks of vectors of one cell by their
    angle to its pivot, with the least and largest angle to every pivot.  Zero vectors, which have
    no direction, are in a cell of their own behind the last, a right angle away from all."""
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = _units(np.array(batch["v"].tolist(), float).reshape(-1, dims))
            cell, angle = np.full(len(unit), len(pivots)), np.zeros(len(unit))
            real = np.flatnonzero(unit.any(axis=1))
            if len(real):
                to = np.arccos(np.clip(unit[real] @ pivots.T, -1, 1))
                cell[real] = to.argmin(axis=1)
                angle[real] = to.min(axis=1)
            yield pd.DataFrame({"id": batch["id"], "unit": [u.tobytes() for u in unit], "cell": cell, "angle": angle})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 32
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby((batch["cell"].diff() != 0).cumsum()):
                if held and held[0]["cell"].iat[0] != part["cell"].iat[0]:
                    yield one(name, held)
                    held, name = [], name + 1
                while len(part):
                    room = most - sum(map(len, held))
                    held.append(part.iloc[:room])
                    part = part.iloc[room:]
                    if sum(map(len, held)) == most:
                        yield one(name, held)
                        held, name = [], name + 1
        if held:
            yield one(name, held)

    def one(name: int, held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held).sort_values("id", na_position="first", kind="stable")
        unit = np.frombuffer(b"".join(rows["unit"]), float).reshape(-1, dims)
        to = np.arccos(np.clip(unit @ pivots.T, -1, 1))
        zero = np.full((len(rows), 1), pi / 2)
        to = np.hstack([to, zero])
        return pd.DataFrame({
            "b": [name], "cell": rows["cell"].iat[0], "low": rows["angle"].min(), "high": rows["angle"].max(),
            "n": len(rows), "ids": [rows["id"].tolist()], "data": [unit.tobytes()],
            "to_low": [to.min(axis=0)], "to_high": [to.max(axis=0)],
        })

    rows = rows.mapInPandas(place, f"id {kind}, unit binary, cell int, angle double")
    rows = stage(rows, "neighbours")
    found = rows.count()
    block_bytes = max(BLOCK_BYTES, min(LARGEST_BYTES, 8 * dims * found // BLOCKS))
    most = max(1, block_bytes // (8 * dims))
    per_task = min(BLOCKS_PER_TASK, max(PACKED_BLOCKS, PACKED_BYTES // block_bytes))
    parts = max(1, -(-found // (per_task * most)))
    order = ["cell", "angle", "id"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stage(
        dealt.mapInPandas(
            pack,
            f"b long, cell int, low double, high double, n int, ids array<{kind}>, data binary, "
            "to_low array<double>, to_high array<double>",
        ),
        "neighbours",
    )


def _bounds(groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """``g, b, lower, upper``: bounds of the angles between the vectors of two blocks."""
    ways = groups.select(
        F.col("b").alias("g"), F.posexplode(F.arrays_zip("to_low", "to_high")).alias("cell", "to")
    ).select("g", "cell", "to.to_low", "to.to_high")
    both = ways.join(blocks.select("b", "cell", "low", "high"), "cell")
    lower = F.greatest(F.lit(0.0), F.col("to_low") - F.col("high"), F.col("low") - F.col("to_high"))
    return both.select("g", "b", lower.alias("lower"), (F.col("to_high") + F.col("high")).alias("upper"))


def _scored(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """``g, i, id, score``: for the queries ``i`` of each pair the k best of its vectors that reach
    the query's floor."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    asked = groups.withColumnRenamed("b", "g").select("g", "n", F.col("data").alias("queries"), "floors")
    both = pairs.join(asked, "g").join(blocks.select("b", "ids", "data"), "b").select("g", "n", "queries", "floors", "ids", "data")

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                queries = np.frombuffer(r.queries, float).reshape(r.n, -1)
                data = np.frombuffer(r.data, float).reshape(len(r.ids), -1).T
                floor = np.full(r.n, -np.inf)
                for i, least in (r.floors or {}).items():
                    floor[i] = least
                step = max(1, SCORES_AT_ONCE // len(r.ids))
                for lo in range(0, r.n, step):
                    i, place, score = best_of(queries[lo : lo + step] @ data, floor[lo : lo + step], k)
                    ids = [r.ids[x] for x in place]
                    yield pd.DataFrame({"g": np.full(len(i), r.g), "i": i + lo, "id": ids, "score": score})

    return both.mapInPandas(best, f"g long, i int, id {kind}, score double")


def best_of(score: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and rounded score of the ``k`` best of every row that reach the row's floor; of equal
    ones the first.  Only scores that may be among them are rounded and sorted."""
    least = floor - 2 * 10.0**-DIGITS
    free = np.flatnonzero(np.isneginf(floor))
    if len(free) and score.shape[1] > k:
        kth = np.partition(score[free], score.shape[1] - k, axis=1)[:, -k]
        least[free] = kth - 2 * 10.0**-DIGITS
    row, place = np.nonzero(score >= least[:, None])
    value = np.round(score[row, place], DIGITS)
    order = np.lexsort((place, -value, row))
    row, place, value = row[order], place[order], value[order]
    first = np.searchsorted(row, row)
    keep = (np.arange(len(row)) - first < k) & (value >= floor[row])
    return row[keep], place[keep], value[keep]


def _floors(kth: DataFrame) -> DataFrame:
    """``g, known, least, floors``: the k-th score of each query of a block that has k vectors."""
    return kth.groupBy("g").agg(
        F.count("*").alias("known"), F.min("score").alias("least"),
        F.map_from_entries(F.collect_list(F.struct("i", "score"))).alias("floors"),
    ).select("g", "known", "least", "floors")
