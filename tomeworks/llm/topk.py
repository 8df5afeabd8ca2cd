"""Exact top-k by inner product with norm buckets.

Vectors are sorted by length and cut into buckets of bounded size, the longest first; queries
are cut into blocks of bounded size.  Each query block first meets the longest bucket, which
gives every query a lower bound for its k-th best product.  For each other bucket the bound
becomes a local cosine threshold, bound / (|q| * longest vector of the bucket):

* above 1 no vector of the bucket can qualify, and the pair is dropped;
* above COORDINATE_FROM the bucket is pruned by coordinates: a vector within that cosine of q
  has its coordinates near q's in the query's largest dimensions, so a range of the sorted
  coordinate and bounds on others leave few candidates;
* otherwise it is pruned by length: only vectors of at least bound / |q| are looked at.

What is left is verified by the product itself, in whole numbers.  Pairs of blocks are rows
that Spark deals out; a pair gives the scores that reach the bound, at most k for a query.

Defined results: a vector that is null or holds a null or non-finite number takes no part, as
query or candidate; a query is never its own candidate (the same id); repeated rows are
candidates each; vectors of different length are compared over the dimensions they share; an
empty vector has product 0 with every other; fewer than k candidates are all returned; ties go
to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import parts_for, stage

BUCKET_ROWS = 4096
QUERY_ROWS = 512
# Local cosine threshold from which coordinates prune better than lengths.
COORDINATE_FROM = 0.6
# Dimensions of a query that bound the coordinates of its candidates.
FOCUS = 3
_SLACK = 1e-9
# Products up to here are exact as doubles.
_EXACT = 1 << 52


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or a number that is not finite."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~F.coalesce(odd, F.lit(True))


def quantised(vector: Column, scale: int = 1024) -> Column:
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * scale))


def _class(length: Column) -> Column:
    return F.floor(F.log2(length + 1) * 8)


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """``block, top, n, width, ids, data``: blocks of rows in the order they come."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, len(batch), rows):
                own = batch.iloc[lo : lo + rows]
                vectors = [np.asarray(v, np.int64) for v in own["v"]]
                width = max(map(len, vectors))
                data = np.zeros((len(own), width), np.int64)
                for i, v in enumerate(vectors):
                    data[i, : len(v)] = v
                norm = np.sqrt((data.astype(float) ** 2).sum(1))
                yield pd.DataFrame([(part << 32 | k, float(norm.max()), len(own), width, own["id"].to_numpy(np.int64).tobytes(), data.tobytes())],
                                   columns=["block", "top", "n", "width", "ids", "data"])
                k += 1

    return df.mapInPandas(run, "block long, top double, n long, width int, ids binary, data binary")


def _matrix(row, suffix: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(getattr(row, "ids" + suffix), np.int64)
    return ids, np.frombuffer(getattr(row, "data" + suffix), np.int64).reshape(len(ids), getattr(row, "width" + suffix))


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    d = min(q.shape[-1], v.shape[-1])
    q, v = q[..., :d], v[..., :d]
    big = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * d
    if big < _EXACT:
        return (q.astype(float) @ v.T.astype(float)).astype(np.int64)
    return q @ v.T


def _search(q, q_ids, v, v_ids, k: int, bound: np.ndarray | None) -> pd.DataFrame:
    """The k best of the vectors for each query, none below its bound."""
    d = min(q.shape[1], v.shape[1])
    fv, fq = v.astype(float), q.astype(float)
    v_norm, q_norm = np.sqrt((fv**2).sum(1)), np.sqrt((fq**2).sum(1))
    order = np.argsort(-v_norm, kind="stable")
    v, v_ids, v_norm = v[order], v_ids[order], v_norm[order]
    unit = fv[order] / np.where(v_norm > 0, v_norm, 1)[:, None]
    bound = np.full(len(q), -np.inf) if bound is None else bound
    longest = v_norm[0] if len(v) else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(q_norm * longest > 0, bound / (q_norm * longest), np.where(bound > 0, np.inf, -np.inf))
        least = np.where(q_norm > 0, bound / q_norm, -np.inf)
    # a query with a zero product everywhere passes if its bound is 0 or less
    by_length = (local <= 1 + _SLACK) & ((local < COORDINATE_FROM) | (d == 0))
    by_coordinate = (local <= 1 + _SLACK) & ~by_length
    out = []

    def take(i: int, score: np.ndarray, rows: np.ndarray) -> None:
        ok = (v_ids[rows] != q_ids[i]) & (score >= bound[i])
        score, ids = score[ok], v_ids[rows][ok]
        best = np.lexsort((ids, -score))[:k]
        out.append((np.full(len(best), q_ids[i]), ids[best], score[best]))

    at = np.flatnonzero(by_length)
    for lo in range(0, len(at), 128):
        part = at[lo : lo + 128]
        reach = int(np.searchsorted(-v_norm, -least[part].min() * (1 - _SLACK) + _SLACK, "right"))
        scores = _product(q[part], v[:reach])
        for i, s in zip(part, scores):
            take(i, s, np.arange(reach))
    sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in np.flatnonzero(by_coordinate):
        t, own = min(local[i], 1.0), fq[i, :d] / q_norm[i]
        focus = np.argsort(-np.abs(own))[:FOCUS]
        rows = None
        for f in focus:
            # |v_f - t' q_f| is bounded by what the cosine leaves for the other dimensions
            spread = np.sqrt(max(0.0, 1 - own[f] ** 2)) * np.sqrt(max(0.0, 1 - t * t)) + 1e-6
            low, high = own[f] * t - spread, own[f] * t + spread
            # a vector nearer than the threshold may lie past the cone's edge, up to q itself
            if own[f] >= t:
                high = 1.0
            if own[f] <= -t:
                low = -1.0
            high, low = (max(high, own[f]) if own[f] > 0 else high), (min(low, own[f]) if own[f] < 0 else low)
            if rows is None:
                if f not in sorted_by:
                    by = np.argsort(unit[:, f], kind="stable")
                    sorted_by[f] = by, unit[by, f]
                by, values = sorted_by[f]
                rows = by[np.searchsorted(values, low - _SLACK) : np.searchsorted(values, high + _SLACK, "right")]
            else:
                rows = rows[(unit[rows, f] >= low - _SLACK) & (unit[rows, f] <= high + _SLACK)]
        rows = rows[v_norm[rows] >= least[i] * (1 - _SLACK) - _SLACK]
        take(i, _product(q[i], v[rows]), rows)
    if not out:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` holds."""
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = stage(rows.withColumn("length", length), "topk")
    total, asked = rows.agg(F.count("*"), F.count_if("q")).first()
    if not asked:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    buckets = stage(
        _packed(rows.repartitionByRange(parts_for(total, 4 * BUCKET_ROWS), F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id").select("id", "v"), BUCKET_ROWS),
        "topk",
    )
    queries = stage(
        _packed(rows.filter("q").dropDuplicates(["id", "v"]).repartition(parts_for(asked, 4 * QUERY_ROWS), "id").select("id", "v"), QUERY_ROWS), "topk"
    )
    longest, _, first = buckets.agg(F.max(F.struct("top", "n", "block"))).first()[0]
    head = buckets.filter(F.col("block") == first)

    def pairs(bucket: DataFrame, query: DataFrame, bounded: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    q_ids, q = _matrix(row, "_q")
                    v_ids, v = _matrix(row, "")
                    yield _search(q, q_ids, v, v_ids, k, np.frombuffer(row.bound, float) if bounded else None)

        named = query.select(*[F.col(c).alias(c + "_q") for c in ("block", "width", "ids", "data")], *(["bound"] if bounded else []))
        if bounded:
            # classes of length are the join key; then a block's own longest vector decides
            reach = query.select(
                F.col("block").alias("block_q"), "weakest",
                F.explode(F.sequence(_class(F.greatest("weakest", F.lit(0.0))), F.greatest(_class(F.lit(longest)), _class(F.greatest("weakest", F.lit(0.0)))))).alias("class"),
            )
            numbers = bucket.select("block", "top", _class(F.col("top")).alias("class")).join(reach, "class").filter("weakest <= top")
        else:
            # every query block asks for the first bucket; as a literal the key would make a cross join
            own = F.col("block")
            numbers = query.select((own - own + first).alias("block"), own.alias("block_q"))
        return numbers.select("block", "block_q").join(bucket, "block").join(named, "block_q").mapInPandas(
            run, "query_id long, vec_id long, score long"
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    start = stage(pairs(head, queries, False), "topk")
    return _merge(start, buckets, queries, first, pairs, best, k)


def _merge(start, buckets, queries, first, pairs, best, k):
    """Bounds from the first bucket, all other buckets under them, and the k best of all."""
    ranked = start.withColumn("rank", F.row_number().over(best))
    bounds = ranked.filter(F.col("rank") == k).select("query_id", "score")

    def attach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                ids, q = _matrix(row, "")
                known = dict(zip(row.bounded, row.scores)) if row.bounded is not None else {}
                bound = np.array([known.get(i, -np.inf) for i in ids.tolist()], float)
                norm = np.sqrt((q.astype(float) ** 2).sum(1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(norm > 0, bound / norm, -np.inf)
                rows.append((row.block, row.width, row.ids, row.data, bound.tobytes(), float(reach.min()) * (1 - _SLACK) - _SLACK))
            yield pd.DataFrame(rows, columns=["block", "width", "ids", "data", "bound", "weakest"])

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame({"block": row.block, "query_id": np.frombuffer(row.ids, np.int64)})

    members = queries.select("block", "ids").mapInPandas(listed, "block long, query_id long")
    per_block = members.join(bounds, "query_id").groupBy("block").agg(
        F.collect_list(F.struct("query_id", "score")).alias("b")
    ).select("block", F.col("b.query_id").alias("bounded"), F.col("b.score").alias("scores"))
    known = stage(
        queries.join(per_block, "block", "left").mapInPandas(attach, "block long, width int, ids binary, data binary, bound binary, weakest double"), "topk"
    )
    rest = pairs(buckets.filter(F.col("block") != first), known, True)
    found = start.union(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
