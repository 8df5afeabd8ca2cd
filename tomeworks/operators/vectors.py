"""Nearest records by embedding, exact."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# Query vectors are the request and travel to every task; more are taken in blocks.
BLOCK_QUERIES = 4096


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_column: str = "query_id",
) -> DataFrame:
    """The ``k`` vectors with the highest cosine to each query: (query, id, place).

    ``queries`` has (query_column, vector_column) and is taken in blocks of BLOCK_QUERIES
    rows, each of which scans the vectors once.  A null or zero query has no nearest vector
    and is refused, as are vectors of another length than the queries.  Each task scores
    its batches with one matrix product and keeps its own k best, so what is
    shuffled is tasks × queries × k small rows, never the vectors or all pairs.  Equal
    scores are ordered by id.
    """
    rows = queries.select(query_column, vector_column).toLocalIterator()
    blocks = iter(lambda: list(islice(rows, BLOCK_QUERIES)), [])
    found = [_nearest(vectors, queries, b, k, id_column, vector_column, query_column) for b in blocks]
    found = found or [_nearest(vectors, queries, [], k, id_column, vector_column, query_column)]
    return reduce(DataFrame.union, found)


def _nearest(vectors, queries, asked, k, id_column, vector_column, query_column) -> DataFrame:
    names = [row[0] for row in asked]
    id_type = vectors.schema[id_column].dataType.simpleString()
    query_type = queries.schema[query_column].dataType.simpleString()
    if not names:
        return vectors.sparkSession.createDataFrame(
            [], f"{query_column} {query_type}, {id_column} {id_type}, place int"
        )
    if any(row[1] is None for row in asked) or len({len(row[1]) for row in asked}) > 1:
        raise ValueError("query vectors must be of one length and not null")
    wanted = np.asarray([row[1] for row in asked], dtype=np.float64)
    length = np.linalg.norm(wanted, axis=1, keepdims=True)
    if not (length > 0).all():
        raise ValueError("a query vector is zero or not a number")
    wanted /= length

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = scores = None
        id_arrow = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            id_arrow = batch.column(0).type
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            block = flat.astype(np.float64).reshape(batch.num_rows, -1)
            norms = np.linalg.norm(block, axis=1)
            cosine = (wanted @ block.T) / np.where(norms == 0, 1.0, norms)
            new_ids = np.broadcast_to(
                batch.column(0).to_numpy(zero_copy_only=False), cosine.shape
            )
            scores = cosine if scores is None else np.hstack([scores, cosine])
            ids = new_ids if ids is None else np.hstack([ids, new_ids])
            if scores.shape[1] > k:
                top = np.lexsort((ids, -scores), axis=1)[:, :k]
                ids = np.take_along_axis(ids, top, axis=1)
                scores = np.take_along_axis(scores, top, axis=1)
        if scores is not None:
            kept = scores.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(names)), kept), pa.int32()),
                    pa.array(ids.ravel(), id_arrow),
                    pa.array(scores.ravel(), pa.float64()),
                ],
                names=["asked", id_column, "score"],
            )

    other = F.raise_error(F.lit(f"a vector is not of the queries' length {wanted.shape[1]}"))
    fits = F.when(F.size(vector_column) == wanted.shape[1], True).otherwise(other.cast("boolean"))
    usable = vectors.select(id_column, vector_column).where(F.col(vector_column).isNotNull()).where(fits)
    scored = usable.mapInArrow(best, f"asked int, {id_column} {id_type}, score double")
    ranked = scored.withColumn(
        "place",
        F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), F.asc(id_column))),
    ).where(F.col("place") <= k)
    labels = F.array(*[F.lit(n) for n in names])
    return ranked.select(
        F.get(labels, F.col("asked")).alias(query_column), id_column, "place"
    )
