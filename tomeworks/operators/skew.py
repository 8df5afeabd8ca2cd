"""Work that must not gather one hot key in one task.

Windows that keep at most k rows per key need nothing from here: Spark limits each key
before the shuffle.  What is left are joins on a hot key, ``lag`` over a long history
and ranks beyond what a window can limit early.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import broadcast_if_small, stage

HOT_ROWS = 5_000_000
HOT_KEYS = 10_000
# Rows that a task sorts for a window or a join.
TASK_ROWS = 250_000
SALTS = 256
# Spark's own bound for limiting a ranked window before its shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
EARLY_LIMIT = 1000


def hot_keys(
    df: DataFrame, key: Sequence[str], min_rows: int = HOT_ROWS, most: int = HOT_KEYS
) -> DataFrame:
    """The ``most`` most frequent keys among those with more than ``min_rows`` rows.

    At most ``most`` narrow rows, so the result may always be broadcast.  Reads the key
    columns only and counts before the shuffle.  A key left out has at most one part in
    ``most`` of all rows.
    """
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows"))
    hot = counted.where(F.col("key_rows") > min_rows)
    return hot.orderBy(F.desc("key_rows"), *key).limit(most).select(*key)


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str], prefix: str) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in key]
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    min_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join where single keys may fill a large part of ``left``.

    Rows of hot keys are spread over ``salts`` tasks by a hash of ``spread_by``, and the
    matching rows of ``right`` are repeated once per salt.  Other keys join as usual.
    ``how`` is one of inner, left, left_semi, left_anti; the result equals the plain join.
    """
    key = list(key)
    hot = F.broadcast(
        hot_keys(left, key, min_rows).select(*[F.col(k).alias(f"hot_{k}") for k in key])
        .withColumn("is_hot", F.lit(True))
    )
    hot_names = [f"hot_{k}" for k in key]
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted_left = (
        left.join(hot, _same_key(left, hot, key, "hot_"), "left")
        .withColumn("salt", F.when(F.col("is_hot"), spread).otherwise(F.lit(0)))
        .drop(*hot_names, "is_hot")
    )
    copies = F.when(
        F.col("is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(hot, _same_key(right, hot, key, "hot_"), "left")
        .withColumn("salt", F.explode(copies))
        .drop(*hot_names, "is_hot")
    )
    return salted_left.join(salted_right, [*key, "salt"], how).drop("salt")


def dealt(df: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by ``key`` to so many tasks that each has about TASK_ROWS of ``rows`` at most.

    A named number of tasks, which Spark does not merge into fewer; a table that one task can
    hold is left to the planner.
    """
    return df if rows <= TASK_ROWS else df.repartition(_pieces(df, rows), *key)


def _sizes(df: DataFrame, key: Sequence[str]) -> tuple[int, int]:
    """All rows, and those of the most frequent key."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows"))
    rows, most = counted.agg(F.sum("key_rows"), F.max("key_rows")).first()
    return rows or 0, most or 0


def range_pieces(df: DataFrame, columns: Sequence[Column], pieces: int | None = None) -> DataFrame:
    """``df`` cut into even ranges of ``columns``, numbered in order by ``piece``.

    A hot key is cut as well, because the ordering columns take part in the ranges.
    The result is staged: the numbers must not move when a task runs again.
    """
    if pieces is None:
        pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(pieces, *columns)
    return stage(ranged.withColumn("piece", F.spark_partition_id()), "ranges")


def _pieces(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def with_previous(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "previous",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``: ``value`` of the row before, in ``order``, within ``key``.

    Null on the first row of a key.  Keys with at most ``min_rows`` rows use a plain
    window.  Longer histories are cut into ranges; each range looks back within itself,
    and the last row of the range before it is handed over through a table with one row
    per (key, range).
    """
    key, order = list(key), list(order)
    df = df.withColumn("look_back", value)
    by_key = Window.partitionBy(*key).orderBy(*order)
    rows, most = _sizes(df, key)
    if most <= min_rows:
        return dealt(df, key, rows).withColumn(name, F.lag("look_back").over(by_key)).drop("look_back")

    hot = hot_keys(df, key, min_rows)
    marked = F.broadcast(hot.select(*[F.col(k).alias(f"hot_{k}") for k in key]))
    matches = _same_key(df, marked, key, "hot_")
    cold = dealt(df.join(marked, matches, "left_anti"), key, rows)
    cold = cold.withColumn(name, F.lag("look_back").over(by_key))

    pieces = range_pieces(df.join(marked, matches, "left_semi"), [*key, *order], _pieces(df, rows))
    in_piece = Window.partitionBy(*key, "piece").orderBy(*order)
    inner = pieces.withColumn(name, F.lag("look_back").over(in_piece)).withColumn(
        "is_first", F.row_number().over(in_piece) == 1
    )
    last = pieces.groupBy(*key, "piece").agg(
        F.max_by(F.struct("look_back"), F.struct(*order)).alias("last")
    )
    handed = last.withColumn(
        "handed", F.lag("last").over(Window.partitionBy(*key).orderBy("piece"))
    ).drop("last")
    # One row per range plus one per hot key: bounded by the pieces and HOT_KEYS.
    handed = F.broadcast(
        handed.select(*[F.col(c).alias(f"at_{c}") for c in [*key, "piece"]], "handed")
    )
    joined = inner.join(handed, _same_key(inner, handed, [*key, "piece"], "at_"), "left")
    spliced = joined.withColumn(
        name, F.when(F.col("is_first"), F.col("handed.look_back")).otherwise(F.col(name))
    )
    return cold.unionByName(spliced.select(*cold.columns)).drop("look_back")


def carry_forward(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "carried",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``: the last ``value`` that is not null, in ``order``, within ``key``, up to the row
    itself.  Long histories are cut into ranges as in ``with_previous``."""
    key, order = list(key), list(order)
    df = df.withColumn("look_back", value)
    upto = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("look_back", ignorenulls=True)
    rows, most = _sizes(df, key)
    if most <= min_rows:
        return dealt(df, key, rows).withColumn(name, last.over(upto(*key))).drop("look_back")

    hot = hot_keys(df, key, min_rows)
    marked = F.broadcast(hot.select(*[F.col(k).alias(f"hot_{k}") for k in key]))
    matches = _same_key(df, marked, key, "hot_")
    cold = dealt(df.join(marked, matches, "left_anti"), key, rows).withColumn(name, last.over(upto(*key)))
    pieces = range_pieces(df.join(marked, matches, "left_semi"), [*key, *order], _pieces(df, rows))
    inner = pieces.withColumn(name, last.over(upto(*key, "piece")))
    known = F.col("look_back").isNotNull()
    ends = pieces.groupBy(*key, "piece").agg(
        F.max_by(F.when(known, F.col("look_back")), F.when(known, F.struct(*order))).alias("end")
    )
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.withColumn("handed", F.last("end", ignorenulls=True).over(before))
    # One row per range plus one per hot key, as in with_previous.
    handed = F.broadcast(handed.select(*[F.col(c).alias(f"at_{c}") for c in [*key, "piece"]], "handed"))
    joined = inner.join(handed, _same_key(inner, handed, [*key, "piece"], "at_"), "left")
    spliced = joined.withColumn(name, F.coalesce(name, "handed"))
    return cold.unionByName(spliced.select(*cold.columns)).drop("look_back")


def top_rows(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    partition: Sequence[str] = (),
    early_limit: int = EARLY_LIMIT,
) -> DataFrame:
    """First ``k`` rows in ``order``, for each ``partition`` if given.  ``order`` must be
    total, or ties fall at random.

    Small ``k``: every task keeps its own first k before anything moves.  Large ``k``:
    rows are cut into ranges of (partition, order); ranges that fit are taken whole and
    only the range in which the k-th row falls is ranked.
    """
    if k <= 0:
        return df.limit(0)
    partition = list(partition)
    if k <= early_limit:
        if not partition:
            return df.orderBy(*order).limit(k)
        ranked = df.withColumn(
            "place", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        )
        return ranked.where(F.col("place") <= k).drop("place")

    keep = df.columns
    pieces = range_pieces(df, [*[F.col(p) for p in partition], *order])
    sizes = pieces.groupBy(*partition, "piece").agg(F.count(F.lit(1)).alias("size"))
    upto = Window.partitionBy(*partition).orderBy("piece")
    reach = sizes.withColumn("reach", F.sum("size").over(upto))
    needed = reach.where(F.col("reach") - F.col("size") < k).select(
        *[F.col(c).alias(f"at_{c}") for c in [*partition, "piece"]],
        (F.lit(k) - (F.col("reach") - F.col("size"))).alias("room"),
        "size",
    )
    needed = broadcast_if_small(needed)
    inside = pieces.join(needed, _same_key(pieces, needed, [*partition, "piece"], "at_"))
    whole = inside.where(F.col("size") <= F.col("room"))
    in_piece = Window.partitionBy(*partition, "piece").orderBy(*order)
    cut = (
        inside.where(F.col("size") > F.col("room"))
        .withColumn("place", F.row_number().over(in_piece))
        .where(F.col("place") <= F.col("room"))
    )
    return whole.select(*keep).unionByName(cut.select(*keep))
