"""Full snapshots, daily deltas and the differences between them.

Snapshots are compared by key, never by position.  A snapshot has one row per key;
``latest_wins`` makes it so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .catalog import latest_wins
from .normalize import is_public_domain
from .profile import basis_points


def missing_ids(old: DataFrame, new: DataFrame, key: str = "htid") -> DataFrame:
    """Keys of ``old`` that ``new`` no longer has."""
    return old.select(key).join(new.select(key), key, "left_anti")


def snapshot_diff(
    old: DataFrame, new: DataFrame, columns: Sequence[str], key: str = "htid"
) -> DataFrame:
    """Every key of either snapshot as added, removed, changed or same, with the old and
    new values of ``columns``."""
    columns = list(columns)
    before = old.select(key, F.struct(*columns).alias("before"))
    after = new.select(key, F.struct(*columns).alias("after"))
    status = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .when(F.col("before").eqNullSafe(F.col("after")), "same")
        .otherwise("changed")
    )
    return before.join(after, key, "full_outer").select(
        key,
        status.alias("status"),
        *[F.col(f"before.{c}").alias(f"old_{c}") for c in columns],
        *[F.col(f"after.{c}").alias(f"new_{c}") for c in columns],
    )


def delta_share(snapshot: DataFrame, delta: DataFrame, key: str = "htid") -> DataFrame:
    """How many delta rows modify a known key and how many bring a new one.

    Both sides are tagged, united and counted per key, which combines before the shuffle
    and does not multiply rows when a key repeats.
    """
    tagged = snapshot.select(key, F.lit(1).alias("known"), F.lit(0).alias("rows")).unionAll(
        delta.select(key, F.lit(0).alias("known"), F.lit(1).alias("rows"))
    )
    per_key = tagged.groupBy(key).agg(F.max("known").alias("known"), F.sum("rows").alias("rows"))
    kind = F.when(F.col("known") == 1, "modified").otherwise("new").alias("kind")
    counted = per_key.where("rows > 0").groupBy(kind).agg(F.sum("rows").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counted.withColumn("basis_points", basis_points(F.col("rows"), total))


def transitions(old: DataFrame, new: DataFrame, column: str, key: str = "htid") -> DataFrame:
    """Counts of (old value, new value) over the keys of both snapshots that changed."""
    pairs = old.select(key, F.col(column).alias("old_value")).join(
        new.select(key, F.col(column).alias("new_value")), key
    )
    moved = pairs.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    return moved.groupBy("old_value", "new_value").agg(F.count(F.lit(1)).alias("rows"))


def public_domain_flow(moves: DataFrame) -> DataFrame:
    """Transitions summed into entering and leaving the public domain, and neither."""
    was, now = is_public_domain(F.col("old_value")), is_public_domain(F.col("new_value"))
    flow = F.when(~was & now, "entering").when(was & ~now, "leaving").otherwise("neither")
    return moves.groupBy(flow.alias("flow")).agg(F.sum("rows").alias("rows"))


def apply_deltas(
    snapshot: DataFrame,
    deltas: DataFrame,
    order: Sequence[str],
    key: str = "htid",
) -> DataFrame:
    """Snapshot brought up to date: the newest row of each key in either input."""
    both = snapshot.unionByName(deltas, allowMissingColumns=True)
    return latest_wins(both, [key], order)


def delta_gaps(index: DataFrame, date: str = "file_date") -> DataFrame:
    """Gaps between consecutive file dates: (before, after, missing days).

    Works on distinct dates, of which there are as many as days published.
    """
    days = index.select(F.to_date(date).alias("after")).distinct()
    stepped = days.withColumn("before", F.lag("after").over(Window.orderBy("after")))
    gap = F.datediff("after", "before")
    return stepped.where(gap > 1).select("before", "after", (gap - 1).alias("missing_days"))
