"""Values that change over time, as intervals in which they hold.

One row for each stretch of time in which a key had the same value takes the place of a stored
snapshot for every date: the state at any date, the moves between any two dates and the value at the
time of any event are read from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .catalog import latest_wins
from .skew import HOT_ROWS, carry_forward, with_previous


def validity(
    changes: DataFrame, key: str, at: str, value: str, ties: Sequence[str] = (), min_rows: int = HOT_ROWS
) -> DataFrame:
    """``key, value, since, until`` from rows that say what ``value`` became ``at`` a time.

    Of several rows of a key at one time the last by ``ties`` counts.  Rows that change nothing make
    no interval.  A null value means that the key went: no interval holds until it comes back.
    ``until`` is the first moment at which the value no longer holds, null for the present one.
    Rows without a time or key are left out.  Long histories are cut into ranges that several
    tasks look back over.
    """
    rows = changes.select(key, F.col(at).alias("since"), F.col(value).alias("value"), *[F.col(t).alias(f"tie_{t}") for t in ties])
    rows = rows.where(F.col(key).isNotNull() & F.col("since").isNotNull())
    if ties:
        rows = latest_wins(rows, [key, "since"], [f"tie_{t}" for t in ties])
    rows = rows.select(key, "since", "value")
    held = F.struct(F.col("value").alias("value"))
    seen = with_previous(rows, [key], ["since"], held, "before", min_rows)
    points = seen.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(F.col("value"))).drop("before")
    # the next change point is the previous one in the order of falling times
    falling = points.withColumn("falling", -_number(points, "since"))
    ended = with_previous(falling, [key], ["falling"], F.col("since"), "until", min_rows)
    return ended.where(F.col("value").isNotNull()).select(key, F.col("value").alias(value), "since", "until")


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    if kind == "date":
        return F.unix_date(column).cast("long")
    if kind == "timestamp_ntz":
        return F.unix_micros(F.to_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))
    return F.unix_micros(column) if kind == "timestamp" else F.col(column).cast("long")


def state_at(history: DataFrame, moment) -> DataFrame:
    """The intervals that hold at ``moment``: at most one of each key."""
    moment = moment if isinstance(moment, Column) else F.lit(moment)
    return history.where((F.col("since") <= moment) & (F.col("until").isNull() | (moment < F.col("until"))))


def moves_between(history: DataFrame, key: str, value: str, first, second) -> DataFrame:
    """``old_value, new_value, rows``: what keys had at the first moment and have at the second, where that
    differs; null where a key was not there."""
    old = state_at(history, first).select(key, F.col(value).alias("old_value"))
    new = state_at(history, second).select(key, F.col(value).alias("new_value"))
    both = old.join(new, key, "full_outer")
    moved = both.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    return moved.groupBy("old_value", "new_value").agg(F.count(F.lit(1)).alias("rows"))


def value_at(
    asked: DataFrame, history: DataFrame, key: str, at: str, value: str, min_rows: int = HOT_ROWS
) -> DataFrame:
    """``asked`` with the ``value`` that its key had at the time ``at``; null where there was none.

    Both sides are lined up by key and time, and every row asked for takes the interval that
    began last.  So each row is looked at once, however long the history of its key.
    """
    names = asked.columns
    began = F.struct(F.col(value).alias("value"), F.col("until").alias("until"))
    none = F.lit(None).cast(history.select(began.alias("b")).schema["b"].dataType)
    starts = history.select(
        F.col(key).alias("__key"), F.col("since").alias("__at"), F.lit(0).alias("__kind"), began.alias("__began"),
        F.lit(None).cast(asked.schema.simpleString()).alias("__row"),
    )
    rows = asked.select(
        F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1).alias("__kind"), none.alias("__began"),
        F.struct(*names).alias("__row"),
    )
    lined = carry_forward(starts.unionByName(rows), ["__key"], ["__at", "__kind"], F.col("__began"), "__held", min_rows)
    held = F.col("__held.until").isNull() | (F.col("__at") < F.col("__held.until"))
    found = F.when(held & F.col("__key").isNotNull() & F.col("__at").isNotNull(), F.col("__held.value"))
    return lined.where("__kind = 1").select(*[F.col("__row").getField(n).alias(n) for n in names], found.alias(value))
