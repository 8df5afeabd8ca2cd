"""Rows that belong together because they share identifiers, directly or over other rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import settle, stage, staged_so_far
from .skew import HOT_ROWS, salted_join


def linked(pairs: DataFrame, node: str = "node", link: str = "link", min_rows: int = HOT_ROWS) -> DataFrame:
    """``(node, root)`` for every node of ``pairs(node, link)``; root is the least node that can be
    reached over shared links.

    Contraction in rounds.  In each, every link names the member that a hash puts first, every
    node moves to the first of the members its links name, and links that are left with one
    member are dropped.  About half of the nodes go in a round whatever the shape, and the hash
    changes from round to round, so long chains take few rounds as well.  No link's members are ever
    gathered or paired; links and nodes with more than ``min_rows`` rows are spread over many
    tasks.  Each round is written to the shared folder, and removed once the result is.  Rows
    with a null node or link are left out; repeated rows count once.
    """
    spark, mark = pairs.sparkSession, staged_so_far()
    pairs = pairs.select(F.col(node).alias("node"), F.col(link).alias("link"))
    live = stage(pairs.where("node is not null and link is not null").distinct(), "links")
    path = live.select("node", F.col("node").alias("to")).distinct()
    live, rounds = _shared(live, min_rows), 0
    while not live.isEmpty():
        rounds += 1
        first = F.struct(F.xxhash64("node", F.lit(rounds)).alias("weight"), F.col("node").alias("to"))
        named = live.groupBy("link").agg(F.min(first).alias("first"))
        joined = salted_join(live, named, ["link"], "left", ["node"], min_rows)
        moves = stage(joined.groupBy("node").agg(F.min("first").alias("f")).select("node", "f.to"), "links")
        moved = salted_join(live, moves, ["node"], "left", ["link"], min_rows)
        live = _shared(stage(moved.select(F.col("to").alias("node"), "link").distinct(), "links"), min_rows)
        steps = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
        path = salted_join(path, steps, ["to"], "left", ["node"], min_rows)
        path = stage(path.select("node", F.coalesce("next", "to").alias("to")), "links")
    least = path.groupBy("to").agg(F.min("node").alias("root"))
    roots = salted_join(path, least, ["to"], "left", ["node"], min_rows).select("node", "root")
    return settle(spark, roots, "linked", mark)


def _shared(pairs: DataFrame, min_rows: int) -> DataFrame:
    """The pairs of links that have several members."""
    several = pairs.groupBy("link").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    several = several.where("low <> high").select("link")
    return stage(salted_join(pairs, several, ["link"], "left_semi", ["node"], min_rows), "links")
