"""What fields JSON records hold, at any depth, as rows of counts.

Counts of parts of the data add up, so an inventory can be kept per landing and merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

# Levels of nesting that one pass looks at; deeper records take further passes.
LEVELS = 4
_PLAIN_KEY = r"^[A-Za-z_][A-Za-z0-9_]*$"


def kind_of(value: Column) -> Column:
    """object, array, string, integer, number, boolean, null or other."""
    shape = F.schema_of_variant(value)
    whole = F.startswith(shape, F.lit("BIGINT")) | shape.rlike(r"^DECIMAL\(\d+,0\)")
    return (
        F.when(value.isNull() | (shape == "VOID"), "null")
        .when(F.startswith(shape, F.lit("OBJECT")), "object")
        .when(F.startswith(shape, F.lit("ARRAY")), "array")
        .when(shape == "STRING", "string")
        .when(whole, "integer")
        .when(shape.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "number")
        .when(shape == "BOOLEAN", "boolean")
        .otherwise("other")
    )


def _step(path: Column, key: Column) -> Column:
    quoted = F.concat(F.lit("['"), F.replace(key, F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.concat(path, F.when(key.rlike(_PLAIN_KEY), F.concat(F.lit("."), key)).otherwise(quoted))


def _children(item: Column) -> Column:
    """Paths and values one level below ``item(path, value)``; none below a plain value."""
    path, value = item.getField("path"), item.getField("value")
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    elements = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(
        F.transform(entries, lambda e: F.struct(_step(path, e["key"]).alias("path"), e["value"].alias("value"))),
        F.transform(elements, lambda e: F.struct(F.concat(path, F.lit("[*]")).alias("path"), e.alias("value"))),
        F.array().cast("array<struct<path:string,value:variant>>"),
    )


def _seen(level: int) -> Column:
    """(path, kind, level) of a level's items, and once more without kind: the path is there."""
    return F.transform(
        F.col(f"level_{level}"),
        lambda x: F.struct(x["path"].alias("path"), kind_of(x["value"]).alias("kind"), F.lit(level).alias("level")),
    )


def field_counts(records: DataFrame, column: str = "raw") -> DataFrame:
    """``path, kind, records``: in how many records a path has a value of a kind.

    A null kind counts the records that have the path at all; a text that is no JSON is kind
    ``broken`` at ``$``.  Elements of a list share the path of the list with ``[*]``.  A record counts once
    for a path and kind, however many values it has there: that is settled inside its row, and
    one small aggregate follows.  Null texts are not records.
    """
    value = F.try_parse_json(F.col(column))
    top = F.array(F.struct(F.lit("$").alias("path"), F.col("value").alias("value")))
    rows = records.where(F.col(column).isNotNull()).select(value.alias("value"))
    broken = rows.where(F.col("value").isNull())
    level = rows.where(F.col("value").isNotNull()).select(top.alias("level_0"))
    found = [
        broken.select(F.lit("$").alias("path"), F.explode(F.array(F.lit("broken"), F.lit(None))).alias("kind"))
        .groupBy("path", "kind").agg(F.count(F.lit(1)).alias("records"))
    ]
    while level is not None:
        for n in range(1, LEVELS):
            level = level.withColumn(f"level_{n}", F.flatten(F.transform(f"level_{n - 1}", _children)))
        own = F.array_distinct(F.concat(*[_seen(n) for n in range(LEVELS)]))
        there = F.array_distinct(F.transform(
            own, lambda s: F.struct(s["path"].alias("path"), F.lit(None).cast("string").alias("kind"), s["level"].alias("level"))
        ))
        counted = stage(
            level.select(F.inline(F.concat(own, there))).groupBy("path", "kind", "level").agg(F.count(F.lit(1)).alias("records")),
            "fields",
        )
        found.append(counted.select("path", "kind", "records"))
        if counted.where(f"level = {LEVELS - 1} and kind in ('object', 'array')").isEmpty():
            level = None
        else:
            below = F.flatten(F.transform(f"level_{LEVELS - 1}", _children))
            level = stage(level.select(below.alias("level_0")).where(F.size("level_0") > 0), "fields")
    return merge_counts(found)


def merge_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Counts of several parts as the counts of them all."""
    return reduce(DataFrame.unionByName, parts).groupBy("path", "kind").agg(F.sum("records").alias("records"))


def inventory(counts: DataFrame) -> DataFrame:
    """``path, kinds, records, present``: one row a path.  ``kinds`` is a sorted, comma-joined list,
    ``present`` the records that have the path, ``records`` all of them."""
    kinds = F.concat_ws(",", F.array_sort(F.collect_set("kind")))  # there are a handful of kinds
    present = F.max(F.when(F.col("kind").isNull(), F.col("records")))
    paths = counts.groupBy("path").agg(kinds.alias("kinds"), present.alias("present"))
    total = counts.where("path = '$' and kind is null").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    return paths.select("path", "kinds", total.scalar().alias("records"), "present")


def field_inventory(raw: DataFrame, column: str = "raw") -> DataFrame:
    """The inventory of landed records ``(provider, page, raw)`` with the ``largest_page``, the most
    records that any page returned."""
    pages = raw.groupBy("provider", "page").agg(F.count(F.lit(1)).alias("n"))
    largest = pages.agg(F.max("n").alias("largest_page"))
    return inventory(field_counts(raw, column)).withColumn("largest_page", largest.scalar())
