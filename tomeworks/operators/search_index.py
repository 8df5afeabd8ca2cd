"""A search index: which records hold which three signs in a row.

Rows (gram, uids) are kept in Parquet, partitioned by a hash of the gram, one batch for each
run: a bounded share of the texts gives one row for each of its grams.  Beside them lie the searched
text of every record, partitioned by a hash of its id, and how many records hold each gram.  A search reads
the slots of its rarest grams, intersects their rows, and verifies what is left against the texts of
those records alone.  A query shorter than a gram has no rows to intersect and scans the texts.

Batches only add.  A record that is indexed again is found by its newest text: older rows
may propose it, but the text decides.  ``merge_index`` writes all batches as one and drops the rows of
older texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import search_blob
from ..session import broadcast_if_small, read_or_empty, remove, stage
from .catalog import latest_wins
from .search import SEARCHED

GRAM = 3
SLOTS = 64
# Grams of a query that are intersected, the rarest first, and candidates whose ids are pushed to the scan.
GRAMS_READ, IDS_PUSHED = 4, 1000
# Signs of texts whose grams are gathered at once.
GATHER_SIGNS = 4_000_000
_TEXTS = "uid string, batch long, source string, blob string, slot int"
_POSTINGS = "gram string, uids array<string>, batch long, slot int"
_COUNTS = "gram string, records long, batch long"
_BATCHES = "batch long, place string, replaces array<long>"


def _slot(c: str | Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")


def grams(text: str) -> np.ndarray:
    """The distinct runs of GRAM signs of a text, each as a number of 21 bits a sign."""
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    runs = np.zeros(max(0, len(signs) - (GRAM - 1)), np.int64)
    for k in range(GRAM):
        runs = runs << 21 | signs[k : k + len(runs)]
    return np.unique(runs)


def _gram_text(number: int) -> str:
    return "".join(chr(number >> 21 * k & 0x1FFFFF) for k in reversed(range(GRAM)))


def _gathered(uids: list[str], found: list[np.ndarray]) -> pa.RecordBatch:
    """``gram, uids``: a row for each gram of some texts, each id once in it."""
    names, own = np.unique(np.array(uids, object), return_inverse=True)
    number, at = np.concatenate(found), np.repeat(own, [len(x) for x in found])
    order = np.lexsort((at, number))
    number, at = number[order], at[order]
    first = np.ones(len(number), bool)
    first[1:] = (number[1:] != number[:-1]) | (at[1:] != at[:-1])  # an id may have several texts
    number, at = number[first], at[first]
    starts = np.flatnonzero(np.r_[len(number) > 0, number[1:] != number[:-1]])
    return pa.RecordBatch.from_arrays([
        pa.array([_gram_text(n) for n in number[starts].tolist()], pa.string()),
        pa.ListArray.from_arrays(
            pa.array(np.r_[starts, len(number)], pa.int32()), pa.array(names, pa.string()).take(pa.array(at))
        ),
    ], names=["gram", "uids"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uids, found, signs = [], [], 0
    for batch in batches:
        for uid, blob in zip(batch.column("uid"), batch.column("blob")):
            text = blob.as_py()
            if uids and signs + len(text) > GATHER_SIGNS:
                yield _gathered(uids, found)
                uids, found, signs = [], [], 0
            uids.append(uid.as_py())
            found.append(grams(text))
            signs += len(text)
    if uids:
        yield _gathered(uids, found)


def _batches(spark: SparkSession, base: str) -> DataFrame:
    """The batches that are read: those that no merge has replaced."""
    log = read_or_empty(spark, f"{base}/batches", _BATCHES)
    gone = log.select(F.explode("replaces").alias("batch"))
    return log.select("batch", "place").join(gone, "batch", "left_anti")


def _places(spark: SparkSession, base: str) -> list[str]:
    """A folder for each batch: as many as there were runs since the last merge."""
    return sorted(r.place for r in _batches(spark, base).collect())


def _read(spark: SparkSession, base: str, part: str, schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for place in _places(spark, base):
        out = out.unionByName(spark.read.schema(schema).parquet(f"{place}/{part}"))
    return out


def add_to_index(
    df: DataFrame, base: str, uid: str = "uid", columns: Sequence[str] = SEARCHED, source: str = "source"
) -> None:
    """Index the records of ``df`` as one more batch; it counts from the moment it is whole."""
    texts = df.select(
        F.col(uid).cast("string").alias("uid"), F.col(source).alias("source"),
        search_blob(*[F.col(c) for c in columns]).alias("blob"),
    ).where("uid is not null")
    log = read_or_empty(df.sparkSession, f"{base}/batches", _BATCHES)
    batch = (log.agg(F.max("batch")).first()[0] or 0) + 1
    _write(texts.withColumn("batch", F.lit(batch).cast("long")), base, batch, [])


def _write(texts: DataFrame, base: str, batch: int, replaces: list[int]) -> None:
    spark, place = texts.sparkSession, f"{base}/data/{batch:08d}-{uuid.uuid4().hex}"
    stored = texts.select("uid", "batch", "source", "blob", _slot("uid").alias("slot"))
    stored.repartition("slot").sortWithinPartitions("slot", "uid").write.partitionBy("slot").parquet(f"{place}/texts")
    texts = spark.read.schema(_TEXTS).parquet(f"{place}/texts")
    rows = texts.select("uid", "blob").mapInArrow(_postings, "gram string, uids array<string>")
    rows = rows.select("gram", "uids", F.lit(batch).cast("long").alias("batch"), _slot("gram").alias("slot"))
    rows.repartition("slot").sortWithinPartitions("slot", "gram").write.partitionBy("slot").parquet(f"{place}/postings")
    kept = spark.read.schema(_POSTINGS).parquet(f"{place}/postings")
    counted = kept.groupBy("gram").agg(F.sum(F.size("uids")).cast("long").alias("records"))
    counted.withColumn("batch", F.lit(batch).cast("long")).sort("gram").write.parquet(f"{place}/counts")
    row = spark.createDataFrame([(batch, place, replaces)], _BATCHES)
    row.coalesce(1).write.mode("append").parquet(f"{base}/batches")


def merge_index(spark: SparkSession, base: str) -> None:
    """Write the newest text of every record as one batch in place of all others, and remove those."""
    old = _batches(spark, base).collect()
    if len(old) < 2:
        return
    texts = latest_wins(_read(spark, base, "texts", _TEXTS), ["uid"], ["batch"])
    last = max(r.batch for r in old)
    _write(texts.withColumn("batch", F.lit(last + 1).cast("long")), base, last + 1, sorted(r.batch for r in old))
    for r in old:
        remove(spark, r.place)


def _candidates(spark: SparkSession, base: str, query: str) -> DataFrame:
    """Ids of the records that hold the rarest grams of the query."""
    wanted = sorted({query[i : i + GRAM] for i in range(len(query) - GRAM + 1)})
    counted = _read(spark, base, "counts", _COUNTS).where(F.col("gram").isin(wanted))
    rare = counted.groupBy("gram").agg(F.sum("records").alias("n")).orderBy("n", "gram").collect()  # a row a gram of the query
    if len(rare) < len(wanted):
        return spark.createDataFrame([], "uid string")  # no record holds one of them
    read = [r.gram for r in rare[:GRAMS_READ]]
    slots = [r[0] for r in spark.createDataFrame([(g,) for g in read], "gram string").select(_slot("gram")).distinct().collect()]
    rows = _read(spark, base, "postings", _POSTINGS).where(F.col("slot").isin(slots) & F.col("gram").isin(read))
    held = rows.select("gram", "batch", F.explode("uids").alias("uid"))
    per_text = held.groupBy("uid", "batch").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(read))
    return per_text.select("uid").distinct()


def search_index(spark: SparkSession, base: str, query: str, source: str = "all") -> DataFrame:
    """``uid`` of the records whose searched text contains the query, whatever its case."""
    query = query.lower()
    texts = _read(spark, base, "texts", _TEXTS)
    if len(query) >= GRAM:
        found = stage(_candidates(spark, base, query), "candidates")
        few = found.limit(IDS_PUSHED + 1).collect()
        if len(few) <= IDS_PUSHED:
            # their slots are pruned and their ids pushed to the scan of the sorted texts
            slots = {r[0] for r in found.select(_slot("uid")).distinct().collect()}
            texts = texts.where(F.col("slot").isin(sorted(slots)) & F.col("uid").isin([r.uid for r in few]))
        else:
            texts = texts.join(broadcast_if_small(found), "uid", "left_semi")
    # whether a text is hit is known before the newest is sought, so no text is shuffled
    judged = texts.select("uid", "batch", "source", F.contains("blob", F.lit(query)).alias("hit"))
    hit = latest_wins(judged, ["uid"], ["batch"]).where("hit")
    return (hit if source == "all" else hit.where(F.col("source") == source)).select("uid")
