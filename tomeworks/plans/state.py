"""What a run must know of each stored record, in a table read and rewritten in part.

One narrow row for each record: the hash of its newest version, whether that lacks text,
how much it is wanted, and where it lies.  The table is partitioned by slot, a hash of the id,
and bucketed by the id inside the slots.  A run reads the slots its records fall into, joins
them by their buckets, so that only the run's own rows move, and replaces those slots alone.

The table follows from the catalog and may be lost.  Marks tell which run it holds: a mark is
opened before slots are replaced and closed afterwards.  It is derived anew from the shards if
the newest mark is open, if it was made for another priority, if a run between it and
the present one reserved its number and left no mark, or if it has outgrown its layout.  A
run that is repeated after later ones sees the shards themselves.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.catalog import RECENCY, latest_wins
from ..session import make_folder, read_or_empty, remove, stage
from ..sources import read_shards
from .runlog import reserved_between

STATE = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("owes", T.BooleanType()),
        T.StructField("wanted", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("run_seq", T.LongType()),
        T.StructField("row_seq", T.LongType()),
        T.StructField("slot", T.IntegerType()),
    ]
)
MARKS = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("mark", T.LongType()),
        T.StructField("run_seq", T.LongType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("place", T.StringType()),
        T.StructField("slots", T.IntegerType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("priority", T.StringType()),
    ]
)
# Records of one file when a table is laid out, and how many times that it may grow to.
FILE_ROWS, GROWTH = 500_000, 8
LEAST_SLOTS, LEAST_BUCKETS, MOST_BUCKETS = 8, 2, 4096


def layout(records: int) -> tuple[int, int]:
    """Slots and buckets for so many records: first more buckets, which join in parallel."""
    files = max(1, -(-records // FILE_ROWS))
    buckets, slots = LEAST_BUCKETS, LEAST_SLOTS
    while buckets * slots < files and buckets < MOST_BUCKETS:
        buckets *= 2
    while buckets * slots < files:
        slots *= 2
    return slots, buckets


def slot_of(source_id: Column | str, slots: int) -> Column:
    return F.pmod(F.xxhash64(source_id), F.lit(slots)).cast("int")


def narrow(rows: DataFrame, priority: str) -> DataFrame:
    """Stored versions as rows of the table, but for the slot."""
    return rows.select(
        "source_id", "content_hash", (F.coalesce("text_char_count", F.lit(0)) == 0).alias("owes"),
        F.col(priority).cast("long").alias("wanted"), *RECENCY,
    )


class State:
    """The state of one provider as a run sees it.

    ``table`` names the bucketed table, or is None where the shards are read in its place.
    """

    def __init__(self, spark: SparkSession, base: str, provider: str, priority: str, run_seq: int, dry_run: bool = False):
        self.spark, self.base, self.provider, self.priority, self.run_seq = spark, base, provider, priority, run_seq
        self.table: str | None = None
        self.records: int | None = None
        self._derived: DataFrame | None = None
        self.mark = self._newest_mark()
        m = self.mark
        behind = m is None or m.run_seq < run_seq
        fits = m is not None and behind and m.closed and m.priority == priority
        if fits and m.records <= GROWTH * FILE_ROWS * m.slots * m.buckets:
            fits = not reserved_between(spark, base, provider, m.run_seq, run_seq)
        else:
            fits = False
        if fits:
            self._attach(m.place, m.slots, m.buckets)
            self.records = m.records
        elif dry_run or not behind:
            self._derived = self._from_shards()
        else:
            self._rebuild()

    # --- reading ---------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """Every record: the columns of STATE but for the slot."""
        return (self._derived if self.table is None else self.spark.table(self.table)).drop("slot")

    def near(self, ids: DataFrame) -> DataFrame:
        """The records in the slots that ``ids(source_id)`` falls into."""
        if self.table is None:
            return self.rows()
        return self._slots(self._touched(ids)).drop("slot")

    def _touched(self, ids: DataFrame) -> list[int]:
        """Numbers of slots: at most as many as the layout has."""
        return sorted(r[0] for r in ids.select(slot_of("source_id", self.slots)).distinct().collect())

    def _slots(self, slots: Sequence[int]) -> DataFrame:
        return self.spark.table(self.table).where(F.col("slot").isin(list(slots)))

    # --- writing ---------------------------------------------------------------------

    def update(self, written: DataFrame | None, added: int) -> None:
        """Bring in the versions that a run has stored; ``added`` of its records are new.

        ``written`` are the run's own stored rows, at most one of each record.
        """
        if self.table is None:
            if self.mark is not None:  # a repeated run: what it stored is not in the table
                self._put_mark(self.mark.run_seq, False, self.mark.place, self.mark.slots, self.mark.buckets, 0)
            return
        place, slots, buckets = self.place, self.slots, self.buckets
        if written is not None:
            new = narrow(written, self.priority)
            touched = self._touched(new)
            self._put_mark(self.run_seq, False, place, slots, buckets, self.records)
            rank = F.struct(*RECENCY)
            old = self._slots(touched).select("source_id", F.struct(*STATE.names[1:-1]).alias("old"), rank.alias("old_rank"))
            new = new.select("source_id", F.struct(*STATE.names[1:-1]).alias("new"), rank.alias("new_rank"))
            both = old.join(new, "source_id", "full_outer")
            newer = F.coalesce(F.col("new_rank") >= F.col("old_rank"), F.col("new_rank").isNotNull())
            merged = both.select("source_id", F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row"))
            self._put(merged.select("source_id", "row.*"))
        self._put_mark(self.run_seq, True, place, slots, buckets, self.records + added)

    def _put(self, rows: DataFrame) -> None:
        placed = rows.withColumn("slot", slot_of("source_id", self.slots))
        placed.select(*[F.col(f.name).cast(f.dataType) for f in STATE.fields]).write.insertInto(self.table, overwrite=True)

    def _rebuild(self) -> None:
        before, rows = self.mark, None
        self.records = 0
        if before is not None or not read_shards(self.spark, self.base, self.provider).isEmpty():
            rows = stage(self._from_shards(), "state")
            self.records = rows.count()
        slots, buckets = layout(self.records)
        place = f"{self.base}/_state/provider={self.provider}/{uuid.uuid4().hex}"
        make_folder(self.spark, place)  # a table without records has no file that would
        self._attach(place, slots, buckets)
        if self.records:
            # dealt as the buckets are, so that each file is written by one task
            self._put(rows.repartition(buckets, "source_id"))
        if rows is not None:
            self._put_mark(self.run_seq - 1, True, self.place, slots, buckets, self.records)
        if before is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {_name(before.place)}")
            remove(self.spark, before.place)

    def _from_shards(self) -> DataFrame:
        stored = read_shards(self.spark, self.base, self.provider).where(F.col("run_seq") < self.run_seq)
        return latest_wins(narrow(stored, self.priority), ["source_id"], RECENCY)

    def _attach(self, place: str, slots: int, buckets: int) -> None:
        self.place, self.slots, self.buckets, self.table = place, slots, buckets, _name(place)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STATE.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (slot) "
            f"CLUSTERED BY (source_id) SORTED BY (source_id) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        # another session may have written slots that this one's list of tables lacks
        self.spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.spark.catalog.refreshTable(self.table)

    # --- marks -----------------------------------------------------------------------

    def _newest_mark(self):
        marks = read_or_empty(self.spark, f"{self.base}/_state_marks", MARKS).where(F.col("provider") == self.provider)
        found = marks.agg(F.max_by(F.struct(*MARKS.names), "mark").alias("m")).first()["m"]
        self._marks = 0 if found is None else found.mark
        return found

    def _put_mark(self, run_seq: int, closed: bool, place: str, slots: int, buckets: int, records: int) -> None:
        self._marks += 1
        row = (self.provider, self._marks, run_seq, closed, place, slots, buckets, records, self.priority)
        self.spark.createDataFrame([row], MARKS).coalesce(1).write.mode("append").parquet(f"{self.base}/_state_marks")


def _name(place: str) -> str:
    return f"tomeworks_state_{hashlib.md5(place.encode()).hexdigest()}"
