"""Importance resampling towards the distribution of a target set.

Features of a text are its runs of one to three words, hashed to buckets by crc32.  The
counts of the buckets in the corpus and in the target set give every bucket a gain; a text's
weight is the sum of the gains of its features, looked up in one array.  With a Gumbel
term added, the highest scores are a sample without replacement by weight.

The cutoff of the draw is found by bisection: the scores are written once, and counting jobs
over them halve the range of scores, then that of the ids tied at the last score, then that of
the rows tied at both.  Nothing is sorted for it.  The drawn rows are dealt out by
ranges of (score, id) for their ranks.

Checksums of joined words are derived from those of the words: appending L bytes is a linear
map of the checksum before, tabled by L.

Defined results: a null or empty text has no features, weight 0 and is never drawn; a null
id is drawn and ranked after all others of its score, and counts as the text ``null`` in the
Gumbel term; repeated rows are drawn one by one, ties in the order of the scan; an empty
corpus gives no rows, an empty target set counts as zero everywhere; a very long text is
read in chunks.  Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Numbers, flushes, parts_for, runs, stage

BUCKETS = 10_000
LONGEST = 3
FLUSH_CHARS = 4_000_000
# Drawn rows that one task ranks.
RANK_ROWS = 1_000_000
# The polynomial of crc32, and the bytes that stand in words after lower-casing
# (digits, a-z, all beyond ASCII).
POLYNOMIAL = np.uint32(0xEDB88320)
_IN_WORDS = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))

_TO_WORDS = bytes(b if b in _IN_WORDS else 32 for b in bytes(range(256)).lower())


class Checksums:
    """crc32 of byte strings put together from the crc32 of their parts."""

    LONGEST_STEP = 64

    def __init__(self):
        # the register after one zero byte, by its low byte; then tables for 0, 1, 2, ... zero bytes
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = (byte >> np.uint32(1)) ^ np.where(byte & np.uint32(1), POLYNOMIAL, np.uint32(0))
        steps = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(self.LONGEST_STEP):
            steps.append((steps[-1] >> np.uint32(8)) ^ byte[steps[-1] & np.uint32(255)])
        self.steps = np.stack(steps)

    def shift(self, crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What the checksums become below ``sizes`` more bytes, without those bytes' own part."""
        crc, sizes = crc.copy(), sizes.copy()
        at = np.arange(len(crc))
        while len(at):
            step, c = np.minimum(sizes[at], self.LONGEST_STEP), crc[at]
            out = np.zeros(len(at), np.uint32)
            for k in range(4):
                out ^= self.steps[step, k, (c >> np.uint32(8 * k)) & np.uint32(255)]
            crc[at] = out
            sizes[at] -= step
            at = at[sizes[at] > 0]
        return crc

    def join(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """crc32 of a + b from both checksums and the sizes of b."""
        return self.shift(first, sizes) ^ second


def words_of(text: str) -> bytes:
    """The words of a text, with white space around them."""
    return text.encode().translate(_TO_WORDS)


def _chunks(texts: list[str], limit: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Chunks of about ``limit`` bytes: words, the text each belongs to, and whether it is new.

    A text that is cut goes on with its last words, which are not new, before the next ones.
    """
    words: list[bytes] = []
    sizes: list[tuple[int, int, bool]] = []
    total = 0

    def out():
        n = np.array([s[1] for s in sizes], np.int64)
        return words, np.repeat([s[0] for s in sizes], n), np.repeat([s[2] for s in sizes], n)

    for i, text in enumerate(texts):
        body, start = words_of(text), 0
        while start < len(body):
            end = len(body) if len(body) - start <= limit else body.rfind(b" ", start, start + limit)
            end = end if end > start else body.find(b" ", start + limit)
            end = len(body) if end < 0 else end
            own = body[start:end].split()
            words += own
            sizes.append((i, len(own), True))
            total += end - start
            start = end
            if total >= limit:
                yield out()
                rest = words[-(LONGEST - 1) :] if start < len(body) else []
                if rest:
                    held = sum(s[1] for s in sizes if s[0] == i)
                    rest = rest[-held:] if held else []
                words, sizes, total = list(rest), [(i, len(rest), False)], 0
    if words:
        yield out()


def features(texts: list[str], sums: Checksums, limit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(text, bucket, length)`` arrays: all features of the texts, by chunk and length."""
    for words, owner, new in _chunks(texts, limit or FLUSH_CHARS):
        if not words:
            continue
        number = Numbers()
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        known = list(number)
        crc = np.fromiter(map(zlib.crc32, known), np.uint32, len(known))[ids]
        spaced = np.fromiter((zlib.crc32(b" " + w) for w in known), np.uint32, len(known))[ids]
        size = np.fromiter(map(len, known), np.int64, len(known))[ids] + 1
        run = crc
        yield owner[new], run[new] % BUCKETS, 1
        for n in range(2, LONGEST + 1):
            if len(words) < n:
                break
            run = sums.join(run[:-1], spaced[n - 1 :], size[n - 1 :])
            whole = (owner[n - 1 :] == owner[: len(owner) - n + 1]) & new[n - 1 :]
            yield owner[n - 1 :][whole], run[whole] % BUCKETS, n


def bucket_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket, c``: how many features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, total = Checksums(), np.zeros(BUCKETS, np.int64)
        size = lambda b: b["text"].str.len().astype(int) + 1
        for batch in flushes(batches, size, FLUSH_CHARS):
            for _, bucket, _ in features(batch["text"].tolist(), sums):
                total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "c": total[at]})

    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")
    return texts.mapInPandas(count, "bucket int, c long").groupBy("bucket").agg(F.sum("c").alias("c"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text") -> np.ndarray:
    """The gain of each bucket, in thousandths of a natural logarithm, as BUCKETS integers."""
    spark = docs.sparkSession
    own = bucket_counts(docs, text_col).withColumnRenamed("c", "s")
    aim = bucket_counts(target, target_col).withColumnRenamed("c", "t")
    table = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table = table.join(own, "bucket", "left").join(aim, "bucket", "left").na.fill(0)
    rows = table.orderBy("bucket").collect()  # one row for each bucket, whatever the corpus
    s, t = (np.array([r[c] for r in rows], np.float64) for c in ("s", "t"))
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_words, n_features, weight`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    texts = docs.select(*(c.alias(n) for n, c in keep.items()), F.col(text_col).cast("string").alias("__text"))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, gain = Checksums(), shared.value
        size = lambda b: b["__text"].str.len().fillna(0).astype(int) + 1
        for batch in flushes(batches, size, FLUSH_CHARS):
            n = len(batch)
            n_words, n_features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for owner, bucket, length in features(batch["__text"].fillna("").tolist(), sums):
                if not len(owner):
                    continue
                first = runs(owner)
                at, many = owner[first], np.diff(np.r_[first, len(owner)])
                n_features[at] += many
                weight[at] += np.add.reduceat(gain[bucket], first)
                if length == 1:
                    n_words[at] += many
            out = batch.drop(columns="__text")
            yield out.assign(n_words=n_words, n_features=n_features, weight=weight)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "__text")
    return texts.mapInPandas(add, f"{kinds}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int) -> Column:
    """The Gumbel term of a row, in thousandths, drawn by a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def least_with(count: Callable[[int], int], low: int, high: int, want: int) -> int:
    """The least value v in [low, high] with count(values <= v) >= want, by bisection."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if count(middle) >= want else (middle + 1, high)
    return low


def cutoff(rows: DataFrame, keys: list[str], want: int) -> list[int]:
    """The ``want``-th row of ``rows`` in the order of its integer ``keys``, as their values.

    One key after the other is bisected among the rows tied at the ones before it.  The last key
    is different in every row.
    """
    found, tied = [], rows
    for key in keys:
        low, high = tied.agg(F.min(key), F.max(key)).first()
        at = least_with(lambda v: tied.filter(F.col(key) <= v).count(), low, high, want)
        want -= tied.filter(F.col(key) < at).count()
        tied = tied.filter(F.col(key) == at)
        found.append(at)
    return found


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (staged, with ``doc_id, score, place``) and the ``rank`` of the drawn rows.

    ``percent`` of the eligible rows, rounded down, are drawn; the others have a null rank.
    """
    order = ["__down", "__id", "place"]
    rows = scored.withColumns({
        "__down": -F.col("score"), "__id": F.coalesce("doc_id", F.lit(2**63 - 1)), "__in": F.coalesce(eligible, F.lit(False)),
    })
    open_ = rows.filter("__in")
    many = open_.count() * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not many:
        return scored.select("*", none)
    last = cutoff(open_.select(*order), order, many)
    at = F.struct(*(F.col(k) for k in order))
    edge = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip(order, last)))
    drawn = F.col("__in") & (at <= edge)
    parts = parts_for(many, RANK_ROWS)
    dealt = rows.filter(drawn).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stage(dealt.withColumn("__at", F.monotonically_increasing_id()), "resample-drawn")
    part, bits = F.shiftright("__at", 33), F.lit((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    ranks = numbered.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn(
        "rank", F.col("__start") + F.col("__at").bitwiseAND(bits) + 1
    )
    return ranks.select(*scored.columns, "rank").union(rows.filter(~drawn).select(*scored.columns, none))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``."""
    gain = gains(docs, target, text_col, target_col)
    own = F.col(id_col).cast("long")
    keep = {"known": F.coalesce(own, F.lit(0)), "no_id": own.isNull(), "place": F.monotonically_increasing_id()}
    weighed = weigh(docs, gain, keep, text_col).select(
        F.when(~F.col("no_id"), F.col("known")).alias("doc_id"), "n_words", "n_features", "weight", "place"
    )
    scored = stage(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resample-scores")
    return draw(scored, F.col("n_words") >= least_words, percent).drop("place")
