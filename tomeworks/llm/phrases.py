"""Phrase collocations, mined the way Toivonen does it.

A sample of the documents is mined level by level with a lowered threshold; the phrases it
shows to be frequent are the proposals.  A pass over all documents counts every proposal and
its negative border: the phrases that are not proposed although the phrase without its first
word and the phrase without its last word both are (any single word).  If a phrase of the
border turns out to be frequent, the proposals and the border grow by it, and a further
pass counts what the growth has brought in.  When a pass shows no such phrase, none that is frequent
can be uncounted, whatever the sample was; at most one pass for each length.

These passes count 64-bit hashes of phrases, which tasks sort and add up by shards; two phrases
of one hash can only be counted too high, so nothing frequent is missed.  A last pass counts the
phrases that were found under their own text, and these exact counts alone make the result.

Proposals reach the tasks as a bit filter, at most ``FILTER_BYTES`` a pass.  A phrase that
the filter takes for a proposal by mistake is only one more phrase that is counted; with far more
proposals than bits the passes count more, and the result stays the same.

Defined results: a null or empty text has no words; a null language is ``und``; an empty table
gives no rows; repeated rows count each time; a text of any length is read in chunks cut
between pieces (a piece without any mark is held whole); equal scores are ordered by count
and then by the phrase's bytes.  Only the id, the text and the language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Numbers, flushes, hashes, mix, parts_for, runs, stage, text_bytes

LONGEST = 4
# Share of the documents that proposes phrases, and what part of the threshold they need there.
SAMPLE, LOWERED = 0.125, 0.5
FLUSH_CHARS = 4_000_000
# Bytes of text for each shard of the hash counts.
SHARD_BYTES = 24_000_000
# Bits for each proposal, the largest filter, and the part of it that one task builds.
BITS_EACH, FILTER_BYTES, BLOCK_BYTES = 16, 1 << 25, 1 << 16

# The marks that end a piece, a byte that no UTF-8 text holds in their place,
# and the language of rows without one.
MARKS = b".,;:!?\n\x0b\x0c\r"
CUT = b"\xff"
NO_LANG = "und"

_TO_CUT = bytes.maketrans(MARKS, CUT * len(MARKS))


class Filter:
    """A set of phrase hashes with two bits each."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in self.places(h, self.mask):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    @staticmethod
    def places(h: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
        return [h & mask, mix(h, np.uint64(1)) & mask]


def build_filter(found: DataFrame) -> Filter:
    """The filter of the hashes ``found(h)``; tasks set bits, the driver joins the parts."""
    size = 1 << 17
    need = found.count() * BITS_EACH
    while size * 8 < need and size < FILTER_BYTES:
        size *= 2
    mask, per_block = np.uint64(size * 8 - 1), BLOCK_BYTES * 8

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h = batch["h"].to_numpy(np.int64).view(np.uint64)
            at = np.unique(np.concatenate(Filter.places(h, mask)).astype(np.int64))
            block = at // per_block
            first = runs(block)
            parts = np.split((at % per_block).astype(np.uint32), first[1:]) if len(at) else []
            yield pd.DataFrame({"block": block[first], "at": [p.tobytes() for p in parts]})

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(per_block, np.uint8)
        for at in rows["at"]:
            bits[np.frombuffer(at, np.uint32)] = 1
        return pd.DataFrame({"block": rows["block"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    blocks = found.select("h").mapInPandas(place, "block long, at binary")
    bits = np.zeros(size, np.uint8)
    for row in blocks.groupBy("block").applyInPandas(fill, "block long, bits binary").toLocalIterator():
        start = row.block * BLOCK_BYTES
        bits[start : start + BLOCK_BYTES] = np.frombuffer(row.bits, np.uint8)
    return Filter(bits)


def _chunks(texts: list[str], limit: int) -> Iterator[list[bytes]]:
    """Words in order, CUT between pieces, in chunks of about ``limit`` bytes."""
    for lo, hi in _ranges(texts, limit):
        body = CUT.join(t.encode() for t in texts[lo:hi]).lower().translate(_TO_CUT)
        start = 0
        while start < len(body):
            end = len(body) if len(body) - start <= 2 * limit else body.find(CUT, start + limit)
            end = len(body) if end < 0 else end
            yield body[start:end].replace(CUT, b" " + CUT + b" ").split()
            start = end


def _ranges(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    lo = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield lo, i
            lo, total = i, 0
        total += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def _member(filters: list[Filter], h: np.ndarray) -> np.ndarray:
    found = np.zeros(len(h), bool)
    for f in filters:
        found |= f.has(h)
    return found


class Level:
    """The phrases of ``n`` words of one chunk that a pass reaches: hash, count, and the phrase
    and word that make up each."""

    def __init__(self, n, h, counts, below=None, first=None, last=None, words=None):
        self.n, self.h, self.counts = n, h, counts
        self.below, self.first, self.last, self.words = below, first, last, words

    def texts(self, at: np.ndarray) -> np.ndarray:
        if self.below is None:
            return self.words[at]
        return self.below.texts(self.first[at]) + " " + self.words[self.last[at]]


def walk(lang: str, words: list[bytes], filters: list[Filter], before: int | None) -> Iterator[tuple[Level, np.ndarray]]:
    """Levels of one chunk, each with the phrases to count.

    A phrase is reached if its first n - 1 words and its last n - 1 words are proposed by ``filters``.
    With ``before`` those that the first ``before`` filters reached already are not counted again.
    """
    number = Numbers({CUT: 0})
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    known = list(number)
    shown = np.array(["", *[w.decode() for w in known[1:]]], object)
    own = hashes(known)
    # phrase 0 stands for none; units holds the phrase of the present length at each place
    level = Level(1, mix(np.full(len(own), hashes([lang.encode()])[0]), own), np.bincount(ids, minlength=len(known)), words=shown)
    units, counted_before = ids, np.full(len(known), before is not None)
    while True:
        counted_before[0] = True
        yield level, np.flatnonzero(~counted_before)
        if level.n == LONGEST:
            return
        proposed = _member(filters, level.h)
        earlier = _member(filters[:before], level.h) if before else np.zeros(len(level.h), bool)
        left, right, last = units[:-1], units[1:], ids[level.n :]
        at = np.flatnonzero((left > 0) & (right > 0) & proposed[left] & proposed[right])
        if not len(at):
            return
        _, first, inverse = np.unique(left[at] * len(known) + last[at], return_index=True, return_inverse=True)
        units = np.zeros(len(left), np.int64)
        units[at] = inverse + 1
        one, two, end = (np.r_[0, x[at[first]]] for x in (left, right, last))
        # a filter may take a phrase for a proposal whose own parts were not proposed then
        counted_before = counted_before[one] & counted_before[two] & earlier[one] & earlier[two]
        level = Level(level.n + 1, mix(level.h[one], own[end]), np.r_[0, np.bincount(inverse)], level, one, end, shown)


def _levels(batch: pd.DataFrame, filters: list[Filter], before: int | None) -> Iterator[tuple[str, Level, np.ndarray]]:
    for lang, rows in batch.groupby("lang"):
        for words in _chunks(rows["text"].tolist(), FLUSH_CHARS):
            for level, at in walk(lang, words, filters, before):
                yield lang, level, at


def _by_chars(batch: pd.DataFrame) -> pd.Series:
    return batch["text"].str.len().astype(int) + 1


def hash_pass(texts: DataFrame, filters: list[Filter], before: int | None, least: int, shards: int) -> DataFrame:
    """``n, h, proposed`` of all hashes that one pass over ``texts(lang, text)`` counts ``least`` times or more."""
    shared = texts.sparkSession.sparkContext.broadcast([f.bits for f in filters])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = [Filter(bits) for bits in shared.value]
        for batch in flushes(batches, _by_chars, FLUSH_CHARS):
            held: dict[int, list] = {}
            for _, level, at in _levels(batch, mine, before):
                held.setdefault(level.n, []).append((level.h[at], level.counts[at]))
            rows = []
            for n, parts in held.items():
                h, c = (np.concatenate(x) for x in zip(*parts))
                shard = ((h >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((h, shard))
                for part in np.split(order, runs(shard[order])[1:]) if len(order) else []:
                    rows.append((int(shard[part[0]]), n, h[part].tobytes(), c[part].astype(np.uint32).tobytes()))
            yield pd.DataFrame(rows, columns=["shard", "n", "h", "c"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        mine, out = [Filter(bits) for bits in shared.value], []
        for n, own in rows.groupby("n"):
            h = np.concatenate([np.frombuffer(x, np.uint64) for x in own["h"]])
            c = np.concatenate([np.frombuffer(x, np.uint32) for x in own["c"]]).astype(np.int64)
            order = np.argsort(h, kind="stable")
            first = runs(h[order])
            total = np.add.reduceat(c[order], first)
            often = h[order[first[total >= least]]]
            out.append(pd.DataFrame({"n": n, "h": often.view(np.int64), "proposed": _member(mine, often)}))
        return pd.concat(out)

    counted = texts.mapInPandas(count, "shard int, n int, h binary, c binary").repartitionById(shards, F.col("shard"))
    return counted.groupBy("shard").applyInPandas(add, "n int, h long, proposed boolean")


def mine(texts: DataFrame, least: int, filters: list[Filter], shards: int) -> tuple[DataFrame, list[Filter]]:
    """``n, h`` of all that may be found ``least`` times or more, and the filters that reach them."""
    found, before = None, None
    while True:
        counted = stage(hash_pass(texts, filters, before, least, shards), "phrases")
        found = counted if found is None else found.union(counted)
        missed = counted.filter((F.col("n") < LONGEST) & ~F.col("proposed"))
        if missed.isEmpty():
            return found.drop("proposed"), filters
        before, filters = len(filters), [*filters, build_filter(missed)]


def text_pass(texts: DataFrame, filters: list[Filter], chosen: Filter, least: int) -> DataFrame:
    """``lang, n, phrase, c`` of the phrases whose hash is ``chosen``, if found ``least`` times or more;
    n is 0 in the row of all words of a language."""
    shared = texts.sparkSession.sparkContext.broadcast([chosen.bits, *[f.bits for f in filters]])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, *mine = [Filter(bits) for bits in shared.value]
        for batch in flushes(batches, _by_chars, FLUSH_CHARS):
            for lang, level, at in _levels(batch, mine, None):
                if level.n == 1 and len(at):
                    yield pd.DataFrame({"lang": [lang], "n": [0], "phrase": [""], "c": [level.counts[at].sum()]})
                at = at[wanted.has(level.h[at])]
                if len(at):
                    yield pd.DataFrame({"lang": lang, "n": level.n, "phrase": level.texts(at), "c": level.counts[at]})

    counted = texts.mapInPandas(count, "lang string, n int, phrase string, c long")
    return counted.groupBy("lang", "n", "phrase").agg(F.sum("c").alias("c")).filter((F.col("c") >= least) | (F.col("n") == 0))


def frequent(
    docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, n, phrase, c``: every phrase of up to four words found ``least`` times or more in
    its language, with exact counts; rows with n = 0 hold the number of all words."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), text.alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(1 << 20)).alias("draw"),
    ).filter("text is not null")
    texts = rows.select("lang", "text")
    sample = stage(rows.filter(F.col("draw") < int(SAMPLE * (1 << 20))).select("lang", "text"), "phrases-sample")
    shards = parts_for(text_bytes(texts), SHARD_BYTES)
    proposals, _ = mine(sample, max(2, int(least * SAMPLE * LOWERED)), [], shards)
    found, filters = mine(texts, least, [build_filter(proposals.filter(F.col("n") < LONGEST))], shards)
    return text_pass(texts, filters, build_filter(found), least)


def _wide(c: str | Column) -> Column:
    """A count as a decimal, whose products are exact beyond 64 bits."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, least: int = 30, share: int = 80, first: int = 2000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` best phrases of each language.

    The score of a phrase is that of its weakest cut; phrases that are at least ``share``
    percent of the time part of one and the same longer phrase are left out.
    """
    table = stage(frequent(docs, least, id_col, text_col, lang_col), "phrases-frequent")
    counts = table.filter("n > 0").select("lang", "phrase", "c")
    long = table.filter("n > 1").select("lang", "n", "phrase", F.col("c").alias("a"), F.split("phrase", " ").alias("w"))
    k, n, w = F.col("k"), F.col("n"), F.col("w")
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), n - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(w, F.lit(1), k), " ").alias("head"), F.array_join(F.slice(w, k + 1, n - k), " ").alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("c").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("c").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumns(
        {"top": _wide("a") * F.lit(2_000_000).cast("decimal(7,0)"), "low": _wide(F.col("l") + F.col("r"))}
    )
    weakest = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr("top div low").alias("score"), "k", "l", "r")).alias("cut")
    )
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), n - 1),
        lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.array_join(F.slice(w, at, size), " ")),
    ))
    within = (
        long.filter("n > 2").select("lang", F.col("a").alias("longer"), F.explode(spans).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    hidden = F.coalesce(_wide("longer") * F.lit(100) >= _wide("a") * F.lit(share), F.lit(False))
    kept = weakest.join(within, ["lang", "phrase"], "left").filter(~hidden)
    place = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    totals = table.filter("n = 0").select("lang", F.col("c").alias("n"))
    ranked = kept.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
