"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

Every benchmark item gives its windows of ``size`` words (one shorter window if the item is
shorter).  A window can only occur where all its words do, so one necessary word is enough
to find it: the rarest of its words, by document frequency over the whole corpus (its prefix
of length one in the rarity order).  Documents' words are joined with these prefix words; the
positional bound (the window must fit around the word) and the length bound (the text must be
long enough) cut candidates before the exact test, which compares the words of the document
around the hit with the words of the window.

Defined results: a null text has no words, an item without words has no window, a window in
several items counts for each of them; rows equal in id and text are one document and all
get its result; repeated item rows count once; a null item id is no item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows of prefix words that are broadcast at most, with their windows; more are shuffled.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    parts = F.split(F.translate(text, UPPER, LOWER), BREAK, -1)
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``window, words, items``: the distinct windows with the items that have them."""
    own = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col).cast("string")).alias("w"))
    own = own.filter("item_id is not null and size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    cut = own.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item_id").alias("items"))


def _bounded(df: DataFrame, width: Column) -> DataFrame:
    """Broadcast ``df`` if its rows and bytes are known to be few."""
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def occurrences(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, text_key, start, length, items``: every place where a window occurs."""
    found = stage(windows(items, size, item_col, item_text), "leaks")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), words(text).alias("w"))
    vocabulary = found.select(F.explode("words").alias("word")).distinct()
    # how many documents have each word of a window; a word of no document rules a window out
    per_doc = texts.select(F.explode(F.array_distinct("w")).alias("word"))
    vocabulary = stage(vocabulary, "leaks")
    known = per_doc.join(_bounded(vocabulary, F.length("word")), "word")
    rarity = stage(known.groupBy("word").agg(F.count("*").alias("n")), "leaks")
    placed = found.select(
        F.xxhash64("words").alias("window"), "words", "items", F.posexplode("words").alias("at", "word")
    )
    prefix = (
        placed.join(rarity, "word", "left")
        .groupBy("window", "words", "items")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("rare"))
        .filter("rare.n > 0")
        .select(F.col("rare.word").alias("word"), F.col("rare.at").alias("at"), "words", "items")
    )
    prefix = stage(prefix, "leaks")
    # the word alone decides first: only words that are some window's rarest go on
    rare = _bounded(prefix.select("word").distinct(), F.length("word"))
    tokens = texts.select("doc_id", "text_key", "w", F.posexplode("w").alias("pos", "word")).join(
        rare, "word", "left_semi"
    )
    full = _bounded(prefix, F.length(F.concat_ws(" ", "words")) + 8 * F.size("items"))
    start = F.col("pos") - F.col("at")
    hit = tokens.join(full, "word").filter((start >= 0) & (start + F.size("words") <= F.size("w")))
    same = F.slice("w", start + 1, F.size("words")) == F.col("words")
    return hit.filter(same).select(
        "doc_id", "text_key", start.alias("start"), F.size("words").alias("length"), "items"
    )


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, text_key, n_hit, items`` for the documents that contain a window."""
    found = stage(
        occurrences(docs, items, size, id_col, text_col, item_col, item_text).distinct(), "leaks"
    )
    # windows end later the later they start, so each adds what lies behind the furthest end
    spans = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans")
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans", zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0))).alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
    )["n"]
    named = found.select("doc_id", "text_key", F.explode("items").alias("item")).distinct()
    names = named.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    hits = spans.select("doc_id", "text_key", covered.cast("long").alias("n_hit"))
    on = hits["doc_id"].eqNullSafe(names["doc_id"]) & (hits["text_key"] == names["text_key"])
    return hits.join(names, on).select(hits["doc_id"], hits["text_key"], "n_hit", "items")


def report(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` for every row of ``docs``."""
    hits = contamination(docs, items, size, id_col, text_col, item_col, item_text).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "n_hit", F.col("items").alias("__items")
    )
    text = F.col(text_col).cast("string")
    # counted at the scan, so that no text is shuffled
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("__own"), F.size(words(text)).cast("long").alias("n_words")
    )
    joined = own.join(hits, own["doc_id"].eqNullSafe(hits["__id"]) & (F.col("__own") == F.col("__key")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
    )
