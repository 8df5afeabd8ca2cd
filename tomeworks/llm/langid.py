"""Language identification by unigram piece models with marginalised segmentations.

Every language has a probability for each piece of a fixed public vocabulary.  The
probability of a word is the sum over all ways to cut it into pieces, found by the forward
algorithm; the probability of a text is the product over its words.  The piece
probabilities are fitted by expectation maximisation: forward and backward sums over the
distinct words of labelled texts give expected piece counts, summed by Spark.

Fitting takes a sample of about ``fit_docs`` labelled texts per language, chosen by a hash
of the id; prediction covers every row.

Defined results: a null text, an empty one, and one without a letter give ``und`` with score
0; so does every text when nothing is learned.  The score is the posterior probability of
the predicted language under the share of each language among the labelled rows.  Ties go
to the smaller language name.  Letters outside the vocabulary cost the same in every
language.  Rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Numbers, by_length, flushes, stage

UNKNOWN = "und"
START = "▁"
# A run of letters is cut after 32 of them, so that no sum leaves the range of a double.
_WORDS = re.compile(r"[^\W\d_]{1,32}")
# Probability of a letter that no piece covers, and the pseudo-count of a piece.
RARE = 1e-7
SMOOTH = 0.05
# Characters whose words a worker holds at once.
FLUSH_CHARS = 2_000_000
# Words scored at once, and words whose scores a worker keeps.
BATCH_WORDS = 20_000
KEPT_WORDS = 100_000


@dataclass
class Model:
    """``piece -> row`` and the log probability of each piece (row) in each language."""

    langs: list[str]
    rows: dict[str, int]
    logp: np.ndarray
    prior: np.ndarray


def vocabulary(model_file: str) -> list[str]:
    """Pieces of letters in lower case, with or without a word start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    fit = lambda p: p.lower() == p and p.removeprefix(START).isalpha()
    return sorted({p for p in pieces if p == START or fit(p)})


def words_in(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


class Pieces:
    """Looks pieces up by a hash of their signs, for many words at once."""

    def __init__(self, rows: dict[str, int]):
        self.size = len(rows)
        self.by_length = {}
        self.longest = max(map(len, rows), default=1)
        for n in sorted({len(p) for p in rows}):
            own = [p for p in rows if len(p) == n]
            codes = np.array([[ord(c) for c in p] for p in own], np.uint64)
            h = np.zeros(len(own), np.uint64)
            for k in range(n):
                h = _roll(h, codes[:, k])
            order = np.argsort(h)
            self.by_length[n] = h[order], np.array([rows[p] for p in own], np.int32)[order]

    def arcs(self, words: list[str]) -> tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]:
        """Signs of each word, and (from, length) -> piece of each word; ``size`` stands for
        none and ``size + 1`` for a letter without a piece of its own."""
        lengths = np.array([len(w) + 1 for w in words])
        width = int(lengths.max())
        flat = np.frombuffer((START + START.join(words)).encode("utf-32-le"), np.uint32)
        codes = np.zeros((len(words), width), np.uint64)
        codes[np.arange(width) < lengths[:, None]] = flat
        found = {}
        for begin in range(width):
            h = np.zeros(len(words), np.uint64)
            for n in range(1, min(self.longest, width - begin) + 1):
                h = _roll(h, codes[:, begin + n - 1])
                hashes, own = self.by_length.get(n, (np.zeros(0, np.uint64), np.zeros(0, np.int32)))
                row = np.full(len(words), self.size, np.int32)
                if len(hashes):
                    at = np.searchsorted(hashes, h)
                    at[at == len(hashes)] = 0
                    hit = (hashes[at] == h) & (begin + n <= lengths)
                    row[hit] = own[at[hit]]
                if n == 1:
                    row[(row == self.size) & (begin < lengths)] = self.size + 1
                if (row != self.size).any():
                    found[begin, n] = row
        return lengths, found


def _roll(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (h ^ code) * np.uint64(0x9E3779B97F4A7C15) + (h >> np.uint64(29))


def _chunks(words: list[str]) -> Iterator[np.ndarray]:
    """Positions of words of about the same length, so that a table of sums stays small."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    lengths = lengths[order]
    start = 0
    while start < len(order):
        stop = min(start + BATCH_WORDS, int(np.searchsorted(lengths, 2 + 1.5 * lengths[start], "right")))
        yield order[start:stop]
        start = stop


def score_words(words: list[str], pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Log of the forward sum of each word in each language."""
    table = np.vstack([np.exp(logp), np.zeros((1, logp.shape[1])), np.full((1, logp.shape[1]), RARE)])
    out = np.empty((len(words), logp.shape[1]))
    for part in _chunks(words):
        lengths, found = pieces.arcs([words[i] for i in part])
        fore = np.zeros((int(lengths.max()) + 1, len(part), logp.shape[1]))
        fore[0] = 1
        for (begin, n), row in found.items():
            fore[begin + n] += fore[begin] * table[row]
        out[part] = np.log(fore[lengths, np.arange(len(part))])
    return out


def expected_counts(words, lang, times, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in every language: forward and backward sums of each
    word in its own language, weighted by how often it occurs."""
    table = np.vstack([np.exp(logp), np.zeros((1, logp.shape[1])), np.full((1, logp.shape[1]), RARE)])
    total = np.zeros(logp.shape[1] * (pieces.size + 2))
    for part in _chunks(words):
        lengths, found = pieces.arcs([words[i] for i in part])
        own, n = lang[part], len(part)
        fore = np.zeros((int(lengths.max()) + 1, n))
        back = np.zeros_like(fore)
        fore[0] = 1
        back[lengths, np.arange(n)] = 1
        for (begin, k), row in found.items():
            fore[begin + k] += fore[begin] * table[row, own]
        weight = times[part] / fore[lengths, np.arange(n)]
        for (begin, k), row in reversed(found.items()):
            step = table[row, own] * back[begin + k]
            back[begin] += step
            total += np.bincount(
                own * (pieces.size + 2) + row, fore[begin] * step * weight, minlength=len(total)
            )
    return total.reshape(logp.shape[1], -1)[:, : pieces.size].T


def fit(
    labelled: DataFrame,
    model_file: str,
    fit_docs: int = 1500,
    rounds: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """A model of the languages in ``lang_col``; rows without text or language are passed over."""
    rows = labelled.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    pieces = {p: i for i, p in enumerate(vocabulary(model_file))}
    prior = np.log(np.array([counts[x] for x in langs], float) / max(1, sum(counts.values())))
    model = Model(langs, pieces, np.full((len(pieces), len(langs)), -np.log(len(pieces))), prior)
    if not langs:
        return model
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_docs / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_003)) / 1_000_003
    sample = rows.filter(place < share).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in flushes(batches, by_length("text"), FLUSH_CHARS):
            found = Counter()
            for lang, text in zip(batch["lang"], batch["text"]):
                for word, n in Counter(words_in(text)).items():
                    found[lang, word] += n
            yield pd.DataFrame([(k[0], k[1], n) for k, n in found.items()], columns=["lang", "word", "n"])

    found = sample.mapInPandas(count, "lang string, word string, n long")
    words = stage(found.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid")
    for _ in range(rounds):
        model.logp = _improve(words, model)
    return model


def _improve(words: DataFrame, model: Model) -> np.ndarray:
    """One round: expected piece counts over all words, then new probabilities."""
    index = {lang: i for i, lang in enumerate(model.langs)}

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model.rows)
        total = np.zeros((len(model.rows), len(model.langs)))
        for batch in batches:
            lang = batch["lang"].map(index).to_numpy(np.int64)
            total += expected_counts(batch["word"].tolist(), lang, batch["n"].to_numpy(float), pieces, model.logp)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"lang": lang, "piece": piece, "n": total[piece, lang]})

    # a row for each language and piece of the fixed vocabulary comes to the driver
    found = (
        words.mapInPandas(expect, "lang int, piece int, n double")
        .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    )
    table = np.full((len(model.rows), len(model.langs)), SMOOTH)
    table[found["piece"], found["lang"]] += found["n"]
    return np.log(table / table.sum(0))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``keep`` (by default ``doc_id``) with ``lang_pred, score`` for every row."""
    keep = keep or {"doc_id": F.col("doc_id")}
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    names = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model.rows)
        known = Numbers()
        scores = np.zeros((0, len(model.langs)))
        for batch in flushes(batches, by_length("__text"), FLUSH_CHARS):
            lists = [words_in(t) for t in batch["__text"]]
            if len(known) > KEPT_WORDS:
                known, scores = Numbers(), scores[:0]
            first = len(known)
            ids = np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
            fresh = list(known)[first:]
            if fresh:
                scores = np.vstack([scores, score_words(fresh, pieces, model.logp)])
            row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            sums = [np.bincount(row, scores[ids, k], len(lists)) for k in range(len(model.langs))]
            sums = np.array(sums).reshape(len(model.langs), len(lists)).T
            yield _judge(batch[names], sums + model.prior, [bool(x) for x in lists], model.langs)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInPandas(run, f"{schema}, lang_pred string, score double")


def _judge(keys: pd.DataFrame, sums: np.ndarray, lettered: list[bool], langs: list[str]) -> pd.DataFrame:
    out = keys.copy()
    if not langs:
        out["lang_pred"], out["score"] = UNKNOWN, 0.0
        return out
    best = sums.argmax(1)
    odds = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
    lettered = np.array(lettered, bool)
    out["lang_pred"] = np.where(lettered, np.array(langs, object)[best], UNKNOWN)
    out["score"] = np.where(lettered, odds, 0.0)
    return out
