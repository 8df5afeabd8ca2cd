import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tomeworks.llm import perplexity


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


def by_hand(train, texts, order):
    counts, raw = [None, *(Counter() for _ in range(order))], Counter()
    for t in train:
        w = [b" start"] * (order - 1) + tokens(t)
        for i in range(order - 1, len(w)):
            raw[w[i]] += 1
            counts[order][tuple(w[i - order + 1 : i + 1])] += 1
    for m in range(order - 1, 0, -1):
        for gram in counts[m + 1]:
            counts[m][gram[1:]] += 1
    sums, discounts = [None, *(defaultdict(lambda: [0, 0, 0, 0]) for _ in range(order))], [None]
    for m in range(1, order + 1):
        of = Counter(counts[m].values())
        discounts.append(perplexity._discounts(np.array([of[k] for k in (1, 2, 3, 4)], float)))
        for gram, c in counts[m].items():
            sums[m][gram[:-1]][0] += c
            sums[m][gram[:-1]][min(c, 3)] += 1
    words, total, out = len(raw), sum(raw.values()), []
    for t in texts:
        w, score, base = [b" start"] * (order - 1) + tokens(t), 0.0, 0.0
        for i in range(order - 1, len(w)):
            p = 1 / (words + 1)
            for m in range(1, order + 1):
                gram = tuple(w[i - m + 1 : i + 1])
                s = sums[m].get(gram[:-1])
                if s:
                    c, d = counts[m].get(gram, 0), discounts[m]
                    p = max(c - d[min(c, 3)], 0) / s[0] + sum(d[k] * s[k] for k in (1, 2, 3)) / s[0] * p
            score += math.log10(p)
            base += math.log10((raw[w[i]] + 0.5) / (total + 0.5 * (words + 1)))
        out.append((len(w) - order + 1, sum(raw[x] > 0 for x in w[order - 1 :]), base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(perplexity, "SHARD_BYTES", 100_000)
    monkeypatch.setattr(perplexity, "FLUSH_CHARS", 50_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = F.pmod("doc_id", F.lit(5)) == 1
    model = perplexity.fit(docs.filter(~held), order)
    assert model.shards > 1
    got = {r.doc_id: r for r in perplexity.score(docs, model).collect()}
    rows = docs.collect()
    want = by_hand([r.text for r in rows if r.doc_id % 5 != 1], [r.text for r in rows], order)
    for r, w in zip(rows, want):
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_known) == w[:2]
        assert abs(g.base_score - w[2]) < 1e-6 and abs(g.score - w[3]) < 1e-6


def test_odd_rows(odd, table):
    model = perplexity.fit(odd)
    found = perplexity.score(odd, model).collect()
    assert len(found) == odd.count()
    assert {r.n_tokens for r in found if r.doc_id in (3, 4, 5)} == {1}
    empty = perplexity.fit(table([]))
    assert {r.score for r in perplexity.score(odd, empty).collect()} == {0.0}
    assert perplexity.score(table([]), model).collect() == []


def test_the_model_needs_a_mounted_folder():
    assert perplexity.mounted("file:///shared/x%20y") == "/shared/x y"
    with pytest.raises(ValueError):
        perplexity.mounted("hdfs://name/shared")


def test_the_query_uses_two_words_of_context(spark):
    from tomeworks.llm.registered import QUERIES

    got = {r.doc_id: r for r in QUERIES["op2_perplexity"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = by_hand([r.text for r in rows if not got[r.doc_id].held_out], [r.text for r in rows], 3)
    assert all(abs(got[r.doc_id].score - w[3]) < 1e-6 for r, w in zip(rows, want))


@pytest.mark.parametrize("level, top", [(1, 1), (1, 3), (2, 3), (3, 3)])
def test_packed_ngrams_come_back_and_are_small(level, top):
    rng = np.random.default_rng(level)
    vocabulary = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    columns = [vocabulary[rng.zipf(1.3, 40_000) % 3000] for _ in range(level)]
    count, raw = rng.integers(1, 9, 40_000).astype(np.uint64), rng.integers(1, 1 << 40, 40_000).astype(np.uint64)
    shard = columns[-1] % np.uint64(3)
    rows = list(perplexity._pack(level, top, shard, columns[:-1], columns[-1], count, raw))
    got, want = set(), {}
    for s in {r[0] for r in rows}:
        before, *rest = perplexity._unpack(pd.DataFrame([r for r in rows if r[0] == s], columns=perplexity._COLUMNS), level, top)
        got |= {(s, *x) for x in zip(*(c.tolist() for c in (*before, *rest)))}
    last = raw if level < top else count
    want = set(zip(*(c.tolist() for c in (shard, *columns, count, last))))
    assert got == want
    if top == level == 3:
        assert sum(len(r[-1]) for r in rows) < 8 * 40_000
