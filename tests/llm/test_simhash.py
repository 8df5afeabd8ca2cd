import random

import numpy as np
import xxhash

from tomeworks.llm import simhash
from tomeworks.llm.common import components


def by_hand(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints(odd):
    found = simhash.fingerprints(odd).collect()
    texts = sorted(by_hand(r.text, 3) for r in odd.collect())
    assert sorted(r.fp % (1 << 64) for r in found) == texts


def test_trie_join_is_exact(spark, monkeypatch):
    rnd = random.Random(3)
    heads = [rnd.getrandbits(64) for _ in range(40)]
    fps = {0, (1 << 64) - 1, 1 << 63}
    for head in heads:
        fps.add(head)
        for _ in range(20):
            fps.add(head ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) % (1 << 64))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for rows, budget in ((8192, 2), (16, 2), (16, 4)):
        monkeypatch.setattr(simhash, "NODE_ROWS", rows)
        monkeypatch.setattr(simhash, "OUTRIGHT", 4)
        found = components(simhash.linked(df, budget)).collect()
        pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= budget]
        want = groups_of(pairs, fps)
        got = {r.node % (1 << 64): r.root for r in found}
        sides = {}
        for n in fps:
            sides.setdefault(want[n], set()).add(got.get(n, np.array([n], np.uint64).view(np.int64)[0]))
        assert all(len(s) == 1 for s in sides.values())
        assert len({next(iter(s)) for s in sides.values()}) == len(sides)


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (8, 7), (7, 8)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, 8, *range(200, 260)]}
    assert components(edges.limit(0)).collect() == []


def test_odd_rows(odd, table):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    same = {r.component_id for r in found if r.doc_id in (1,) or r.fp == 0}
    assert same == {1, 3}
    assert simhash.near_duplicates(table([])).collect() == []


def near_copies():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for base in range(12):
        words = rnd.choices(vocabulary, k=rnd.randint(40, 400))
        for _ in range(1 if base < 4 else 9):
            copy = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 80))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_dropping_keeps_the_least_id_of_each_group(table):
    rows = near_copies()
    prints = {i: by_hand(t, 3) for i, t in rows}
    pairs = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2]
    want = groups_of(pairs, prints)
    assert len(set(prints.values())) > len(set(want.values())) > 12
    for docs in (table(rows), table(rows[::-1]).repartition(5)):
        kept = [r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()]
        assert sorted(kept) == sorted(set(want.values()))


def test_one_row_of_each_group_stays(odd, table):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    got = sorted((r.doc_id or 0, (r.text or "")[:7]) for r in kept.collect())
    assert got == [
        (0, "a row w"), (1, "The qui"), (2, "another"), (3, ""), (6, "12345 6"), (7, "word wo"), (8, "xxxxxxx"), (9, "Ünïcödé"),
    ]
    assert simhash.drop_near_duplicates(table([])).collect() == []
