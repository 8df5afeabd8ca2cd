import hashlib
import random

from tomeworks.llm import substrings


def by_hand(rows, size):
    """Rows are one document if equal; null ids come first."""
    from tomeworks.llm.common import keyed  # noqa: F401

    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, out = set(), {}
    for row in order:
        words = (row[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[row] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def check(docs, size=20):
    keys = substrings.keyed(docs).collect()
    rows = [(r.doc_id, r.text, r.text_key) for r in keys]
    want = by_hand(rows, size)
    got = substrings.digests(docs, size).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(
        (r[0] is not None, r[0] or 0, *want[r]) for r in rows
    )
    return got


def test_against_brute_force(table, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH_CHARS", 3000)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 20_000)
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    passages = [rnd.choices(words, k=rnd.randint(15, 60)) for _ in range(12)]
    rows = []
    for doc in range(150):
        text = []
        for _ in range(rnd.randint(0, 5)):
            part = rnd.choice(passages) if rnd.random() < 0.5 else rnd.choices(words, k=rnd.randint(1, 40))
            text += part[rnd.randint(0, 10) :]
        rows.append((doc, rnd.choice([" ", "\n", "  "]).join(text)))
    rows += [(150 + i, rows[3][1]) for i in range(20)] + [(999, "same " * 100)]
    check(table(rows))


def test_odd_rows(odd, table):
    got = check(odd)
    assert {r.n_removed for r in got if r.doc_id == 2} == {22, 0} or any(r.n_removed for r in got if r.doc_id == 2)
    assert substrings.digests(table([])).collect() == []
