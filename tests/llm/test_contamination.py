import random
import re

from tomeworks.llm import contamination


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def by_hand(text, items, size):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        own = words(t)
        for window in [own[i : i + size] for i in range(max(1, len(own) - size + 1))] if own and item is not None else []:
            for s in range(len(w) - len(window) + 1):
                if w[s : s + len(window)] == window:
                    hit |= set(range(s, s + len(window)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def check(docs, items, size=10):
    rows = [(r.item_id, r.text) for r in items.collect()]
    want = sorted((r.doc_id or 0, *by_hand(r.text, rows, size)) for r in docs.collect())
    got = contamination.report(docs, items, size).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, list(r["items"])) for r in got) == want


def test_against_brute_force(table, monkeypatch):
    rnd = random.Random(4)
    vocabulary = ["the", "of", "and", *[f"w{i}" for i in range(60)]]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 25)))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, "..."), (None, "w1 w2"), (92, items[4][1].upper())]
    docs = []
    for d in range(120):
        text = rnd.choices(vocabulary, k=rnd.randint(0, 60))
        if rnd.random() < 0.5:
            own = rnd.choice(items[:25])[1].split()
            text[5:5] = own[rnd.randint(0, 3) :]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(text).title()))
    frames = table(docs), table(items, "item_id long, text string")
    check(*frames)
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    check(*frames, size=4)


def test_odd_rows(odd, table):
    items = table([(1, "runs away from the big red barn at noon"), (2, "word word word"), (3, "日本語のテキスト")], "item_id long, text string")
    check(odd, items)
    check(odd, table([], "item_id long, text string"))
    check(table([]), items)
