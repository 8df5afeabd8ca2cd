import re
from collections import Counter

import pytest
from llm_rows import ODD_TEXTS

from tomeworks.llm import phrases

LANGS = ["en", None, "und", "de"]


def brute(rows, least, share, first):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    often = {key: c for key, c in counts.items() if c >= least}
    hidden = set()
    for (lang, p), c in often.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                if 100 * c >= share * often[lang, p[i : i + n]]:
                    hidden.add((lang, p[i : i + n]))
    out = []
    for (lang, p), a in often.items():
        if len(p) > 1 and (lang, p) not in hidden:
            cuts = [(often[lang, p[:k]], often[lang, p[k:]]) for k in range(1, len(p))]
            score, k = min((2_000_000 * a // (l + r), k) for k, (l, r) in enumerate(cuts))
            out.append((lang, " ".join(p), a, *cuts[k], totals[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[-1], -r[2], r[1].encode()))
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own[:first], 1)]
    return sorted(ranked)


def rows():
    odd = [(i, text, LANGS[k % 4]) for k, (i, text) in enumerate(ODD_TEXTS)]
    more = [
        (100 + i, f"New York, New York! the Old town of new york {i % 7} is old\x0bnew york\x0cin\ta b a b a b {'x y z ' * (i % 5)}", LANGS[i % 4])
        for i in range(60)
    ]
    return odd + more + more[:3] + [(300 + i, "Ünï cödé ünï cödé", "de") for i in range(9)]


@pytest.mark.parametrize("least, share, first", [(2, 80, 2000), (5, 100, 3), (30, 80, 2000)])
def test_against_brute_force(spark, tmp_path, monkeypatch, least, share, first):
    monkeypatch.setattr(phrases, "FLUSH_CHARS", 300)
    spark.createDataFrame(rows(), "doc_id long, text string, lang string").withColumn("n", phrases.F.lit("clash")).withColumn(
        "phrase", phrases.F.lit(1)
    ).repartition(3).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    got = sorted(tuple(r) for r in phrases.collocations(docs, least, share, first).collect())
    assert got == brute(rows(), least, share, first)


def exact(texts, least, filters):
    found, filters = phrases.mine(texts, least, filters, 3)
    return sorted(map(tuple, phrases.text_pass(texts, filters, phrases.build_filter(found), least).collect()))


def test_any_proposals_close_to_the_same_result(spark, monkeypatch):
    """No sample at all makes every level fail once; a filter full of bits makes nothing fail."""
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    texts = docs.select(phrases.F.coalesce("lang", phrases.F.lit("und")).alias("lang"), "text").filter("text is not null")
    passes = []
    whole = phrases.hash_pass
    monkeypatch.setattr(phrases, "hash_pass", lambda t, f, b, *more: passes.append(b) or whole(t, f, b, *more))
    none = exact(texts, 3, [])
    assert passes == [None, 0, 1, 2]
    passes.clear()
    full = exact(texts, 3, [phrases.Filter(phrases.np.full(64, 255, phrases.np.uint8))])
    assert passes == [None]
    assert none == full


def test_border_failures_are_counted(spark):
    """A word that the proposals lack brings in its phrases by later passes, each counted once."""
    texts = spark.createDataFrame([("en", "a b c d, a b c d")] * 5, "lang string, text string")
    levels = phrases.walk("en", b"a b d".split(), [phrases.Filter(phrases.np.full(64, 255, phrases.np.uint8))], None)
    some = [int(h) for level, _ in levels for h in level.h[1:].view("int64")][:4]
    kept = phrases.build_filter(spark.createDataFrame([(h,) for h in some], "h long"))
    got = {p: c for _, _, p, c in exact(texts, 10, [kept])}
    names = ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d", "a b c d"]
    assert got == {**dict.fromkeys(names, 10), "": 40}


def test_empty_tables_and_exact_products(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(empty).collect() == []
    nulls = spark.createDataFrame([(1, None, None), (None, "", "en"), (2, " ,.; ", None)], empty.schema)
    assert phrases.collocations(nulls, least=1).collect() == []
    big = spark.range(1).select((phrases._wide(phrases.F.lit(9 * 10**18)) * phrases.F.lit(2_000_000).cast("decimal(7,0)")).alias("top"))
    assert big.select(phrases.F.expr(f"top div cast({9 * 10**18 - 1} as decimal(19,0))")).first()[0] == 2_000_000


def test_a_text_cut_into_chunks_keeps_its_pieces_whole():
    text = "one two three. " * 50 + "x" * 400 + " tail"
    chunks = list(phrases._chunks([text, "last one"], 60))
    assert len(chunks) > 5
    words = [w for c in chunks for w in c]
    assert [w for w in words if w != phrases.CUT] == text.replace(".", " ").encode().split() + [b"last", b"one"]
    assert words.count(phrases.CUT) == 50  # the two texts are in chunks of their own


def test_a_phrase_whose_word_was_not_proposed_before_is_still_to_be_counted():
    """The first filter takes "a b" for a proposal by mistake, so no earlier pass has reached "a b c"."""

    class Given:
        def __init__(self, found):
            self.has = lambda h: phrases.np.isin(h, found)

    words = [b"a", b"b", b"c", b"d"]
    whole = Given(phrases.np.arange(0))
    whole.has = lambda h: phrases.np.ones(len(h), bool)
    levels = {level.n: level for level, _ in phrases.walk("en", words, [whole], None)}
    first = lambda n, *names: levels[n].h[[list(levels[n].texts(phrases.np.arange(len(levels[n].h)))).index(x) for x in names]]
    before = Given(phrases.np.r_[first(1, "b", "c", "d"), first(2, "a b", "b c", "c d"), first(3, "b c d")])
    now = Given(first(1, "a"))
    again = {t for level, at in phrases.walk("en", words, [before, now], 1) for t in level.texts(at)}
    assert again == {"a b", "a b c"}
