import hashlib
import re

from pyspark.sql import functions as F

from tomeworks.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c.@d.e", "._%x@y.z_q@r.s 1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (743) 555-3824", "é🙂 x@y.co +49 30 1234567 x", None, "", "1" * 30_000, "a" * 30_000, "a@" + "b." * 20_000 + "c",
    "+1(((((2", "a@b", "x@y.z" * 3, "+1 555 123 4567 +1 555 123 4568", "10.0.0.1, 10.0.0.2", "@.a b c@-.-", "1.2.3.4" * 4,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(n) <= 19 and luhn(n), "phone": 8 <= len(n) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(docs):
    got = {(r.doc_id, r.n_email + r.n_ip + r.n_card + r.n_phone, r.base_sha256): r.spans for r in pii.report(docs).collect()}
    for r in docs.collect():
        want = base(r.text)
        key = (r.doc_id, len(want), hashlib.sha256(",".join(want).encode()).hexdigest())
        assert key in got, r.text[:80]
        assert set(want) <= set(got[key].split(",")) | set()


def test_base_spans(table):
    check(table(list(enumerate(TEXTS)) + [(0, "a@b.c.@d.e"), (None, "n@u.ll")]))
    check(table([]))


def test_odd_rows(odd):
    check(odd)
    assert pii.report(odd).count() == odd.count()


def test_learned_spans(table):
    """A phone that a number behind it hides from the base pattern is found by the trees."""
    rows = []
    for i in range(600):
        number = f"({200 + i}) 555-{4000 + i}"
        rows.append((i, f"call me on +1 {number} after {i % 9} pm"))
        rows.append((1000 + i, f"order {1000 + i}-{i:03d}-{i % 7} of {i} pieces 12 34 56 {i}"))
    rows.append((5000, "call me on +1 (826) 555-4081 190.137.223.204 now"))
    docs = table(rows)
    check(docs)
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert "phone:" in spans[5000]
    assert all(not spans[1000 + i] for i in range(600))


def test_trees_and_threshold_come_from_all_candidates(spark, monkeypatch):
    n = F.col("id").cast("string")
    docs = spark.range(21_000).select(
        F.col("id").alias("doc_id"), F.xxhash64("id").alias("text_key"),
        F.concat_ws(" or ", F.concat(F.lit("call +1 555 "), F.lpad(n, 7, "0")), F.when(F.col("id") % 7 == 0, F.concat(F.lit("555 123 "), F.lpad(n, 5, "0")))).alias("text"),
    )
    spans, learned, grow = pii.marked(pii.candidates(docs)), [], pii._boosted
    monkeypatch.setattr(pii, "_boosted", lambda rows, *more: learned.append(rows.count()) or grow(rows, *more))
    model = pii.fit(spans, trees=1, depth=1)
    whole, *halves = learned
    assert whole == spans.count() > 20_000 and sum(halves) == whole
    assert model.threshold is not None
