"""Personal data by candidate gradient boosting, in DataFrame and SQL functions alone.

Generators propose spans: one for each base kind (email, ip, card, phone), and looser ones
(phones without a plus, emails with a spelled-out sign) that may overlap them.  Base spans
that pass their checks always stay.  All other candidates are judged by boosted trees
(``pyspark.ml``) over features of format (lengths, digits, groups, separators, Luhn) and
context (the words before and after).  The trees learn from all candidates; a candidate counts
as positive there if it lies in a checked base span, with the parts that would give the rule
away (the plus and the country code) cut off.  For the threshold every candidate is scored by
trees that learned from the other half of the documents: it is the least score from which the
precision is ``precision``; without such a score nothing is added.  The trees are written out as SQL expressions, so scoring is
part of the scan's plan.  A span that overlaps a base span is not added.

Positions: a text is split by a generator's pattern, so the lengths of gaps and matches add up
to code points.  The patterns use possessive forms, which match the same (nothing after a
greedy run can take its signs back) without recursion on long runs.

Defined results: null and empty texts have no spans; rows equal in id and text are one document
and all get its result; a text of any length is searched whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import parts_for, stage

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the base patterns.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20-][0-9]{2,5}){2,4}(?!\.?[0-9A-Za-z])",
}
# What a text must hold for a generator to be worth running.
HINT = {
    "email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]",
    "loose phone": r"[0-9)][\x20-][0-9]++[\x20-][0-9]",
}
CONTEXT = r"(?i)\b(?:tel|phone|call|fax|mobile|contact|mail|e-mail|email|reach|write|card|pay|visa|ip|host|server)\b"
# Digits without which a number is no candidate of the trees.
LEAST_DIGITS = 8
# Candidates of a task that grows trees.
TASK_ROWS = 50_000


def digits(span: Column) -> Column:
    return F.regexp_replace(span, r"[^0-9]", "")


def checked(kind: str, span: Column) -> Column:
    """Whether a base span passes the check of its kind."""
    n = F.length(digits(span))
    if kind == "ip":
        part = F.transform(F.split(span, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(part, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        return n.between(16, 19) & F.expr("luhn_check({})".format("regexp_replace(span, '[^0-9]', '')"))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _matches(docs: DataFrame, kind: str, loose: bool) -> DataFrame:
    """``doc_id, text_key, gen, kind, no, gap, span, before, after``: one row for each match."""
    pattern = (LOOSE if loose else BASE)[kind]
    hint = HINT.get(f"loose {kind}" if loose else kind, HINT[kind])
    some = docs.filter(F.col("text").rlike(hint))
    found = some.select(
        "doc_id", "text_key", F.split("text", pattern, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("spans"),
    ).filter("size(spans) > 0")
    parts = F.transform(
        "spans",
        lambda s, i: F.struct(
            i.alias("no"), F.length(F.get("gaps", i)).alias("gap"), s.alias("span"),
            F.right(F.get("gaps", i), F.lit(32)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(16)).alias("after"),
        ),
    )
    gen = ("loose " if loose else "") + kind
    return found.select("doc_id", "text_key", F.lit(gen).alias("gen"), F.lit(kind).alias("kind"), F.inline(parts))


def candidates(docs: DataFrame) -> DataFrame:
    """All spans of all generators with ``start, end`` and whether they are ``base``;
    ``docs`` has ``doc_id, text_key, text``."""
    every = [_matches(docs, k, False) for k in KINDS] + [_matches(docs, k, True) for k in LOOSE]
    rows = every[0]
    for more in every[1:]:
        rows = rows.union(more)
    rows = rows.dropDuplicates(["doc_id", "text_key", "gen", "no"])
    before = Window.partitionBy("doc_id", "text_key", "gen").orderBy("no")
    end = F.sum(F.col("gap") + F.length("span")).over(before)
    passed = F.lit(False)
    for kind in KINDS:
        passed = F.when(F.col("gen") == kind, checked(kind, F.col("span"))).otherwise(passed)
    return rows.withColumn("end", end.cast("long")).select(
        "doc_id", "text_key", "gen", "kind", (F.col("end") - F.length("span")).alias("start"), "end",
        "span", "before", "after", passed.alias("base"),
    ).filter(F.col("base") | (F.length(digits(F.col("span"))) >= LEAST_DIGITS) | (F.col("kind") == "email"))


FEATURES = {
    "email": "int(kind = 'email')", "phone": "int(kind = 'phone')", "ip": "int(kind = 'ip')", "card": "int(kind = 'card')",
    "length": "length(local)", "digits": "length(regexp_replace(local, '[^0-9]', ''))",
    "letters": "length(regexp_replace(local, '[^A-Za-z]', ''))",
    "groups": "size(split(regexp_replace(trim(local), '[^A-Za-z0-9]+', ' '), ' '))",
    "first": "length(regexp_extract(local, '^[^A-Za-z0-9]*([A-Za-z0-9]*)', 1))",
    "last": "length(regexp_extract(local, '([A-Za-z0-9]*)[^A-Za-z0-9]*$', 1))",
    "spaces": "length(local) - length(replace(local, ' ', ''))", "dashes": "length(local) - length(replace(local, '-', ''))",
    "dots": "length(local) - length(replace(local, '.', ''))", "brackets": "int(local rlike '[()]')",
    "luhn": "int(length(regexp_replace(local, '[^0-9]', '')) > 0 and luhn_check(regexp_replace(local, '[^0-9]', '')))",
    "keyword": f"int(before rlike '{CONTEXT.replace(chr(92), chr(92) * 2)}')", "glued": "int(before rlike '[A-Za-z0-9]$' or after rlike '^[A-Za-z0-9]')",
    "numbers": "int(before rlike '[0-9]' or after rlike '[0-9]')",
}


def featured(spans: DataFrame) -> DataFrame:
    """The features; a plus with its country code is no part of them."""
    local = F.when(F.col("kind") == "phone", F.regexp_replace("span", r"^\+[0-9]{1,3}[\x20.-]*", "")).otherwise(F.col("span"))
    return spans.withColumn("local", local).withColumns({f"f_{n}": F.expr(e).cast("double") for n, e in FEATURES.items()}).drop("local")


@dataclass
class Model:
    """Boosted trees as one SQL expression, and the score from which a span is taken."""

    margin: str = "0D"
    threshold: float | None = None

    def score(self) -> Column:
        return 1 / (1 + F.exp(-2 * F.expr(self.margin)))


def _as_sql(node, names: list[str]) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    left, right = _as_sql(node.leftChild(), names), _as_sql(node.rightChild(), names)
    return f"if({names[split.featureIndex()]} <= {split.threshold()!r}D, {left}, {right})"


def _boosted(rows: DataFrame, total: int, trees: int, depth: int) -> str:
    """The margin of trees grown on all ``rows``; Spark itself chooses where a feature may be cut."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    names = [f"f_{n}" for n in FEATURES]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows.coalesce(parts_for(total, TASK_ROWS, 2)))
    found = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, maxBins=32, checkpointInterval=-1).fit(vectors)
    return " + ".join(
        f"{w!r}D * {_as_sql(t._call_java('rootNode'), names)}" for t, w in zip(found.trees, found.treeWeights)
    )


def fit(spans: DataFrame, trees: int = 8, depth: int = 3, precision: float = 0.99) -> Model:
    """Trees from all candidates, and the threshold from the scores that each half of them, by
    document, has from trees of the other half."""
    label = (F.col("base") | F.col("inside")).cast("double")
    rows = stage(
        featured(spans).withColumn("label", label).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
        .select("label", "half", *[f"f_{n}" for n in FEATURES]), "pii",
    )
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "label").count().collect()}  # four rows at most
    total = sum(counts.values())
    if len({label for _, label in counts}) < 2:
        return Model()
    model = Model(_boosted(rows, total, trees, depth))
    if len(counts) < 4:  # a half knows one label only
        return model
    other = [Model(_boosted(rows.filter(F.col("half") != h), total, trees, depth)) for h in (0, 1)]
    score = F.when(F.col("half") == 0, other[0].score()).otherwise(other[1].score())
    bins = (
        rows.groupBy(F.floor(score * 200).alias("bin"))
        .agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy(F.desc("bin")).collect()
    )  # 201 rows at most
    good = seen = 0
    for row in bins:
        good, seen = good + row["good"], seen + row["n"]
        if seen >= 20 and good / seen >= precision:
            model.threshold = row["bin"] / 200
    return model


def marked(spans: DataFrame) -> DataFrame:
    """``spans`` with ``inside``: whether the span overlaps a checked base span of its text."""
    # nearest base spans around each, in one sort: bases that start earlier and end latest,
    # and the first base that starts later
    key = Window.partitionBy("doc_id", "text_key").orderBy("start", "end", "gen")
    base_end = F.when(F.col("base"), F.col("end"))
    base_start = F.when(F.col("base"), F.col("start"))
    earlier = F.max(base_end).over(key.rowsBetween(Window.unboundedPreceding, -1))
    later = F.first(base_start, ignorenulls=True).over(key.rowsBetween(1, Window.unboundedFollowing))
    return spans.withColumn(
        "inside", F.coalesce(earlier > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False))
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, text_key, kind, start, end, base`` of all spans; ``options`` go to ``fit``."""
    text = F.col(text_col).cast("string")
    scan = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    spans = stage(marked(candidates(scan)), "pii")
    model = fit(spans, **options)
    keep = F.col("base")
    if model.threshold is not None:
        keep = keep | (~F.col("inside") & (model.score() >= model.threshold))
    return featured(spans).filter(keep).select("doc_id", "text_key", "kind", "start", "end", "base")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts and lists of spans for every row of ``docs``."""
    order = F.element_at(F.create_map(*[F.lit(x) for k in enumerate(KINDS) for x in k[::-1]]), F.col("kind"))
    entry = F.struct(order.alias("order"), "start", "end", "kind")
    spans = find(docs, id_col, text_col, **options)
    write = lambda c: F.array_join(
        F.transform(F.array_sort(c), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    found = spans.groupBy("doc_id", "text_key").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.collect_set(F.when(F.col("base"), entry)).alias("base"), F.collect_set(entry).alias("all"),
    ).select("doc_id", "text_key", *[f"n_{k}" for k in KINDS], write(F.col("base")).alias("base"), write(F.col("all")).alias("spans"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"))
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_key"] == found["text_key"])
    return rows.join(found, same, "left").select(
        rows["doc_id"], *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
