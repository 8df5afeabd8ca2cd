"""The field inventory against a plain walk of the same records."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from tomeworks.operators import fields


def walk(value, path, found):
    kinds = {bool: "boolean", int: "integer", float: "number", str: "string", dict: "object", list: "array", type(None): "null"}
    found.add((path, kinds[type(value)]))
    found.add((path, None))
    if isinstance(value, dict):
        for key, below in value.items():
            name = f".{key}" if key.replace("_", "a").isalnum() and key.isascii() and not key[0].isdigit() else f"['{key}']"
            walk(below, path + name, found)
    if isinstance(value, list):
        for below in value:
            walk(below, f"{path}[*]", found)


def brute(texts):
    out = Counter()
    for text in texts:
        if text is None:
            continue
        try:
            found = set()
            walk(json.loads(text), "$", found)
        except ValueError:
            found = {("$", "broken"), ("$", None)}
        out.update(found)
    return out


def some(rng, depth):
    pick = rng.randrange(9 if depth else 6)
    if pick < 6:
        return [None, True, 7, 2.5, "text", ""][pick]
    if pick == 6:
        return [some(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", "long_name", "dotted.key", "7", "ü"]): some(rng, depth - 1) for _ in range(rng.randrange(4))}


def counts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    return Counter({(r.path, r.kind): r.records for r in fields.field_counts(df).collect()})


def test_against_a_walk(spark):
    rng = random.Random(11)
    texts = [json.dumps(some(rng, 3)) for _ in range(120)] + [None, "", "{broken", "[1, [2, {\"a\": null}]]"]
    assert counts(spark, texts) == brute(texts)


def test_any_depth(spark):
    deep = "1"
    for n in range(11):
        deep = json.dumps({"d": json.loads(deep)} if n % 2 else [json.loads(deep), "x"])
    texts = [deep, '{"d": 1}', deep]
    assert counts(spark, texts) == brute(texts)


def test_parts_merge_and_make_an_inventory(spark):
    texts = ['{"s": "a", "n": [1, "x", 1]}', '{"s": ["a"], "n": []}', '{"n": 2}', "oops"]
    frames = [spark.createDataFrame([(t,)], "raw string") for t in texts]
    merged = fields.merge_counts([fields.field_counts(f) for f in frames])
    rows = {r.path: (r.kinds, r.records, r.present) for r in fields.inventory(merged).collect()}
    assert rows == {
        "$": ("broken,object", 4, 4), "$.s": ("array,string", 4, 2), "$.s[*]": ("string", 4, 1),
        "$.n": ("array,integer", 4, 3), "$.n[*]": ("integer,string", 4, 1),
    }
    landed = spark.createDataFrame([("p", i // 3, t) for i, t in enumerate(texts)], "provider string, page int, raw string")
    assert {r.largest_page for r in fields.field_inventory(landed).collect()} == {3}
    assert fields.field_inventory(landed.where(F.lit(False))).collect() == []
