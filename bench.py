"""Benchmark: every registered query, and the bulk scan, on the tables of one scale.

Prints one JSON line.  BENCH_SF_DIR names the tables, BENCH_CPUS the cores,
BENCH_ONLY a comma-separated list of queries, BENCH_SCAN_COPIES the size of the bulk
scan (copies of the orders table, written as gzipped volume files).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tomeworks import fixed  # noqa: E402
from tomeworks.operators import catalog, changes, enrich, snapshots  # noqa: E402
from tomeworks.operators.filters import filter_public_domain  # noqa: E402
from tomeworks.operators.normalize import flatten_volumes, is_public_domain  # noqa: E402
from tomeworks.operators.profile import scan_counters  # noqa: E402
from tomeworks.plans.registered import QUERIES, _with_rights, table  # noqa: E402
from tomeworks.session import drop_stages, local_session  # noqa: E402
from tomeworks.sources import read_volumes  # noqa: E402


def seconds(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def run_query(spark, name, sf_dir):
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def land_volumes(spark, sf_dir, copies, files, path) -> int:
    """Orders repeated as volume lines, in ``files`` gzipped files."""
    orders = _with_rights(table(spark, sf_dir, "orders"))
    many = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    key = F.concat_ws(".", "copy", "o_orderkey")
    values = {
        "htid": F.concat(F.lit("ark:/"), key),
        "rights": F.col("rights"),
        "ht_bib_key": F.col("o_custkey").cast("string"),
        "title": F.concat(F.lit("Title of a volume, number "), key),
        "author": F.concat(F.lit("Author "), F.col("o_custkey")),
    }
    line = F.concat_ws("\t", *[values.get(c, F.lit("")) for c in fixed.VOLUME_COLUMNS])
    lines = many.select(line.alias("value")).repartition(files)
    lines.write.option("compression", "gzip").text(path)
    return orders.count() * copies


def replicate(spark, sf_dir, copies, folder):
    """Events and orders ``copies`` times over with keys of their own, written once."""
    many = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    own = lambda c: F.col(c) * copies + F.col("copy")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", many)
    orders = _with_rights(table(spark, sf_dir, "orders")).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "rights", many
    )
    for name, df, keys in (
        ("events", events, ("user_id", "event_id")),
        ("orders", orders, ("o_custkey", "o_orderkey")),
    ):
        shifted = df.withColumns({k: own(k) for k in keys}).drop("copy")
        shifted.repartition(16).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/events"), spark.read.parquet(f"{folder}/orders")


def scaling(spark, sf_dir, copies) -> dict:
    """Seconds of the headline operators on replicated tables."""
    events, orders = replicate(spark, sf_dir, copies, tempfile.mkdtemp(prefix="bench-") + "/copies")
    newest = ["o_orderdate", "o_orderkey"]
    early = F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz")

    def half(condition):
        return catalog.latest_wins(orders.where(condition), ["o_custkey"], newest)

    incoming = orders.select("o_orderkey", F.md5("rights").alias("content_hash"))
    paged = orders.select(
        F.lit("p").alias("provider"),
        F.floor(F.col("o_orderkey") / 100).alias("page"),
        (F.col("rights") != "und").alias("kept"),
        "o_orderkey",
    )
    cap = orders.count() // 3
    plans = {
        "latest_wins": lambda: catalog.latest_wins(events, ["user_id"], ["ts", "event_id"]),
        "change_sequence": lambda: changes.change_sequence(
            events, ["user_id"], ["ts", "event_id"], "event_type"
        ),
        "snapshot_diff": lambda: snapshots.snapshot_diff(half(early), half(~early), ["rights"], "o_custkey"),
        "classify_changes": lambda: changes.classify_changes(
            incoming, incoming.where("content_hash > '8'"), ["o_orderkey"]
        ),
        "budget_topk": lambda: enrich.select_budget(orders, 500, "o_totalprice", ["o_orderkey"]),
        "page_cap": lambda: changes.page_cap(paged, cap),
    }
    out = {"events": events.count(), "orders": orders.count()}
    for name, plan in plans.items():
        out[name] = round(seconds(lambda: plan().write.format("noop").mode("overwrite").save()), 3)
        drop_stages(spark)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    wanted = os.environ.get("BENCH_ONLY")
    names = wanted.split(",") if wanted else list(QUERIES)
    run_query(spark, "value_counts", sf_dir)  # start the session

    timings = {}
    for name in names:
        first = seconds(lambda: run_query(spark, name, sf_dir))
        # Once more when that is cheap: the first run pays for compiling the plan.
        again = seconds(lambda: run_query(spark, name, sf_dir)) if first < 10 else first
        timings[name] = round(min(first, again), 3)
        drop_stages(spark)

    rates, scaled = {}, {}
    if not wanted:
        copies = int(os.environ.get("BENCH_SCAN_COPIES", "20"))
        path = tempfile.mkdtemp(prefix="bench-") + "/volumes"
        rows = land_volumes(spark, sf_dir, copies, int(cpus) if cpus.isdigit() else 8, path)
        scan = lambda: scan_counters(read_volumes(spark, path), is_public_domain(F.col("rights"))).collect()
        flat = lambda: (
            flatten_volumes(filter_public_domain(read_volumes(spark, path)))
            .write.format("noop").mode("overwrite").save()
        )
        for name, action in (("volumes_scan", scan), ("volumes_filter_flatten", flat)):
            timings[name] = round(min(seconds(action), seconds(action)), 3)
            rates[name] = round(rows / timings[name])
        for n in os.environ.get("BENCH_COPIES", "1,10,100").split(","):
            scaled[f"x{n}"] = scaling(spark, sf_dir, int(n))

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_second": rates,
                "replicated": scaled,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
