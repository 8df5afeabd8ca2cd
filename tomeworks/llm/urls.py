"""URL filters by dated lists: a temporal list join in DataFrame functions alone.

List entries are dated: an ``add`` makes a pattern active from its date on, a ``remove`` ends
it.  A window over each pattern's entries turns them into validity intervals, and an as-of join
(equal key, fetched within the interval) evaluates every capture against the entries active
when it was fetched.  The keys of a URL are its host, all parent domains, and the host with
every leading part of the path.  Equal captures (URL and date) are evaluated once.

Of the active entries the most specific one decides (the longest pattern; ties go to the greater
pattern, then the greater list name): a capture is blocked unless that entry is on the list
``allow``.

Defined results: a null URL, one without a scheme and host, and a null date match nothing; an
entry without list, pattern or date is passed over; of entries of one pattern and date a
``remove`` counts last, and repeated entries count once; every capture row comes back once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ALLOW = "allow"
# Rows and bytes of intervals that are broadcast at most; longer lists are shuffled.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#@]*@)?([^/:?#]*)", 2))


def keys_of(url: Column) -> Column:
    """Host, parent domains, and host with each leading part of the path."""
    host = host_of(url)
    labels = F.split(host, r"\.", -1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    steps = F.filter(F.split(path, "/", -1), lambda s: s != "")
    count = lambda x: F.when(F.size(x) > 0, F.sequence(F.lit(1), F.size(x))).otherwise(F.array().cast("array<int>"))
    domains = F.transform(count(labels), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(count(steps), lambda i: F.concat_ws("/", host, F.array_join(F.slice(steps, F.lit(1), i), "/")))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until`` (exclusive, null while open) from ``list, pattern, action, dated``."""
    known = entries.select("list", "pattern", "action", "dated").dropna(subset=["list", "pattern", "dated"])
    # of one date the last action alone decides
    last = known.groupBy("list", "pattern", "dated").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "pattern").orderBy("dated")
    return (
        last.withColumn("until", F.lead("dated").over(order))
        .filter("action = 'add'").select("list", "pattern", F.col("dated").alias("since"), "until")
    )


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", date_col: str = "fetched") -> DataFrame:
    """``captures`` with ``blocked, list, pattern, since, n_active`` (in place of columns so named)."""
    active = intervals(entries).withColumnsRenamed({"list": "__list", "pattern": "__key", "since": "__since", "until": "__until"})
    rows, size = active.agg(F.count("*"), F.sum(F.length("__key") + F.length("__list") + 16)).first()
    if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        active = F.broadcast(active)
    url, date = F.col(url_col).cast("string"), F.col(date_col)
    once = captures.select(url.alias("__url"), date.alias("__date")).dropna().distinct()
    asked = once.select("__url", "__date", F.explode(keys_of(F.col("__url"))).alias("__key"))
    found = asked.join(active, "__key").filter("__since <= __date and (__until is null or __date < __until)")
    verdict = found.groupBy("__url", "__date").agg(
        F.count("*").alias("n_active"),
        F.max(F.struct(F.length("__key").alias("n"), F.col("__key").alias("pattern"), F.col("__list").alias("list"), F.col("__since").alias("since"))).alias("__best"),
    )
    same = (url == verdict["__url"]) & (date == verdict["__date"])
    own = [captures[c] for c in captures.columns if c not in ("blocked", "list", "pattern", "since", "n_active")]
    return captures.join(verdict, same, "left").select(
        *own,
        F.coalesce(F.col("__best.list") != ALLOW, F.lit(False)).alias("blocked"),
        F.col("__best.list").alias("list"), F.col("__best.pattern").alias("pattern"), F.col("__best.since").alias("since"),
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
    )
