"""Queries over histories, linked works and the fields of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..operators import fields, history, search_index, works
from ..operators.skew import dealt
from ..session import stage, work_path
from ..streaming.snapshots import append_deltas, current_snapshot, mark_removed, rebaseline, versions
from .registry import query, table

# --- works by linked identifiers -----------------------------------------------------

_VOLUMES_SQL = """
    v AS (
      SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL
             ELSE (o_orderkey // 8) || CASE WHEN o_orderkey % 32 = 1 THEN ', c' || (o_custkey // 2) ELSE ',' END END AS oclc,
        CASE WHEN o_orderkey % 16 = 3 THEN 'Order  of ' || o_custkey ELSE '' END AS title,
        CASE WHEN o_orderkey % 16 = 3 THEN strftime(o_orderdate, '%Y') ELSE ' ' END AS author
      FROM orders),
    k AS (
      SELECT id, link FROM (SELECT id, 'n' || trim(unnest(string_split(oclc, ','))) AS link FROM v) WHERE link <> 'n'
      UNION SELECT id, 't' || title || author FROM v WHERE title <> '')
"""


def _volumes(spark, sf_dir) -> DataFrame:
    """Orders as volumes: numbers shared by neighbours, lists of numbers, titles with authors."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    more = F.when(key % 32 == 1, F.concat(F.lit(", c"), F.floor(customer / 2))).otherwise(",")
    named = key % 16 == 3
    return table(spark, sf_dir, "orders").select(
        key.alias("htid"),
        F.when(key % 7 != 0, F.concat(F.floor(key / 8), more)).alias("oclc_num"),
        F.when(named, F.concat(F.lit("Order  of "), customer)).otherwise("").alias("title"),
        F.when(named, F.date_format("o_orderdate", "yyyy")).otherwise(" ").alias("author"),
    )


@query(
    "WITH RECURSIVE " + _VOLUMES_SQL + """,
    e AS (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b USING (link) WHERE a.id <> b.id),
    r(id, root) AS (SELECT id, id FROM v UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.id WHERE r.root < e.y)
    SELECT id AS htid, min(root) AS work_id FROM r GROUP BY id
    """
)
def works_linked(spark, sf_dir):
    """Every volume with its work: they may meet over any shared number or over title and author."""
    return works.with_work(_volumes(spark, sf_dir)).select("htid", "work_id")


@query(
    "WITH RECURSIVE " + _VOLUMES_SQL + """,
    e AS (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b USING (link) WHERE a.id <> b.id),
    r(id, root) AS (SELECT id, id FROM v UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.id WHERE r.root < e.y),
    w AS (SELECT id, min(root) AS work_id FROM r GROUP BY id)
    SELECT work_id, count(*) AS volumes, min(id) AS first_id FROM w GROUP BY work_id
    """
)
def works_linked_collapse(spark, sf_dir):
    return works.collapse_works(works.with_work(_volumes(spark, sf_dir)), key="work_id")


# --- fields of landed records --------------------------------------------------------


def _records(spark, sf_dir) -> DataFrame:
    """Documents as records whose fields change their kind, nest, or are absent."""
    lang, source, n = F.col("lang"), F.col("source"), F.col("n_chars")
    lit = lambda s: F.lit(s)
    text = lambda c: F.concat(lit('"'), c, lit('"'))
    subjects = (
        F.when(lang == "en", F.to_json(F.array(lang, source))).when(lang == "de", text(lang)).otherwise("null")
    )
    people = F.when(n >= 500, F.concat(
        lit('[{"name":'), text(source), lit(',"born":'), F.when(lang == "fr", text(lit("about 1900"))).otherwise("1900"),
        lit('},{"name":"x"}]'),
    )).otherwise("[]")
    raw = F.concat(
        lit('{"id":'), F.col("doc_id"), lit(',"subjects":'), subjects, lit(',"authors":'), people,
        F.when(lang == "es", lit(',"score":2.5,"file.type":true')).otherwise(""), lit("}"),
    )
    return table(spark, sf_dir, "documents").select(
        F.lit(fixed.LISTING_SOURCE).alias("provider"), (F.floor(F.col("doc_id") / 100) + 1).alias("page"),
        F.when(n < 60, F.substring(raw, 1, 9)).otherwise(raw).alias("raw"),
    )


@query(
    """
    WITH d AS (SELECT lang, n_chars, n_chars < 60 AS broken, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page FROM documents),
    g AS (SELECT lang, n_chars >= 500 AS wide, count(*) AS n FROM d WHERE NOT broken GROUP BY ALL),
    k(path, kind, has) AS (VALUES
      ('$', 'object', 'any'), ('$.id', 'integer', 'any'), ('$.subjects', 'array', 'en'), ('$.subjects[*]', 'string', 'en'),
      ('$.subjects', 'string', 'de'), ('$.subjects', 'null', 'other'), ('$.authors', 'array', 'any'),
      ('$.authors[*]', 'object', 'full'), ('$.authors[*].name', 'string', 'full'), ('$.authors[*].born', 'string', 'full fr'),
      ('$.authors[*].born', 'integer', 'full not fr'), ('$.score', 'number', 'es'), ('$[''file.type'']', 'boolean', 'es')),
    c AS (
      SELECT path, kind, sum(n) AS records FROM k JOIN g ON CASE has WHEN 'any' THEN true WHEN 'full' THEN wide
        WHEN 'full fr' THEN wide AND lang = 'fr' WHEN 'full not fr' THEN wide AND lang <> 'fr'
        WHEN 'other' THEN lang NOT IN ('en', 'de') ELSE lang = has END
      GROUP BY ALL
      UNION ALL SELECT '$', 'broken', count(*) FROM d WHERE broken HAVING count(*) > 0)
    SELECT path, string_agg(kind, ',' ORDER BY kind) AS kinds, (SELECT count(*) FROM d) AS records,
      CAST(sum(records) AS BIGINT) AS present,
      (SELECT max(n) FROM (SELECT count(*) AS n FROM d GROUP BY page)) AS largest_page
    FROM c GROUP BY path
    """
)
def field_inventory(spark, sf_dir):
    """All paths of the records, the kinds of their values and how many records have them.  No record
    has a path in two kinds, so the SQL may add them."""
    return fields.field_inventory(_records(spark, sf_dir))


@query(
    """
    SELECT path, kinds, count(*) OVER () AS paths, present FROM (
      SELECT '$' AS path, 'object' AS kinds, count(*) AS present FROM events
      UNION ALL SELECT '$.k', 'integer', count(*) FROM events WHERE json_extract(props, '$.k') IS NOT NULL)
    WHERE present > 0
    """
)
def field_inventory_merged(spark, sf_dir):
    """Counts of each event type's properties, merged into one inventory of them all."""
    events = table(spark, sf_dir, "events")
    kinds = [r[0] for r in events.select("event_type").distinct().collect()]  # a handful of types
    parts = [fields.field_counts(events.where(F.col("event_type") == k), "props") for k in sorted(kinds)]
    found = fields.inventory(fields.merge_counts(parts)).select("path", "kinds", "present")
    return found.withColumn("paths", found.agg(F.count(F.lit(1))).scalar())


# --- rights over time ----------------------------------------------------------------

_RIGHTS = ("ic", "pd", "und", "pdus")
_CHANGES_SQL = """
    c AS (
      SELECT o_custkey, o_orderdate, CASE WHEN o_orderkey % 11 = 0 THEN NULL
        ELSE ['ic', 'pd', 'und', 'pdus'][1 + CAST(floor(o_totalprice) AS BIGINT) % 4] END AS rights
      FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS place FROM orders)
      WHERE place = 1),
    p AS (
      SELECT *, lag(rights) OVER w AS before, row_number() OVER w AS nth FROM c
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
    h AS (
      SELECT o_custkey, rights, o_orderdate AS since, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS until
      FROM p WHERE nth = 1 OR before IS DISTINCT FROM rights),
    i AS (SELECT * FROM h WHERE rights IS NOT NULL)
"""


def _rights_changes(spark, sf_dir) -> DataFrame:
    """Orders as messages that set the rights of a volume, or remove it."""
    codes = F.array(*map(F.lit, _RIGHTS))
    code = F.get(codes, (F.floor("o_totalprice") % 4).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 11 != 0, code).alias("rights")
    )


def _rights_history(spark, sf_dir) -> DataFrame:
    return history.validity(_rights_changes(spark, sf_dir), "o_custkey", "o_orderdate", "rights", ["o_orderkey"])


@query("WITH " + _CHANGES_SQL + "SELECT o_custkey, rights, since, until FROM i")
def rights_history(spark, sf_dir):
    return _rights_history(spark, sf_dir)


_DATES = ("1996-01-01", "1998-06-01", "2000-03-15")


@query(
    "WITH " + _CHANGES_SQL
    + ", d(first, second) AS (VALUES "
    + ", ".join(f"(TIMESTAMP '{a}', TIMESTAMP '{b}')" for a in _DATES for b in _DATES if a < b)
    + """),
    s AS (SELECT DISTINCT o_custkey FROM orders),
    m AS (
      SELECT first, second, o.rights AS old_value, n.rights AS new_value
      FROM d CROSS JOIN s
      LEFT JOIN i o ON o.o_custkey = s.o_custkey AND o.since <= first AND (o.until IS NULL OR first < o.until)
      LEFT JOIN i n ON n.o_custkey = s.o_custkey AND n.since <= second AND (n.until IS NULL OR second < n.until))
    SELECT CAST(first AS DATE) AS first, CAST(second AS DATE) AS second, old_value, new_value, count(*) AS rows
    FROM m WHERE old_value IS DISTINCT FROM new_value GROUP BY ALL
    """
)
def rights_moves(spark, sf_dir):
    """Moves between any two of three dates, from one history and no snapshot."""
    held = _rights_history(spark, sf_dir)
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    parts = [
        history.moves_between(held, "o_custkey", "rights", day(a), day(b)).select(
            F.lit(a).cast("date").alias("first"), F.lit(b).cast("date").alias("second"), "old_value", "new_value", "rows"
        )
        for a in _DATES for b in _DATES if a < b
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "WITH " + _CHANGES_SQL + """,
    l AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l.o_custkey, rights
    FROM l LEFT JOIN i ON i.o_custkey = l.o_custkey AND since <= l_shipdate AND (until IS NULL OR l_shipdate < until)
    """
)
def rights_as_of(spark, sf_dir):
    """The rights that a volume had when each of its lines was shipped."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    rows = lines.count() + orders.count()
    asked = dealt(lines, ["l_orderkey"], rows).join(dealt(orders, ["l_orderkey"], rows), "l_orderkey")
    return history.value_at(asked, _rights_history(spark, sf_dir), "o_custkey", "l_shipdate", "rights")


# --- snapshot versions ---------------------------------------------------------------

_AS_OF = ("19970101", "19990101", "20000701")
_SNAPSHOT_SQL = """
    r AS (
      SELECT CAST(o_custkey AS VARCHAR) AS htid, strftime(o_orderdate, '%Y%m') || '01' AS file_date,
        o_orderkey % 11 = 0 AS removed, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS stamp,
        ['ic', 'pd', 'und', 'pdus'][1 + CAST(floor(o_totalprice) AS BIGINT) % 4] AS rights
      FROM orders),
    n AS (
      SELECT v, htid, rights, removed, row_number() OVER (
        PARTITION BY v, htid ORDER BY file_date DESC, removed DESC, stamp DESC) AS place
      FROM r JOIN (SELECT unnest([{dates}]) AS v) ON file_date <= v),
    s AS (SELECT v, htid, rights FROM n WHERE place = 1 AND NOT removed)
"""


@query(
    "WITH " + _SNAPSHOT_SQL.replace("{dates}", "'19990101', '20000701', '99999999'")
    + """
    SELECT CASE WHEN v = '99999999' THEN 'now' ELSE 'at ' || v END AS read, htid, rights FROM s
    UNION ALL SELECT 'now, from 19990101', htid, rights FROM s WHERE v = '99999999'
    UNION ALL SELECT 'kept', '19990101 20000701', NULL
    """
)
def snapshot_versions(spark, sf_dir):
    """A snapshot by months of deltas and removals, written as a baseline three times: the two versions
    that are kept, what is current, and the same brought up from the older one."""
    base = work_path(spark, "versions")
    code = F.get(F.array(*map(F.lit, _RIGHTS)), (F.floor("o_totalprice") % 4).cast("int"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("htid"), code.alias("rights"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01")).alias("file_date"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("rights_timestamp"),
        F.lit("daily").alias("file"), (F.col("o_orderkey") % 11 == 0).alias("gone"),
    )
    append_deltas(rows.where("not gone").drop("gone"), base)
    mark_removed(rows.where("gone"), base)
    for version in _AS_OF:
        rebaseline(spark, base, version, keep=2)
    reads = {
        **{f"at {v}": current_snapshot(spark, base, version=v, until=v) for v in _AS_OF[1:]},
        "now": current_snapshot(spark, base), "now, from 19990101": current_snapshot(spark, base, version="19990101"),
    }
    kept = versions(spark, base).agg(F.concat_ws(" ", F.array_sort(F.collect_list("version"))).alias("htid"))
    out = kept.select(F.lit("kept").alias("read"), "htid", F.lit(None).cast("string").alias("rights"))
    for name, rows in reads.items():
        out = out.unionByName(rows.select(F.lit(name).alias("read"), "htid", "rights"))
    return out


# --- search index --------------------------------------------------------------------

_QUERIES = ("Ban", "the", "er", "web", "no such words at all", "")


@query(
    """
    WITH q AS (SELECT unnest([{queries}]) AS asked),
    d AS (SELECT doc_id, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'Renamed banner ' || doc_id
                 ELSE text END AS text, source FROM documents)
    SELECT asked, CAST(doc_id AS VARCHAR) AS uid
    FROM d JOIN q ON contains(lower(concat_ws(' ', coalesce(text, ''), coalesce(source, ''), '', '')), lower(asked))
    WHERE asked <> 'the' OR lang = 'en'
    """.replace("{queries}", ", ".join(f"'{q}'" for q in _QUERIES))
)
def search_by_index(spark, sf_dir):
    """Documents indexed by the run, some of them again under a new text, and the batches merged."""
    base = work_path(spark, "index")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("uid"), F.col("text").alias("title"), F.col("source").alias("authors"),
        F.lit(None).cast("string").alias("subjects"), F.lit(None).cast("string").alias("publisher"), F.col("lang").alias("source"),
    )
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("uid"))
    again = docs.join(good, "uid", "left_semi").withColumn("title", F.concat(F.lit("Renamed banner "), "uid"))
    search_index.add_to_index(docs, base)
    search_index.add_to_index(again, base)
    found = {q: search_index.search_index(spark, base, q, "en" if q == "the" else "all") for q in _QUERIES}
    out = stage(_named(found), "found")
    search_index.merge_index(spark, base)
    merged = {q: search_index.search_index(spark, base, q, "en" if q == "the" else "all") for q in _QUERIES}
    both = out.join(_named(merged), ["asked", "uid"], "full_outer")  # the merge may change nothing
    return both.select("asked", "uid")


def _named(found: dict[str, DataFrame]) -> DataFrame:
    frames = [df.select(F.lit(q).alias("asked"), "uid") for q, df in found.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
