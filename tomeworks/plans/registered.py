"""Queries over the test tables, each with the SQL that gives the same rows.

Where a query needs two states of one catalog, they come from the data itself: orders
before and after a day, documents with and without a label.  Every query reads its whole
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from .. import functions as fn
from ..operators import catalog, changes, enrich, filters, neighbours, normalize, profile, search
from ..operators import snapshots, vectors, works
from ..session import stage, work_path
from ..sources import explode_pages, newest_file, parse_volumes
from ..streaming.ingest import append_stream
from . import registered_history, registered_runs  # noqa: F401  (they register their queries)
from .job import RunOptions, ingest
from .registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

# --- latest version, change detection ---------------------------------------------


@query(
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
      FROM events) WHERE place = 1
    """
)
def latest_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    newest = catalog.latest_wins(events, ["user_id"], ["ts", "event_id"])
    return newest.drop("ts")


@query(
    """
    WITH v AS (
      SELECT doc_id, 1 AS run_seq, lang, CAST(NULL AS INTEGER) AS quality FROM documents
      UNION ALL
      SELECT d.doc_id, 2, d.lang, CAST(l.quality AS INTEGER) FROM documents d JOIN labels l USING (doc_id))
    SELECT doc_id, run_seq, lang, quality FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY run_seq DESC) AS place FROM v)
    WHERE place = 1
    """
)
def latest_wins_two_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int"))
    first = docs.withColumn("run_seq", F.lit(1))
    second = docs.join(labels, "doc_id").withColumn("run_seq", F.lit(2))
    both = first.unionByName(second, allowMissingColumns=True)
    return catalog.latest_wins(both, ["doc_id"], ["run_seq"]).select(
        "doc_id", "run_seq", "lang", "quality"
    )


@query(
    """
    SELECT event_id, user_id,
           CASE WHEN lag(event_id) OVER w IS NULL THEN 'new'
                WHEN lag(event_type) OVER w = event_type THEN 'unchanged'
                ELSE 'changed' END AS status
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """
)
def change_sequence(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    sequence = changes.change_sequence(events, ["user_id"], ["ts", "event_id"], "event_type")
    return sequence.select("event_id", "user_id", "status")


@query(
    """
    SELECT d.doc_id,
           CASE WHEN l.doc_id IS NULL THEN 'new'
                WHEN sha256(concat_ws(chr(31), d.lang, d.source))
                   = sha256(concat_ws(chr(31), CASE WHEN l.quality = 1 THEN d.lang ELSE 'und' END, d.source))
                THEN 'unchanged' ELSE 'changed' END AS status
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """
)
def classify_changes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    incoming = docs.select("doc_id", fn.text_hash(F.col("lang"), F.col("source")).alias("content_hash"))
    before = F.when(F.col("quality") == 1, F.col("lang")).otherwise("und")
    previous = docs.join(labels, "doc_id").select(
        "doc_id", fn.text_hash(before, F.col("source")).alias("content_hash")
    )
    return changes.classify_changes(incoming, previous, ["doc_id"]).select("doc_id", "status")


@query(
    """
    SELECT doc_id, sha256(concat_ws(chr(31), coalesce(text, chr(0)), coalesce(lang, chr(0)),
                                    coalesce(source, chr(0)))) AS content_hash
    FROM documents
    """
)
def content_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    parts = [F.col(c) for c in ("text", "lang", "source")]
    return docs.select("doc_id", fn.text_hash(*parts).alias("content_hash"))


@query(
    """
    SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS new_records,
           count(*) FILTER (WHERE l.quality <> 1) AS changed_records,
           count(*) FILTER (WHERE l.quality = 1) AS unchanged_records
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """
)
def run_counters(spark, sf_dir):
    return profile.status_counts(classify_changes(spark, sf_dir))


@query(
    """
    SELECT source AS provider, count(*) AS total_records, max(doc_id) AS max_id_seen
    FROM documents GROUP BY 1
    """
)
def catalog_state(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("provider"), F.col("doc_id").cast("string").alias("source_id")
    )
    return catalog.catalog_state(docs)


# --- caps and budgets --------------------------------------------------------------


def _paged(spark, sf_dir) -> DataFrame:
    """Documents as a listing of pages of 100 in which long documents count as kept."""
    return table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("provider"),
        "doc_id",
        (F.floor(F.col("doc_id") / 100) + 1).alias("page"),
        (F.col("n_chars") >= 500).alias("kept"),
    )


_PAGES_SQL = """
    WITH d AS (SELECT doc_id, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page, n_chars >= 500 AS kept
               FROM documents),
         p AS (SELECT page, count(*) FILTER (WHERE kept) AS n FROM d GROUP BY page),
         r AS (SELECT page, sum(n) OVER (ORDER BY page) AS reach FROM p)
"""


@query(
    _PAGES_SQL
    + """
    , c AS (SELECT min(page) AS cut FROM r WHERE reach >= (SELECT count(*) * 2 // 5 FROM documents))
    SELECT doc_id, page FROM d, c WHERE kept AND (cut IS NULL OR page <= cut)
    """
)
def page_cap(spark, sf_dir):
    rows = _paged(spark, sf_dir)
    capped = changes.page_cap(rows, rows.count() * 2 // 5)
    return capped.where("kept").select("doc_id", "page")


@query(
    _PAGES_SQL
    + """
    , c AS (SELECT min(page) AS cut FROM r WHERE reach >= 10)
    SELECT o.overshoot, count(*) AS kept_rows
    FROM d, c, (VALUES (false, 0), (true, 1)) o(overshoot, extra)
    WHERE kept AND (cut IS NULL OR page <= cut + CASE WHEN cut = 1 THEN extra ELSE 0 END)
    GROUP BY 1
    """
)
def page_cap_resume(spark, sf_dir):
    """A run resuming on page 1 with a cap of 10, with and without the extra page."""
    rows = _paged(spark, sf_dir)
    parts = [
        changes.page_cap(rows, 10, resumed_page=1, match_resume_overshoot=over)
        .where("kept")
        .agg(F.count(F.lit(1)).alias("kept_rows"))
        .select(F.lit(over).alias("overshoot"), "kept_rows")
        for over in (False, True)
    ]
    return parts[0].unionByName(parts[1])


@query(
    """
    SELECT doc_id, n_chars FROM (
      SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place
      FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
    WHERE place <= (SELECT greatest(0, least(500, 1000 - (floor(max(doc_id) / 100) + 1))) FROM documents)
    """
)
def budget_topk(spark, sf_dir):
    """Documents without a label, longest first, as many as the budget leaves after one
    request for each page of 100."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    pages = docs.agg(F.floor(F.max("doc_id") / 100) + 1).first()[0]
    wanting = enrich.pending(docs, table(spark, sf_dir, "labels"), ["doc_id"])
    return enrich.select_budget(wanting, max(0, min(500, 1000 - pages)), "n_chars", ["doc_id"])


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500
    """
)
def topk_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return enrich.select_budget(orders, 500, "o_totalprice", ["o_orderkey"])


@query(
    """
    SELECT lang, doc_id, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place FROM documents)
    WHERE place <= 10
    """
)
def topk_per_lang(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return enrich.select_budget(docs, 10, "n_chars", ["doc_id"], ["lang"])


@query(
    """
    SELECT o_orderstatus, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place
      FROM orders) WHERE place <= (SELECT count(*) // 6 FROM orders)
    """
)
def budget_per_status(spark, sf_dir):
    """A budget that grows with the table: about half of each status."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return enrich.select_budget(
        orders, orders.count() // 6, "o_totalprice", ["o_orderkey"], ["o_orderstatus"]
    )


# --- text --------------------------------------------------------------------------

_WS = fixed.WHITE_SPACE


@query(
    f"""
    WITH p AS (SELECT page_id, nullif(substring(trim(html, '{_WS}'), 1, 4000), '') AS preview FROM pages)
    SELECT d.doc_id, CASE WHEN preview IS NULL THEN 'none' ELSE 'first_chars' END AS text_source,
           CAST(coalesce(length(preview), 0) AS INTEGER) AS text_char_count, sha256(preview) AS text_hash
    FROM documents d LEFT JOIN p ON p.page_id = d.doc_id
    """
)
def enrich_left(spark, sf_dir):
    """Documents taken as records without text; pages are the texts found for them."""
    targets = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit(None).cast("string").alias("searchable_text"),
        F.lit("none").alias("text_source"),
        F.lit(0).alias("text_char_count"),
    )
    texts = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("text")
    )
    previews = enrich.fetch_previews(targets, texts, 4000, ["doc_id"])
    done = enrich.attach_text(targets, previews, ["doc_id"])
    return done.select(
        "doc_id",
        "text_source",
        "text_char_count",
        F.sha2("searchable_text", 256).alias("text_hash"),
    )


@query(
    """
    SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """
)
def pending_anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return enrich.pending(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    """
    SELECT d.doc_id,
           CASE WHEN b.text <> '' THEN 'summary' WHEN p.url <> '' THEN 'description'
                WHEN substring(d.text, 1, 200) <> '' THEN 'first_chars' ELSE 'none' END AS text_source,
           sha256(coalesce(nullif(b.text, ''), nullif(p.url, ''), nullif(substring(d.text, 1, 200), '')))
             AS text_hash
    FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id
    """
)
def text_ladder(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    benchmark = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.col("text").alias("summary")
    )
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    opening = docs.select("doc_id", fn.first_chars(F.col("text"), 200).alias("opening"))
    joined = opening.join(benchmark, "doc_id", "left").join(pages, "doc_id", "left")
    rungs = (F.col("summary"), F.col("url"), F.lit(None).cast("string"), F.col("opening"))
    return joined.select(
        "doc_id",
        fn.text_ladder_origin(*rungs).alias("text_source"),
        F.sha2(fn.text_ladder(*rungs), 256).alias("text_hash"),
    )


@query(
    """
    SELECT CASE text_source WHEN 'summary' THEN 0 WHEN 'description' THEN 1 WHEN 'intro' THEN 2
                            WHEN 'first_chars' THEN 3 ELSE 4 END AS text_rank, count(*) AS rows
    FROM (SELECT CASE WHEN b.text <> '' THEN 'summary' WHEN p.url <> '' THEN 'description'
                      WHEN substring(d.text, 1, 200) <> '' THEN 'first_chars' ELSE 'none' END AS text_source
          FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id
                           LEFT JOIN pages p ON p.page_id = d.doc_id)
    GROUP BY 1
    """
)
def text_quality(spark, sf_dir):
    return profile.counts(filters.text_quality(text_ladder(spark, sf_dir)), "text_rank")


_MARK = "*** START OF THIS PROJECT GUTENBERG EBOOK A\nTITLE ***"


@query(
    f"""
    WITH x AS (
      SELECT doc_id, CASE lang WHEN 'en' THEN concat('Licence lines\n\n', '{_MARK}', '\n\n', text)
                               WHEN 'fr' THEN concat(lower('{_MARK}'), text) ELSE text END AS full_text
      FROM documents),
    y AS (
      SELECT doc_id, trim(concat(
        regexp_replace(substring(full_text, 1, 20000), '^.*?{fixed.FRONT_MATTER_MARKER}', '', 'is'),
        substring(full_text, 20001)), '{_WS}') AS body FROM x)
    SELECT doc_id, sha256(body) AS body_hash, CAST(length(body) AS INTEGER) AS body_chars,
           CAST(length(nullif(substring(body, 1, 4000), '')) AS INTEGER) AS preview_chars
    FROM y
    """
)
def marker_strip(spark, sf_dir):
    """Front matter put before the text of two languages and taken off again."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    full = (
        F.when(F.col("lang") == "en", F.concat(F.lit(f"Licence lines\n\n{_MARK}\n\n"), text))
        .when(F.col("lang") == "fr", F.concat(F.lit(_MARK.lower()), text))
        .otherwise(text)
    )
    body = docs.select("doc_id", full.alias("full_text")).select(
        "doc_id",
        fn.strip_space(fn.after_front_matter(F.col("full_text"))).alias("body"),
        fn.preview(F.col("full_text")).alias("preview"),
    )
    return body.select(
        "doc_id",
        F.sha2("body", 256).alias("body_hash"),
        F.length("body").alias("body_chars"),
        F.length("preview").alias("preview_chars"),
    )


@query(
    f"""
    WITH x AS (SELECT doc_id, CASE lang WHEN 'en' THEN concat('*** START OF THE PROJECT GUTENBERG EBOOK ***  ', text)
                                       ELSE text END AS t FROM documents),
    y AS (SELECT doc_id, CASE WHEN regexp_matches(substring(t, 1, 20000), '{fixed.FRONT_MATTER_MARKER}', 'is')
                              THEN ltrim(concat(
        regexp_replace(substring(t, 1, 20000), '^.*?{fixed.FRONT_MATTER_MARKER}', '', 'is'),
        substring(t, 20001)), '{_WS}') ELSE t END AS b FROM x)
    SELECT doc_id, CAST(length(b) AS INTEGER) AS total, CAST(least(length(b), 40000) AS INTEGER) AS shown, sha256(substring(b, 1, 40000)) AS text_hash
    FROM y
    """
)
def display_text(spark, sf_dir):
    """Full text as a reader shows it: behind the front matter, with total and shown size."""
    docs = table(spark, sf_dir, "documents")
    head = F.lit("*** START OF THE PROJECT GUTENBERG EBOOK ***  ")
    full = F.when(F.col("lang") == "en", F.concat(head, F.col("text"))).otherwise(F.col("text"))
    return enrich.display_text(docs.select("doc_id", full.alias("text"))).select(
        "doc_id", "total", "shown", F.sha2("text", 256).alias("text_hash")
    )


@query(
    """
    SELECT doc_id, substring(text, 1, 100) AS opening, CAST(length(text) AS INTEGER) AS char_count FROM documents
    """
)
def truncate_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        fn.first_chars(F.col("text"), 100).alias("opening"),
        F.length("text").alias("char_count"),
    )


@query(
    f"""
    SELECT conv_id, turn, sha256(trim(concat(chr(160), chr(28), ' ', text, chr(8195), chr(10)), '{_WS}')) AS text_hash
    FROM conversations
    """
)
def strip_space(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    padded = F.concat(F.lit("\xa0\x1c "), F.col("text"), F.lit(" \n"))
    return turns.select("conv_id", "turn", F.sha2(fn.strip_space(padded), 256).alias("text_hash"))


# --- scalar parsing ----------------------------------------------------------------


@query(
    r"""
    SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '-?\d+(?:\.\d+)?'), '') AS DOUBLE) AS number
    FROM events
    """
)
def first_number(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", fn.first_number(F.col("props")).alias("number"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", fn.json_int(F.col("props"), "$.k").alias("k"))


@query(
    """
    WITH o AS (SELECT o_orderkey, o_orderpriority AS p, o_orderdate AS d FROM orders)
    SELECT o_orderkey,
           CASE WHEN p = '5-LOW' THEN NULL
                WHEN p = '4-NOT SPECIFIED' THEN epoch_us(d) + 34200000000
                WHEN p = '2-HIGH' THEN epoch_us(d) + 45296500000
                ELSE epoch_us(d) END AS issued_us,
           CASE WHEN p = '5-LOW' THEN 'circa ' || strftime(d, '%Y')
                WHEN p = '3-MEDIUM' THEN strftime(d, '%Y%m%d') ELSE strftime(d, '%Y-%m-%d') END AS day
    FROM o
    """
)
def issued_parse(spark, sf_dir):
    """Dates in four accepted shapes and one that is none."""
    orders = table(spark, sf_dir, "orders")
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:34:56.5Z")))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyyMMdd"))
        .when(
            priority == "4-NOT SPECIFIED",
            F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 11:30+0200")),
        )
        .otherwise(F.concat(F.lit("circa "), F.date_format(day, "yyyy")))
    )
    return orders.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey",
        F.unix_micros(fn.issued_timestamp(F.col("raw"))).alias("issued_us"),
        fn.iso_date(F.col("raw")).alias("day"),
    )


@query(
    """
    SELECT p_partkey, regexp_replace(trim(p_name), ' +', '; ', 'g') AS tags,
           CAST(len(string_split(regexp_replace(trim(p_name), ' +', '; ', 'g'), '; ')) AS INTEGER) AS n_tags
    FROM part
    """
)
def tags(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    joined = part.select("p_partkey", fn.join_tags(F.split("p_name", " ")).alias("joined"))
    back = fn.split_tags(F.col("joined"))
    return joined.select("p_partkey", fn.join_tags(back).alias("tags"), F.size(back).alias("n_tags"))


@query("SELECT page_id, replace(url_encode(url), '%2F', '/') AS quoted FROM pages")
def path_quote(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", fn.path_quote(F.col("url")).alias("quoted"))


# --- rights, counts, shares --------------------------------------------------------

_RIGHTS = {"1-URGENT": "pd", "2-HIGH": "pdus", "3-MEDIUM": "pd-pvt", "4-NOT SPECIFIED": "ic"}
_RIGHTS_SQL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _RIGHTS.items())
    + " ELSE 'und' END"
)


def _with_rights(orders: DataFrame) -> DataFrame:
    rights = F.lit("und")
    for priority, code in _RIGHTS.items():
        rights = F.when(F.col("o_orderpriority") == priority, code).otherwise(rights)
    return orders.withColumn("rights", rights)


@query(
    f"""
    SELECT o_orderkey, {_RIGHTS_SQL} AS rights FROM orders
    WHERE {_RIGHTS_SQL} IN ('pd', 'pdus', 'pd-pvt')
    """
)
def rights_filter(spark, sf_dir):
    orders = _with_rights(table(spark, sf_dir, "orders")).select("o_orderkey", "rights")
    return filters.filter_public_domain(orders)


@query(
    f"""
    SELECT {_RIGHTS_SQL} IN ('pd', 'pdus', 'pd-pvt') AS is_public_domain, count(*) AS rows
    FROM orders GROUP BY 1
    """
)
def rights_flag(spark, sf_dir):
    orders = _with_rights(table(spark, sf_dir, "orders"))
    flagged = orders.select(normalize.is_public_domain(F.col("rights")).alias("is_public_domain"))
    return profile.counts(flagged, "is_public_domain")


@query(
    f"""
    SELECT count(*) AS scanned, count(*) FILTER (WHERE {_RIGHTS_SQL} IN ('pd', 'pdus', 'pd-pvt')) AS matched
    FROM orders
    """
)
def scan_counters(spark, sf_dir):
    orders = _with_rights(table(spark, sf_dir, "orders"))
    return profile.scan_counters(orders, normalize.is_public_domain(F.col("rights")))


@query("SELECT lang, count(*) AS rows FROM documents GROUP BY 1")
def value_counts(spark, sf_dir):
    return profile.counts(table(spark, sf_dir, "documents"), "lang")


@query(
    """
    SELECT lang, count(*) AS rows, grouping(lang) = 1 AS is_total FROM documents GROUP BY ROLLUP (lang)
    """
)
def rollup_counts(spark, sf_dir):
    return profile.counts(table(spark, sf_dir, "documents"), "lang", total=True)


@query(
    f"""
    SELECT rights, rows, CAST(rows * 10000 // sum(rows) OVER () AS BIGINT) AS basis_points
    FROM (SELECT {_RIGHTS_SQL} AS rights, count(*) AS rows FROM orders GROUP BY 1)
    """
)
def rights_share(spark, sf_dir):
    return profile.shares(_with_rights(table(spark, sf_dir, "orders")), "rights")


# --- snapshots: orders before and from a day on, newest per customer ----------------

_DAY = "1998-06-01"
_SNAPSHOTS_SQL = f"""
    WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, {_RIGHTS_SQL} AS rights FROM orders),
         old AS (SELECT o_custkey, rights FROM (SELECT *, row_number() OVER
                  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
                  FROM o WHERE o_orderdate < TIMESTAMP '{_DAY}') WHERE place = 1),
         new AS (SELECT o_custkey, rights FROM (SELECT *, row_number() OVER
                  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
                  FROM o WHERE o_orderdate >= TIMESTAMP '{_DAY}') WHERE place = 1)
"""


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = _with_rights(table(spark, sf_dir, "orders")).select(
        "o_custkey", "o_orderkey", "o_orderdate", "rights"
    )
    before = F.col("o_orderdate") < F.lit(_DAY).cast("timestamp_ntz")
    newest = ("o_orderdate", "o_orderkey")
    return (
        catalog.latest_wins(orders.where(before), ["o_custkey"], newest),
        catalog.latest_wins(orders.where(~before), ["o_custkey"], newest),
    )


@query(
    _SNAPSHOTS_SQL
    + """
    SELECT o_custkey,
           CASE WHEN old.rights IS NULL THEN 'added' WHEN new.rights IS NULL THEN 'removed'
                WHEN old.rights = new.rights THEN 'same' ELSE 'changed' END AS status,
           old.rights AS old_rights, new.rights AS new_rights
    FROM old FULL JOIN new USING (o_custkey)
    """
)
def snapshot_diff(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshots.snapshot_diff(old, new, ["rights"], "o_custkey")


@query(_SNAPSHOTS_SQL + "SELECT o_custkey FROM old ANTI JOIN new USING (o_custkey)")
def coverage_anti(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshots.missing_ids(old, new, "o_custkey")


@query(
    _SNAPSHOTS_SQL
    + """
    , k AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM old WHERE old.o_custkey = new.o_custkey)
                        THEN 'modified' ELSE 'new' END AS kind FROM new),
      n AS (SELECT kind, count(*) AS rows FROM k GROUP BY 1)
    SELECT kind, CAST(rows AS BIGINT) AS rows, CAST(rows * 10000 // sum(rows) OVER () AS BIGINT) AS basis_points
    FROM n
    """
)
def delta_share(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshots.delta_share(old, new, "o_custkey")


_MOVES_SQL = """
    , moves AS (SELECT old.rights AS old_value, new.rights AS new_value, count(*) AS rows
                FROM old JOIN new USING (o_custkey) WHERE old.rights <> new.rights GROUP BY 1, 2)
"""


@query(_SNAPSHOTS_SQL + _MOVES_SQL + "SELECT old_value, new_value, rows FROM moves")
def transitions(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshots.transitions(old, new, "rights", "o_custkey")


@query(
    _SNAPSHOTS_SQL
    + _MOVES_SQL
    + """
    SELECT CASE WHEN old_value IN ('pd', 'pdus', 'pd-pvt') = new_value IN ('pd', 'pdus', 'pd-pvt') THEN 'neither'
                WHEN new_value IN ('pd', 'pdus', 'pd-pvt') THEN 'entering' ELSE 'leaving' END AS flow,
           CAST(sum(rows) AS BIGINT) AS rows
    FROM moves GROUP BY 1
    """
)
def public_domain_flow(spark, sf_dir):
    return snapshots.public_domain_flow(transitions(spark, sf_dir))


@query(
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
      FROM events) WHERE place = 1
    """
)
def apply_deltas(spark, sf_dir):
    """State of all users by mid-month, then brought up to date with the later events."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    newest = ("ts", "event_id")
    snapshot = catalog.latest_wins(events.where(early), ["user_id"], newest)
    current = snapshots.apply_deltas(snapshot, events.where(~early), newest, "user_id")
    return current.select("user_id", "event_id", "event_type")


@query(
    """
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS after FROM orders),
         s AS (SELECT after, lag(after) OVER (ORDER BY after) AS before FROM d)
    SELECT CAST(before AS VARCHAR) AS before, CAST(after AS VARCHAR) AS after,
           CAST(after - before - 1 AS INTEGER) AS missing_days
    FROM s WHERE after - before > 1
    """
)
def gap_check(spark, sf_dir):
    gaps = snapshots.delta_gaps(table(spark, sf_dir, "orders"), "o_orderdate")
    return gaps.select(
        F.col("before").cast("string"), F.col("after").cast("string"), "missing_days"
    )


@query(
    """
    SELECT filename, "full", created FROM (
      SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS filename, o_orderstatus = 'F' AS "full",
             strftime(o_orderdate, '%Y-%m-%d') AS created,
             row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey) AS place
      FROM orders) WHERE place = 1
    """
)
def newest_files(spark, sf_dir):
    index = table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("filename"),
        (F.col("o_orderstatus") == "F").alias("full"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"),
    )
    return newest_file(index, True).unionByName(newest_file(index, False))


# --- works -------------------------------------------------------------------------

_WORK_SQL = f"""
    WITH w AS (SELECT doc_id, md5(concat_ws(chr(31),
                 lower(trim(regexp_replace(text, '[{_WS}]+', ' ', 'g'))), lower(lang))) AS work_key
               FROM documents)
"""


def _works(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = works.work_key(F.lit(None).cast("string"), F.col("text"), F.col("lang"))
    return docs.select("doc_id", key.alias("work_key"))


@query(
    _WORK_SQL
    + "SELECT work_key, count(*) AS volumes, min(doc_id) AS first_id FROM w GROUP BY work_key"
)
def works_collapse(spark, sf_dir):
    return works.collapse_works(_works(spark, sf_dir), "doc_id")


@query(
    _WORK_SQL
    + """
    SELECT doc_id FROM w WHERE doc_id NOT IN (SELECT doc_id FROM labels)
      AND work_key NOT IN (SELECT work_key FROM w JOIN labels USING (doc_id))
    """
)
def known_work_filter(spark, sf_dir):
    """Unlabelled documents that are no copy of a labelled one.

    The keys are staged: texts are read and hashed once, and everything behind reads a
    narrow table.
    """
    keyed = stage(_works(spark, sf_dir), "work-keys")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    known = keyed.join(labels, "doc_id", "left_semi")
    candidates = keyed.join(labels, "doc_id", "left_anti")
    return works.drop_known(candidates, known, "work_key", ["doc_id"]).select("doc_id")


# --- vectors -----------------------------------------------------------------------


@query(
    """
    SELECT d.doc_id, d.lang, e.label, CAST(len(e.embedding) AS INTEGER) AS dims
    FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id
    """
)
def embedding_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    stored = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    joined = search.join_vectors(docs, stored, "doc_id")
    return joined.select("doc_id", "lang", "label", F.size("embedding").alias("dims"))


@query(
    """
    WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i
               FROM embeddings),
         m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY 1, 2),
         q AS (SELECT label, list(v ORDER BY i) AS centre FROM m GROUP BY 1),
         s AS (SELECT q.label, vec_id, list_cosine_similarity(q.centre, CAST(embedding AS DOUBLE[])) AS score
               FROM q, embeddings)
    SELECT label, vec_id, place FROM (
      SELECT label, vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS place
      FROM s) WHERE place <= 3
    """
)
def vector_topk(spark, sf_dir):
    """The three vectors nearest to the centre of each label."""
    stored = table(spark, sf_dir, "embeddings")
    centres = (
        stored.select("label", F.posexplode("embedding").alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("parts"))
        .select("label", F.col("parts.v").alias("embedding"))
    )
    return vectors.nearest(stored, centres, 3, query_column="label")


@query(
    """
    SELECT query_id, vec_id, place FROM (
      SELECT q.vec_id AS query_id, v.vec_id, CAST(row_number() OVER (
        PARTITION BY q.vec_id
        ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 12) DESC, v.vec_id
      ) AS INTEGER) AS place
      FROM embeddings q, embeddings v) WHERE place <= 4
    """
)
def vector_neighbours(spark, sf_dir):
    """The four vectors nearest to every vector, itself among them."""
    stored = table(spark, sf_dir, "embeddings")
    return neighbours.neighbours(stored, stored.select(F.col("vec_id").alias("query_id"), "embedding"), 4)


# --- merged sources, search, profiles ----------------------------------------------


def _flat_documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "source", F.col("doc_id").cast("string").alias("id"), "lang", "n_chars"
    )


@query(
    """
    SELECT source, CAST(doc_id AS VARCHAR) AS id, lang, n_chars, CAST(NULL AS VARCHAR) AS url,
           source || ':' || doc_id AS uid FROM documents
    UNION ALL
    SELECT 'pages', CAST(page_id AS VARCHAR), NULL, NULL, url, 'pages:' || page_id FROM pages
    """
)
def union_sources(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").cast("string").alias("id"), "url"
    )
    return search.union_sources([_flat_documents(spark, sf_dir), pages])


@query(
    """
    SELECT source || ':' || doc_id AS uid, lang, n_chars FROM documents
    WHERE source || ':' || doc_id = (SELECT min(source || ':' || doc_id) FROM documents)
    """
)
def detail_lookup(spark, sf_dir):
    merged = search.union_sources([_flat_documents(spark, sf_dir)])
    first = merged.agg(F.min("uid")).first()[0]
    return search.lookup(merged, first).select("uid", "lang", "n_chars")


@query(
    """
    SELECT doc_id FROM documents
    WHERE contains(lower(concat_ws(' ', coalesce(text, ''), coalesce(source, ''), '', coalesce(lang, ''))), 'the')
      AND lang = 'en'
    """
)
def search_catalog(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("title"),
        F.col("source").alias("authors"),
        F.lit(None).cast("string").alias("subjects"),
        F.col("lang").alias("publisher"),
        F.col("lang").alias("source"),
    )
    return search.search(docs, "The", "en").select("doc_id")


@query(
    """
    SELECT page_id, CASE WHEN lower(url) LIKE '%.org%' THEN CAST(length(html) AS VARCHAR) ELSE '1999' END AS info
    FROM pages
    """
)
def display_info(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.contains(F.lower("url"), F.lit(".org")), fixed.LISTING_SOURCE)
        .otherwise(fixed.VOLUME_SOURCE)
        .alias("source"),
        F.length("html").alias("download_count"),
        F.lit("1999").alias("publication_year"),
    )
    return normalize.display_info(pages).select("page_id", "info")


@query(
    """
    WITH j AS (SELECT d.doc_id, d.text, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
         c AS (SELECT count(*) AS rows, count(doc_id) AS a, count(text) AS b, count(lang) AS c, count(quality) AS d FROM j)
    SELECT field, rows, present, CAST(present * 10000 // rows AS BIGINT) AS basis_points FROM (
      SELECT 'doc_id' AS field, rows, a AS present FROM c UNION ALL SELECT 'text', rows, b FROM c
      UNION ALL SELECT 'lang', rows, c FROM c UNION ALL SELECT 'quality', rows, d FROM c)
    """
)
def coverage_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return profile.coverage(docs.join(labels, "doc_id", "left"), ["doc_id", "text", "lang", "quality"])


@query(
    """
    SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderdate < before) AS out_of_order
    FROM (SELECT o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)
    """
)
def sortedness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return profile.out_of_order(orders, ["o_custkey"], ["o_orderkey"], F.col("o_orderdate"))


@query("SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "lineitem"))


# --- landed records ----------------------------------------------------------------


def _landed(spark, sf_dir) -> DataFrame:
    """Documents as raw listing records, in the varied shapes a listing uses."""
    text, lang = F.col("text"), F.col("lang")
    english = lang == "en"
    record = F.struct(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Title "), F.col("doc_id")).alias("title"),
        F.array(F.struct(F.col("source").alias("name"), F.col("doc_id").alias("id"))).alias("authors"),
        F.when(F.col("n_chars") >= 500, text).alias("summary"),
        F.col("n_chars").alias("download_count"),
        F.concat(F.lit("Reading ease score: "), F.col("n_chars"), F.lit(".5 (est.)")).alias(
            "reading_ease_score"
        ),
        F.when(english, F.lit("1998-06-01")).otherwise("June").alias("issued"),
        F.when(lang == "de", "claimed").alias("removed_from_catalog"),
    )
    # Subjects are a list in one language and a bare string in the others.
    subjects = F.when(
        english, F.to_json(F.array(lang, F.lit(""), F.col("source")))
    ).otherwise(F.concat(F.lit('"'), lang, F.lit('"')))
    cleaned = F.concat(F.lit('{"subjects":'), subjects, F.lit(","), F.ltrim(F.to_json(record), F.lit("{")))
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.lit(fixed.LISTING_SOURCE).alias("provider"),
        (F.floor(F.col("doc_id") / 100) + 1).alias("page"),
        F.col("doc_id").alias("pos"),
        cleaned.alias("raw"),
    )


@query(
    f"""
    SELECT 'gutenberg:' || doc_id AS book_uid, 'Title ' || doc_id AS title, source AS author,
           CAST(doc_id AS VARCHAR) AS author_id,
           CASE WHEN lang = 'en' THEN lang || '; ' || source ELSE lang END AS subjects,
           '{fixed.LISTING_PAGE_URL}' || doc_id || '{fixed.LISTING_TEXT_SUFFIX}' AS download_url,
           sha256(CASE WHEN n_chars >= 500 THEN nullif(substring(trim(text, '{_WS}'), 1, 4000), '') END) AS text_hash,
           CAST(coalesce(length(CASE WHEN n_chars >= 500 THEN substring(trim(text, '{_WS}'), 1, 4000) END), 0) AS INTEGER)
             AS text_char_count,
           CASE WHEN n_chars >= 500 AND trim(text, '{_WS}') <> '' THEN 'summary' ELSE 'none' END AS text_source,
           n_chars AS download_count, CAST(n_chars || '.5' AS DOUBLE) AS reading_ease_score,
           CASE WHEN lang = 'en' THEN 896659200000000 END AS issued_us,
           CASE WHEN lang = 'de' THEN 'claimed' END AS withdrawn_reason
    FROM documents
    """
)
def listing_records(spark, sf_dir):
    from datetime import datetime, timezone

    records = normalize.normalize_listing(
        _landed(spark, sf_dir), datetime(2024, 1, 1, tzinfo=timezone.utc)
    )
    good, _ = normalize.split_valid(records)
    return good.select(
        "book_uid",
        "title",
        F.col("authors")[0]["name"].alias("author"),
        F.col("authors")[0]["source_author_id"].alias("author_id"),
        fn.join_tags(F.col("subjects")).alias("subjects"),
        "download_url",
        F.sha2("searchable_text", 256).alias("text_hash"),
        "text_char_count",
        "text_source",
        "download_count",
        "reading_ease_score",
        F.unix_micros("issued_at").alias("issued_us"),
        "withdrawn_reason",
    )


@query(
    """
    SELECT count(*) AS kept, count(*) FILTER (WHERE n_chars < 500) AS without_text
    FROM documents WHERE lang <> 'de'
    """
)
def active_records(spark, sf_dir):
    """Records not withdrawn, and how many of them lack text."""
    from datetime import datetime, timezone

    records = normalize.normalize_listing(
        _landed(spark, sf_dir), datetime(2024, 1, 1, tzinfo=timezone.utc)
    )
    active = filters.exclude_withdrawn(records)
    lacking = F.coalesce(F.col("searchable_text"), F.lit("")) == ""
    return active.agg(F.count(F.lit(1)).alias("kept"), F.count_if(lacking).alias("without_text"))


@query(
    f"""
    SELECT CAST(doc_id AS VARCHAR) AS id, 'Title ' || doc_id AS title, source AS authors,
           CASE WHEN lang = 'en' THEN lang || '; ' || source ELSE lang END AS subjects, '' AS bookshelves,
           n_chars AS download_count, CASE WHEN lang = 'en' THEN '1998-06-01' ELSE 'June' END AS issued,
           'pd' AS rights, '{fixed.LISTING_PAGE_URL}' || doc_id AS source_url
    FROM documents
    """
)
def listing_flat(spark, sf_dir):
    flat = normalize.flatten_listing(_landed(spark, sf_dir))
    return flat.select(
        "id", "title", "authors", "subjects", "bookshelves", "download_count", "issued", "rights",
        "source_url",
    )


@query(
    """
    SELECT CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page, count(*) AS returned, count(*) < 100 AS below_requested
    FROM documents GROUP BY 1
    """
)
def page_profile(spark, sf_dir):
    return profile.page_profile(_landed(spark, sf_dir), 100).drop("provider")


@query()
def observed_fields(spark, sf_dir):
    return profile.observed_fields(_landed(spark, sf_dir))


@query(
    f"""
    SELECT 'ark:/' || o_orderkey || '/v~' || o_custkey AS id, 'A "bare quote ' || o_orderkey AS title,
           {_RIGHTS_SQL} AS rights, true AS is_public_domain, CAST(o_custkey AS VARCHAR) AS oclc_num,
           '{fixed.VOLUME_PAGE_URL}ark%3A/' || o_orderkey || '/v~' || o_custkey AS source_url,
           '{fixed.VOLUME_RECORD_URL}' || o_custkey AS catalog_url
    FROM orders
    WHERE o_orderstatus <> 'P' AND {_RIGHTS_SQL} IN ('pd', 'pdus', 'pd-pvt')
    """
)
def volumes_flat(spark, sf_dir):
    """Orders written as lines of a volume file: one status a field short, one with a
    field too many."""
    orders = _with_rights(table(spark, sf_dir, "orders"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    values = {
        "htid": F.concat(F.lit("ark:/"), key, F.lit("/v~"), customer),
        "rights": F.col("rights"),
        "ht_bib_key": customer,
        "oclc_num": customer,
        "title": F.concat(F.lit('A "bare quote '), key),
    }
    fields = [values.get(c, F.lit("")) for c in fixed.VOLUME_COLUMNS]
    status = F.col("o_orderstatus")
    line = (
        F.when(status == "P", F.concat_ws("\t", *fields[:-1]))
        .when(status == "F", F.concat_ws("\t", *fields, F.lit("extra")))
        .otherwise(F.concat_ws("\t", *fields))
    )
    volumes = parse_volumes(orders.select(line.alias("value")))
    flat = normalize.flatten_volumes(filters.filter_public_domain(volumes))
    return flat.select(
        "id", "title", "rights", "is_public_domain", "oclc_num", "source_url", "catalog_url"
    )


# --- written and streamed ----------------------------------------------------------


@query(
    """
    SELECT lang AS provider, count(*) AS rows, true AS enough_shards FROM documents GROUP BY 1
    """
)
def shard_counts(spark, sf_dir):
    """Records written to a catalog of its own and counted from its manifest."""
    base = work_path(spark, "shards")
    rows_per_file = 100
    records = table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit(":"), "doc_id").alias("book_uid"),
        F.col("lang").alias("source"),
        F.col("doc_id").cast("string").alias("source_id"),
        F.lit("").alias("title"),
        F.current_timestamp().alias("ingested_at"),
        F.lit("").alias("content_hash"),
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        F.col("doc_id").alias("row_seq"),
        F.col("lang").alias("provider"),
        F.lit("2024-01-01").cast("date").alias("ingest_date"),
        F.lit(1).cast("bigint").alias("run_seq"),
    )
    catalog.append_catalog(records, base, rows_per_file)
    files = catalog.manifest(catalog.read_shards(spark, base), F.current_timestamp())
    enough = F.col("shards") >= F.ceil(F.col("rows") / rows_per_file)
    return catalog.manifest_summary(files).select("provider", "rows", enough.alias("enough_shards"))


@query("SELECT lang, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def export_roundtrip(spark, sf_dir):
    """Documents exported as JSON, CSV and Parquet; the CSV read back and counted."""
    base = work_path(spark, "export")
    flat = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    catalog.export(flat, base)
    back = spark.read.option("header", True).schema("doc_id bigint, lang string, n_chars bigint")
    return back.csv(f"{base}/csv").groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars")
    )


@query(
    """
    SELECT f.format, doc_id, lang, source, n_chars, sha256(text) AS text_hash, p.html, text IS NULL AS no_text
    FROM documents LEFT JOIN (SELECT page_id, any_value('<' || chr(34) || substring(html, 1, 40) || chr(10) || ' ') AS html FROM pages GROUP BY 1) p
      ON p.page_id = doc_id, (SELECT unnest(['json', 'csv', 'parquet']) AS format) f
    """
)
def export_formats(spark, sf_dir):
    """Every document with all its columns from each of the three exports, and a text with a quote,
    a line end and an outer blank, or none."""
    base = work_path(spark, "export")
    pages = table(spark, sf_dir, "pages").groupBy(F.col("page_id").alias("doc_id")).agg(F.any_value("html").alias("html"))
    hard = F.concat(F.lit('<"'), F.substring("html", 1, 40), F.lit("\n "))
    rows = table(spark, sf_dir, "documents").join(pages.withColumn("html", hard), "doc_id", "left")
    rows = rows.select("doc_id", "lang", "source", "n_chars", "text", "html")
    catalog.export(rows, base)
    back = [df.withColumn("format", F.lit(name)) for name, df in catalog.read_export(spark, base, rows.schema).items()]
    whole = back[0].unionByName(back[1]).unionByName(back[2])
    return whole.select(
        "format", "doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_hash"), "html",
        F.col("text").isNull().alias("no_text"),
    )


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS source_id, lang <> 'de' AS sound, CASE WHEN lang <> 'de' THEN n_chars END AS birth_year
    FROM documents
    """
)
def author_years(spark, sf_dir):
    """Years of authors given as whole numbers, as texts of them and with a zero fraction; a record
    with a part of a year is not sound."""
    n = F.col("n_chars").cast("string")
    year = (
        F.when(F.col("lang") == "de", F.concat(n, F.lit(".5"))).when(F.col("lang") == "es", F.concat(F.lit('"'), n, F.lit('"')))
        .when(F.col("lang") == "fr", F.concat(n, F.lit(".0"))).otherwise(n)
    )
    raw = F.concat(F.lit('{"id":'), F.col("doc_id"), F.lit(',"authors":[{"name":"A","birth_year":'), year, F.lit("}]}"))
    found = normalize.normalize_listing(table(spark, sf_dir, "documents").select(raw.alias("raw")), F.current_timestamp())
    return found.select(
        "source_id", "sound", F.when(F.col("sound"), F.col("authors")[0]["birth_year"].cast("bigint")).alias("birth_year")
    )


@query(
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
      FROM events) WHERE place = 1
    """
)
def stream_ingest(spark, sf_dir):
    """Events read as a stream, appended batch by batch, then the newest of each user."""
    base = work_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    append_stream(rows, f"{base}/events", f"{base}/checkpoint").awaitTermination()
    stored = spark.read.parquet(f"{base}/events")
    newest = catalog.latest_wins(stored, ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


@query(
    f"""
    SELECT 'gutenberg:' || d.doc_id AS book_uid, 'Title ' || d.doc_id AS title, d.n_chars AS download_count,
           CASE WHEN n_chars >= 500 THEN 'summary' WHEN p.html IS NOT NULL THEN 'first_chars' ELSE 'none' END
             AS text_source,
           sha256(CASE WHEN n_chars >= 500 THEN substring(trim(d.text, '{_WS}'), 1, 4000)
                       ELSE nullif(substring(trim(p.html, '{_WS}'), 1, 4000), '') END) AS text_hash
    FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
    """
)
def ingest_run(spark, sf_dir):
    """Two whole runs: documents listed as pages, first without and then with the page
    texts at hand; what is read back is the newest version of every record."""
    from datetime import datetime, timezone

    base = work_path(spark, "ingest")
    landed = _landed(spark, sf_dir)
    # A page holds 100 records, so the list gathered for it is bounded.
    pages = landed.groupBy("provider", "page").agg(
        F.array_sort(F.collect_list(F.struct("pos", "raw"))).alias("records")
    )
    payload = F.concat(
        F.lit('{"next": "more", "results": ['), F.array_join(F.col("records.raw"), ","), F.lit("]}")
    )
    pages = pages.select("provider", "page", F.lit(1).cast("bigint").alias("run"), payload.alias("payload"))
    pages = stage(pages, "landed-pages")  # a run reads its pages more than once
    texts = table(spark, sf_dir, "pages").select(
        F.lit(fixed.LISTING_SOURCE).alias("provider"),
        F.col("page_id").cast("string").alias("source_id"),
        F.col("html").alias("text"),
    )
    options = RunOptions(max_rows=None, budget=None, text_cap=None)
    for n, found in enumerate((None, texts), 1):
        day = datetime(2024, 1, n, tzinfo=timezone.utc)
        ingest(spark, base, pages, fixed.LISTING_SOURCE, options, f"run-{n}", day, found)
    latest = catalog.read_catalog(spark, base)
    return latest.select(
        "book_uid", "title", "download_count", "text_source",
        F.sha2("searchable_text", 256).alias("text_hash"),
    )
