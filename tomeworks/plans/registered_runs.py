"""Queries over whole ingestion runs: repeated, growing, changed, capped, on a budget, side by side.

Documents are the records of a listing with a hundred a page.  Every run takes all that is landed.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..operators import catalog, profiles
from ..session import move_only_file, stage, work_path
from ..sources import read_shards
from .job import RunOptions, ingest, run
from .providers import listing_provider, register
from .registry import query, table
from .runlog import read_run_log
from .state import State

_SOURCE = fixed.LISTING_SOURCE
_COUNTERS = (
    "run_seq", "last_page", "pages_read", "new_records", "changed_records", "unchanged_records", "rows_written", "stopped_reason",
)
_PAGES_SQL = "SELECT *, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page FROM documents"


def _raw(title: Column) -> Column:
    return F.to_json(F.struct(F.col("doc_id").alias("id"), title.alias("title"), F.col("n_chars").alias("download_count")))


def _pages(docs: DataFrame, run_no: int = 1, provider: str = _SOURCE) -> DataFrame:
    """``docs(doc_id, raw)`` as fetched pages.  A page holds a hundred records at most."""
    paged = docs.select((F.floor(F.col("doc_id") / 100) + 1).alias("page"), F.struct("doc_id", "raw").alias("r"))
    listed = paged.groupBy("page").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    payload = F.concat(F.lit('{"next": "more", "results": ['), F.array_join(F.col("rs.raw"), ","), F.lit("]}"))
    pages = listed.select(
        F.lit(provider).alias("provider"), "page", F.lit(run_no).cast("long").alias("run"), payload.alias("payload")
    )
    return stage(pages, "landed-pages")  # a run reads its pages more than once


def _documents(spark, sf_dir, title: Column | None = None) -> DataFrame:
    title = F.concat(F.lit("Title "), F.col("doc_id")) if title is None else title
    return table(spark, sf_dir, "documents").withColumn("raw", _raw(title))


def _take(spark, base, pages, n, options=RunOptions(), texts=None, provider=_SOURCE):
    return ingest(spark, base, pages, provider, options, f"run-{n}", datetime(2024, 1, n, tzinfo=timezone.utc), texts)


@query(
    f"""
    WITH d AS ({_PAGES_SQL}), c AS (SELECT max(page) AS last, count(DISTINCT page) AS pages, count(*) AS n FROM d)
    SELECT r AS run_seq, last AS last_page, pages AS pages_read, CASE WHEN r = 1 THEN n ELSE 0 END AS new_records,
      0 AS changed_records, CASE WHEN r = 1 THEN 0 ELSE n END AS unchanged_records,
      CASE WHEN r = 1 THEN n ELSE 0 END AS rows_written, 'completed' AS stopped_reason
    FROM c, (SELECT unnest([1, 2]) AS r)
    """
)
def ingest_repeat(spark, sf_dir):
    """The same pages twice: the second run stores nothing."""
    base, pages = work_path(spark, "repeat"), _pages(_documents(spark, sf_dir))
    for n in (1, 2):
        _take(spark, base, pages, n)
    return read_run_log(spark, base).select(*_COUNTERS)


@query(
    f"""
    WITH d AS ({_PAGES_SQL}), l AS (SELECT * FROM d WHERE doc_id IN (SELECT doc_id FROM labels)),
    c AS (SELECT 1 AS r, max(page) AS last, count(DISTINCT page) AS pages, count(*) AS n, 0 AS old FROM l
          UNION ALL SELECT 2, max(page), count(DISTINCT page), count(*) - (SELECT count(*) FROM l), (SELECT count(*) FROM l) FROM d)
    SELECT r AS run_seq, last AS last_page, pages AS pages_read, n AS new_records, 0 AS changed_records,
      old AS unchanged_records, n AS rows_written, 'completed' AS stopped_reason FROM c
    """
)
def ingest_growth(spark, sf_dir):
    """Labelled documents are listed first, all of them later: only the others are new then."""
    base, docs = work_path(spark, "growth"), _documents(spark, sf_dir)
    first = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    for n, listed in enumerate((first, docs), 1):
        _take(spark, base, _pages(listed), n)
    return read_run_log(spark, base).select(*_COUNTERS)


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS source_id, 1 AS run_seq, 'Title ' || doc_id AS title, n_chars AS download_count,
      make_timestamp(2024, 1, 1, 0, 0, 0) AS ingested_at FROM documents
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 2, 'Good ' || doc_id, n_chars, make_timestamp(2024, 1, 2, 0, 0, 0)
    FROM documents JOIN labels USING (doc_id) WHERE quality = 1
    """
)
def ingest_full_changed(spark, sf_dir):
    """All stored versions after a run that lists good documents under a new title, with the downloads
    of every other one doubled, which is no change."""
    base, docs = work_path(spark, "changed"), table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    title = F.concat(F.when(good, "Good ").otherwise("Title "), F.col("doc_id"))
    later = docs.join(labels, "doc_id", "left").withColumn(
        "n_chars", F.when(good, F.col("n_chars")).otherwise(F.col("n_chars") * 2)
    )
    _take(spark, base, _pages(_documents(spark, sf_dir)), 1)
    _take(spark, base, _pages(later.withColumn("raw", _raw(title))), 2, RunOptions(mode="full"))
    return read_shards(spark, base).select(
        "source_id", "run_seq", "title", "download_count", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")
    )


_CAP = 150


@query(
    f"""
    WITH d AS ({_PAGES_SQL}), m AS (SELECT max(page) AS last, count(DISTINCT page) AS pages FROM d),
    p AS (SELECT page, sum(count(*)) OVER (ORDER BY page) AS reach FROM d GROUP BY page),
    c1 AS (SELECT min(page) AS cut FROM p WHERE reach >= {_CAP}),
    e1 AS (SELECT coalesce(cut, last) AS upto, cut FROM c1, m),
    n1 AS (SELECT *, (SELECT reach FROM p WHERE page = upto) AS got FROM e1),
    c2 AS (SELECT min(page) AS cut FROM p, n1 WHERE reach - got >= {_CAP}),
    e2 AS (SELECT coalesce(c2.cut, last) AS upto, c2.cut, got FROM c2, m, n1),
    n2 AS (SELECT *, (SELECT reach FROM p WHERE page = upto) AS total FROM e2)
    SELECT 1 AS run_seq, upto AS last_page, pages AS pages_read, CAST(got AS BIGINT) AS new_records, 0 AS changed_records,
      0 AS unchanged_records, CAST(got AS BIGINT) AS rows_written,
      CASE WHEN cut IS NULL THEN 'completed' ELSE 'row limit {_CAP} on page ' || upto END AS stopped_reason FROM n1, m
    UNION ALL
    SELECT 2, upto, pages, CAST(total - got AS BIGINT), 0, CAST(got AS BIGINT), CAST(total - got AS BIGINT),
      CASE WHEN cut IS NULL THEN 'completed' ELSE 'row limit {_CAP} on page ' || upto END FROM n2, m
    """
)
def ingest_capped(spark, sf_dir):
    """Two runs that end on the page on which their new rows reach the cap."""
    base, pages = work_path(spark, "capped"), _pages(_documents(spark, sf_dir))
    for n in (1, 2):
        _take(spark, base, pages, n, RunOptions(max_rows=_CAP))
    return read_run_log(spark, base).select(*_COUNTERS)


_FIRST, _SECOND = 60, 90
_BUDGET_SQL = f"""
    WITH d AS (SELECT doc_id, n_chars, html IS NOT NULL AND trim(html) <> '' AS has FROM documents
               LEFT JOIN pages ON page_id = doc_id),
    a AS (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) <= {_FIRST} AND has AS one FROM d),
    b AS (SELECT *, NOT one AND row_number() OVER (PARTITION BY one ORDER BY n_chars DESC, doc_id) <= {_SECOND} AND has AS two FROM a)
"""


def _budgeted(spark, sf_dir) -> str:
    """A catalog after two runs with small text budgets; page texts are at hand for some documents."""
    base, pages = work_path(spark, "budget"), _pages(_documents(spark, sf_dir))
    texts = table(spark, sf_dir, "pages").select(
        F.lit(_SOURCE).alias("provider"), F.col("page_id").cast("string").alias("source_id"), F.col("html").alias("text")
    )
    for n, cap in enumerate((_FIRST, _SECOND), 1):
        _take(spark, base, pages, n, RunOptions(text_cap=cap), texts)
    return base


@query(
    _BUDGET_SQL + """
    SELECT 'gutenberg:' || doc_id AS book_uid, CASE WHEN two THEN 2 ELSE 1 END AS run_seq,
      CASE WHEN one OR two THEN 'first_chars' ELSE 'none' END AS text_source,
      (SELECT count(*) FROM b WHERE NOT one) AS pending_first, (SELECT count(*) FROM b WHERE NOT one AND NOT two) AS pending_second
    FROM b
    """
)
def ingest_text_budget(spark, sf_dir):
    """Which records gain text in which run: the most wanted first, those without a text stay owed."""
    base = _budgeted(spark, sf_dir)
    log = read_run_log(spark, base)
    owed = lambda n: log.where(F.col("run_seq") == n).agg(F.max("text_pending")).scalar()
    return catalog.latest_shards(spark, base).select(
        "book_uid", "run_seq", "text_source", owed(1).alias("pending_first"), owed(2).alias("pending_second")
    )


@query(
    _BUDGET_SQL + """
    SELECT CAST(doc_id AS VARCHAR) AS source_id, NOT (one OR two) AS owes, n_chars AS wanted,
      CASE WHEN two THEN 2 ELSE 1 END AS run_seq, make_timestamp(2024, 1, 1, 0, 0, 0) AS ingested_at FROM b
    """
)
def state_table(spark, sf_dir):
    """What the next run would know of each record, from the bucketed table alone."""
    base = _budgeted(spark, sf_dir)
    state = State(spark, base, _SOURCE, "download_count", 3, dry_run=True)
    if state.table is None:
        raise RuntimeError("the table does not hold the last run")
    return state.rows().select(
        "source_id", "owes", "wanted", "run_seq", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")
    )


@query(
    """
    WITH d AS (SELECT CASE WHEN lang = 'en' THEN 'gutenberg' ELSE 'second' END AS provider, doc_id FROM documents)
    SELECT provider, count(*) AS total_records, max(doc_id) AS max_id_seen, 2 AS runs, count(*) AS unchanged_records,
      (SELECT count(*) FROM d) AS uids
    FROM d GROUP BY provider
    """
)
def ingest_two_providers(spark, sf_dir):
    """Two sources in one catalog, each run twice, with their own state and checkpoints."""
    register(listing_provider("second"))
    base, docs = work_path(spark, "providers"), _documents(spark, sf_dir)
    english = F.col("lang") == "en"
    for n in (1, 2):
        _take(spark, base, _pages(docs.where(english)), n)
        _take(spark, base, _pages(docs.where(~english), provider="second"), n, provider="second")
    log = read_run_log(spark, base).groupBy("provider").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("unchanged_records").alias("unchanged_records")
    )
    latest = catalog.latest_shards(spark, base)
    uids = latest.agg(F.count_distinct("book_uid")).scalar()
    return catalog.catalog_state(latest).join(log, "provider").withColumn("uids", uids)


@query(
    f"""
    WITH d AS ({_PAGES_SQL}),
    r AS (
      SELECT page, row_number() OVER (PARTITION BY page ORDER BY doc_id) - 1 AS pos, lang,
        CASE lang WHEN 'de' THEN '{{"id":' || doc_id || ',"title":5}}' WHEN 'es' THEN '{{"title":"no id"}}'
          WHEN 'fr' THEN '{{"id":' || doc_id || ',"authors":[{{"name":null}}]}}' END AS raw FROM d)
    SELECT page, pos, raw, (SELECT count(*) FROM r WHERE lang = 'en') AS stored, (SELECT count(*) FROM r WHERE lang <> 'en') AS set_aside
    FROM r WHERE raw IS NOT NULL
    """
)
def quarantine_rows(spark, sf_dir):
    """Records with a title that is no text, without an id or with an unnamed author are set aside whole;
    the others of their pages are stored."""
    base, key = work_path(spark, "quarantine"), F.col("doc_id")
    raw = (
        F.when(F.col("lang") == "de", F.concat(F.lit('{"id":'), key, F.lit(',"title":5}')))
        .when(F.col("lang") == "es", '{"title":"no id"}')
        .when(F.col("lang") == "fr", F.concat(F.lit('{"id":'), key, F.lit(',"authors":[{"name":null}]}')))
        .otherwise(_raw(F.lit("sound")))
    )
    report = _take(spark, base, _pages(table(spark, sf_dir, "documents").withColumn("raw", raw)), 1)
    stored = read_shards(spark, base).agg(F.count(F.lit(1))).scalar()
    aside = spark.read.parquet(f"{base}/quarantine")
    return aside.select("page", "pos", "raw", stored.alias("stored"), F.lit(report.quarantined).alias("set_aside"))


@query(
    f"""
    WITH d AS ({_PAGES_SQL}), again AS (SELECT DISTINCT page FROM d JOIN labels USING (doc_id) WHERE quality = 0)
    SELECT CAST(doc_id AS VARCHAR) AS source_id, CASE WHEN page IN (FROM again) THEN 'Again ' ELSE 'Title ' END || doc_id AS title,
      (SELECT count(*) FROM d) AS rows_written
    FROM d
    """
)
def ingest_refetched_pages(spark, sf_dir):
    """Pages that were fetched again, and delivered twice, count once and with their newest fetch."""
    base, docs = work_path(spark, "refetched"), _documents(spark, sf_dir)
    bad = table(spark, sf_dir, "labels").where("quality = 0").select((F.floor(F.col("doc_id") / 100) + 1).alias("page")).distinct()
    later = _pages(_documents(spark, sf_dir, F.concat(F.lit("Again "), F.col("doc_id"))), 2).join(F.broadcast(bad), "page", "left_semi")
    later = later.select("provider", "page", "run", "payload")
    report = _take(spark, base, _pages(docs).unionByName(later).unionByName(later), 1)
    return read_shards(spark, base).select("source_id", "title", F.lit(report.rows_written).alias("rows_written"))


def _land(spark, pages: DataFrame, landing: str) -> None:
    """Pages as the files a fetcher leaves behind, one for each."""
    drafts = work_path(spark, "drafts")
    pages.select("page", "run", "payload").repartition("page").write.partitionBy("page", "run").text(drafts)
    for r in pages.select("page", "run").collect():  # names of files, not what is in them
        name = f"page-{r.page:06d}.run-{r.run}.json"
        move_only_file(spark, f"{drafts}/page={r.page}/run={r.run}", f"{landing}/listing/provider={_SOURCE}/{name}")


@query(
    f"""
    WITH d AS ({_PAGES_SQL}), m AS (SELECT max(page) AS last, count(*) AS n FROM d),
    f AS (SELECT count(*) FILTER (WHERE page <= 2) AS early, count(*) FILTER (WHERE page = 2) AS again,
                 count(*) FILTER (WHERE page > 2) AS late FROM d)
    SELECT 1 AS run_seq, 2 AS last_page, 2 AS pages_read, early AS new_records, 0 AS changed_records, 0 AS unchanged_records,
      early AS rows_written, 'page limit 2' AS stopped_reason FROM f
    UNION ALL
    SELECT 2, last, last - 1, late, 0, again, late, 'completed' FROM f, m
    UNION ALL
    SELECT 0, last, last, 0, 0, n, 0, 'completed; nothing stored, as asked' FROM m
    """
)
def run_landed_files(spark, sf_dir):
    """Landed files read page by page: a run with a limit, one that resumes on the last page, and a dry
    run over all pages, which stores nothing."""
    base, landing = work_path(spark, "landed"), work_path(spark, "landing")
    _land(spark, _pages(_documents(spark, sf_dir)), landing)
    only = ("metadata",)
    plans = [RunOptions(budget=2, stages=only), RunOptions(stages=only), RunOptions(mode="full", dry_run=True, stages=only)]
    reports = [run(spark, base, landing, options=o, run_id=str(n))[0] for n, o in enumerate(plans)]
    dry = reports[-1].as_row(spark).withColumn("run_seq", F.lit(0).cast("long"))
    return read_run_log(spark, base).select(*_COUNTERS).unionByName(dry.select(*_COUNTERS))


_PROFILE_SQL = """
    WITH v AS (
      SELECT 'gutenberg' AS provider, doc_id, n_chars, 'Title ' || doc_id AS title FROM documents
      UNION ALL SELECT 'gutenberg', doc_id, n_chars, 'Good ' || doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1)
"""


def _profiled(spark, sf_dir) -> str:
    """Two runs, the second with new titles; each is profiled when it ends."""
    base, docs = work_path(spark, "profiles"), table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    again = docs.join(good, "doc_id", "left_semi").withColumn("raw", _raw(F.concat(F.lit("Good "), F.col("doc_id"))))
    for n, listed in enumerate((_documents(spark, sf_dir), again), 1):
        _take(spark, base, _pages(listed), n)
        profiles.update_profiles(spark, base)
    return base


@query(
    _PROFILE_SQL + """
    , f(field, has) AS (VALUES ('book_uid', true), ('source', true), ('source_id', true), ('identifiers', true), ('title', true),
      ('alternative_title', false), ('authors', false), ('publication_year', false), ('language', false), ('subjects', false),
      ('categories', false), ('publisher', false), ('download_url', true), ('source_url', true), ('cover_image_url', false),
      ('media_type', false), ('license', true), ('is_public_domain', true), ('rights_statement', true), ('searchable_text', false),
      ('text_source', true), ('text_char_count', true), ('download_count', true), ('reading_ease_score', false),
      ('issued_at', false), ('withdrawn_reason', false), ('ingested_at', true), ('provider_version', true),
      ('content_hash', true), ('schema_version', true)),
    n AS (SELECT count(*) AS n FROM v)
    SELECT field, n AS rows, CASE WHEN has THEN n ELSE 0 END AS present, CASE WHEN has THEN 10000 ELSE 0 END AS basis_points FROM f, n
    """
)
def profile_coverage(spark, sf_dir):
    """Coverage of all stored versions from the profiles of the runs, without a shard."""
    rows, _ = profiles.read_profiles(spark, _profiled(spark, sf_dir))
    return profiles.profiled_coverage(rows)


@query(
    _PROFILE_SQL + """
    SELECT 'none' AS value, count(*) AS rows, 10000 AS basis_points, count(*) AS all_rows, true AS ids_close, true AS median_close,
      2 AS parts
    FROM v
    """
)
def profile_merged(spark, sf_dir):
    """Shares and sketches merged over the runs; the sketches are held against exact figures."""
    base = _profiled(spark, sf_dir)
    rows, values = profiles.read_profiles(spark, base)
    total = profiles.profiled_totals(rows, (0.45, 0.55))
    shards = read_shards(spark, base)
    ids = shards.agg(F.count_distinct("book_uid")).scalar()
    middle = shards.agg(F.percentile("download_count", F.lit(0.5))).scalar()
    close = F.abs(F.col("distinct_ids") - ids) <= F.ceil(ids * 0.05)
    around = (F.col("downloads")[0] <= middle) & (middle <= F.col("downloads")[1])
    held = total.select(F.col("rows").alias("all_rows"), close.alias("ids_close"), around.alias("median_close"))
    extra = {name: held.select(name).scalar() for name in held.columns}
    parts = rows.agg(F.count(F.lit(1))).scalar()
    return profiles.profiled_shares(values, "text_source").withColumns({**extra, "parts": parts})
