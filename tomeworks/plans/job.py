"""The incremental ingestion run.

One run takes landed pages to stored records in these steps:

1. read the pages from the checkpoint on and stage a narrow row of each record;
2. compare content hashes with the state table, in the slots the records fall into;
3. find the page on which the row cap falls and drop what lies behind it;
4. give text to the most wanted records that lack it, within the text budget;
5. normalize the rows to keep whole and write them as one partition, then bring the state
   table, the manifest and the run log up to date.

Stored shards are opened only for records that gain text or carry theirs over.

The driver sees counters and page numbers, never records.  Everything a run writes is
keyed by its reserved sequence number, so a run that is delivered twice lands once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed
from ..operators.catalog import RECENCY, append_catalog, latest_wins, manifest, read_run
from ..operators.changes import cap_pages, classify_changes
from ..operators.enrich import attach_text, fetch_previews, select_budget
from ..operators.profile import status_counts
from ..schema import STORED, conform
from ..session import broadcast_if_small, drop_stages, stage, staged_so_far
from ..sources import explode_pages, read_shards
from ..sources.listing import first_gap, one_delivery, page_ends
from . import providers as registry
from .runlog import RunReport, reserve, resume_page, write_report
from .state import State

# A row's place in its run: page and position in one number.  A position is an int, so no
# two places meet.
_POSITIONS = 1 << 32
_ID = ("provider", "source_id")
_PLACE = ("provider", "page", "pos")
_TEXT = ("searchable_text", "text_source", "text_char_count")
# Previews are up to PREVIEW_CHARS long; this many still make a small broadcast.
_BROADCAST_PREVIEWS = 4096


@dataclass(frozen=True)
class RunOptions:
    mode: str = "incremental"
    stages: tuple[str, ...] = ("metadata", "text")
    max_rows: int | None = fixed.DEFAULT_MAX_ROWS
    budget: int | None = fixed.DEFAULT_BUDGET
    text_cap: int | None = fixed.DEFAULT_TEXT_CAP
    text_enabled: bool = True
    chars: int = fixed.PREVIEW_CHARS
    priority: str = "download_count"
    rows_per_file: int = fixed.DEFAULT_ROWS_PER_FILE
    compression: str = fixed.DEFAULT_COMPRESSION
    carry_text: bool = False
    match_resume_overshoot: bool = False
    dry_run: bool = False

    def __post_init__(self):
        if self.mode not in ("incremental", "full"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.chars <= 0:
            raise ValueError("chars must be positive")


def run(
    spark: SparkSession,
    base: str,
    landing: str,
    providers: Sequence[str] = (fixed.LISTING_SOURCE,),
    options: RunOptions = RunOptions(),
    run_id: str | None = None,
    run_ts: datetime | None = None,
) -> list[RunReport]:
    """Run every named provider over what is landed and return one report for each."""
    sources = [registry.provider(name) for name in providers]
    run_id = run_id or uuid.uuid4().hex
    run_ts = run_ts or datetime.now(timezone.utc)
    reports = []
    for source in sources:
        reports.append(_run_provider(spark, base, landing, source, options, run_id, run_ts))
    return reports


def ingest(
    spark: SparkSession,
    base: str,
    pages: DataFrame,
    provider: str,
    options: RunOptions,
    run_id: str,
    run_ts: datetime,
    texts: DataFrame | None = None,
) -> RunReport:
    """Take the given pages, all of them from page 1 on, as one run.  For streams, whose
    source keeps its own checkpoint, and for pages that come as a table, in which a page may
    have been fetched by several runs."""
    source = registry.provider(provider)
    mark = staged_so_far()
    try:
        seq, ts = (0, run_ts) if options.dry_run else reserve(
            spark, base, f"{run_id}/{provider}", run_ts
        )
        report = RunReport(run_id, seq, provider, options.mode, ts)
        pages = one_delivery(pages)
        return _take(spark, base, source, pages, texts, options, report, start=None)
    finally:
        drop_stages(spark, mark)


def _run_provider(spark, base, landing, source, options, run_id, run_ts) -> RunReport:
    mark = staged_so_far()
    try:
        if options.dry_run:
            seq, ts = 1 << 62, run_ts
        else:
            seq, ts = reserve(spark, base, f"{run_id}/{source.name}", run_ts)
        report = RunReport(run_id, seq, source.name, options.mode, ts)
        report.last_page = (
            0 if options.mode == "full" else resume_page(spark, base, source.name, seq)
        )
        # New records join the page the last run ended on, so it is taken again.
        start = max(1, report.last_page)
        stop = None if options.budget is None else start + options.budget - 1
        pages = source.read(spark, landing, start, stop) if "metadata" in options.stages else None
        texts = source.texts(spark, landing) if source.texts else None
        return _take(spark, base, source, pages, texts, options, report, start)
    finally:
        drop_stages(spark, mark)


def _take(spark, base, source, pages, texts, options, report, start) -> RunReport:
    state = State(spark, base, source.name, options.priority, report.run_seq, options.dry_run)

    def stored() -> DataFrame:
        # A run that is delivered again must not see what its first attempt wrote.
        shards = read_shards(spark, base, source.name)
        return shards if options.dry_run else shards.where(F.col("run_seq") < report.run_seq)

    def normalized(raw: DataFrame) -> DataFrame:
        return source.normalize(raw, report.started_at, options.chars)

    listed = raw = fresh = wanting = None
    if pages is not None and "metadata" in options.stages:
        raw = explode_pages(pages, keep_empty=True)
        kind = ("has_next", "sound", "content_hash", "text_char_count", options.priority)
        # A first run keeps nearly all that is listed, so whole rows are staged; later ones keep
        # little, and normalize that little once more.
        first = state.records == 0
        whole = normalized(raw)
        listed = stage(whole if first else whole.select(*_PLACE, "source_id", *dict.fromkeys(kind)), "listed")
        kept = _collect(listed, state, options, report, start)
        if kept is not None:
            fresh = _only(listed, kept, report) if first else normalized(_only(raw, kept, report))
            if options.carry_text:
                fresh = _carry_text(fresh, kept, stored())
            narrow = fresh if options.carry_text else listed.join(kept.select(*_PLACE), list(_PLACE), "left_semi")
            wanting = narrow.select(*_PLACE, "source_id", "text_char_count", options.priority)

    gained = None
    if "text" in options.stages and options.text_enabled and texts is not None:
        fresh, gained = _enrich(fresh, wanting, state, stored, texts, options, report)

    if options.dry_run:
        report.stopped_reason += "; nothing stored, as asked"
        return report

    parts = []
    if fresh is not None:
        place = F.col("page") * _POSITIONS + F.col("pos")
        parts.append(conform(fresh.withColumn("row_seq", place), STORED))
    if gained is not None:
        parts.append(conform(gained.withColumn("row_seq", F.lit(0)), STORED))
    written = None
    if parts:
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rows = (
            rows.withColumn("provider", F.lit(source.name))
            .withColumn("ingest_date", F.lit(report.started_at.date()))
            .withColumn("run_seq", F.lit(report.run_seq).cast("bigint"))
        )
        append_catalog(rows, base, options.rows_per_file, options.compression)
        written = read_run(spark, base, source.name, report.started_at.date(), report.run_seq)
        _account(written, base, report)
    state.update(written, report.new_records)
    if listed is not None:
        _set_aside(listed, raw, base, source.name, report)
    write_report(spark, base, report)
    return report


def _only(rows, kept, report) -> DataFrame:
    """The rows at the places ``kept``.  Where nothing that was listed is left out, no
    place is compared."""
    if report.listed == _kept(report) == kept.count():
        return rows.where("pos is not null")
    places = broadcast_if_small(kept.select(*_PLACE), rows=_kept(report))
    return rows.join(places, list(_PLACE), "left_semi")


def _collect(listed, state, options, report, start) -> DataFrame | None:
    """Steps 2 and 3: places and status of the new and changed records of the pages this run
    may take, the last of each id."""
    ends = page_ends(listed).first()
    if ends is None:
        return None
    report.listed = ends["records"]
    reader_driven = start is not None
    horizon = ends["end_page"] if reader_driven else ends["last_landed"]
    if reader_driven:
        # The checkpoint only moves over pages that are there.
        missing = None
        if ends["first_landed"] > start:
            missing = start
        elif ends["last_landed"] - start + 1 != ends["pages"]:
            missing = first_gap(listed)
        if missing is not None and missing <= horizon:
            horizon = missing - 1
            report.stopped_reason = f"awaiting page {missing}"
    if reader_driven and options.budget is not None:
        allowed = start + options.budget - 1
        if horizon >= allowed:
            report.stopped_reason = f"page limit {options.budget}"
        horizon = min(horizon, allowed)

    incoming = listed.where(F.col("sound") & (F.col("page") <= horizon)).select(
        *_ID, "content_hash", "page", "pos"
    )
    known = state.near(incoming)
    decided = stage(
        classify_changes(incoming, known, ("source_id",), spread_by=("page", "pos")), "decided"
    )

    upto = horizon
    if options.max_rows is not None:
        cut = cap_pages(
            decided.withColumn("kept", F.col("status") != "unchanged"),
            options.max_rows,
            resumed_page=start if report.last_page else None,
            match_resume_overshoot=options.match_resume_overshoot,
        ).first()
        if cut is not None and cut["cut_page"] <= horizon:
            upto = cut["cut_page"]
            report.stopped_reason = f"row limit {options.max_rows} on page {upto}"
    within = decided.where(F.col("page") <= upto)
    for name, n in status_counts(within).first().asDict().items():
        setattr(report, name, n)
    if reader_driven:
        report.pages_read = max(0, upto - start + 1)
    else:
        report.pages_read = ends["pages"]
    report.last_page = max(report.last_page, upto)

    if _kept(report) == 0:
        return None

    kept = latest_wins(within.where("status <> 'unchanged'"), _ID, ("page", "pos"))
    return stage(kept.select(*_PLACE, "source_id", "status"), "kept")


def _carry_text(fresh, kept, stored) -> DataFrame:
    """Changed records that come without text keep the text of their last version."""
    fresh = fresh.join(kept.select(*_PLACE, "status"), list(_PLACE))
    bare = fresh.where("status = 'changed' and text_char_count = 0").select(*_ID)
    versions = stored.select(*_ID, *_TEXT, *RECENCY)
    versions = versions.join(broadcast_if_small(bare), list(_ID), "left_semi")
    last = latest_wins(versions, _ID, RECENCY)
    last = last.select(*_ID, *[F.col(c).alias(f"old_{c}") for c in _TEXT])
    keep = (F.col("text_char_count") == 0) & F.coalesce(F.col("old_text_char_count") > 0, F.lit(False))
    joined = fresh.join(last, list(_ID), "left")
    for c in _TEXT:
        joined = joined.withColumn(f"new_{c}", F.when(keep, F.col(f"old_{c}")).otherwise(F.col(c)))
    drop = [*_TEXT, *[f"old_{c}" for c in _TEXT], "status"]
    return joined.drop(*drop).withColumnsRenamed({f"new_{c}": c for c in _TEXT})


def _kept(report) -> int:
    return report.new_records + report.changed_records


def _owed(state, listed) -> DataFrame:
    """Narrow rows of stored records whose newest version has no text, except records
    that this run lists again."""
    owed = state.rows().where("owes")
    return owed if listed is None else owed.join(listed.select("source_id"), "source_id", "left_anti")


def _enrich(fresh, listed, state, stored, texts, options, report) -> tuple[DataFrame | None, DataFrame | None]:
    """Step 4: (fresh records with text filled in, stored records that gained text).

    ``listed`` are the narrow rows of the fresh records."""
    # Ties go by arrival, records owed from earlier runs first.
    targets = _owed(state, listed).select(
        F.lit(report.provider).alias("provider"), "source_id", F.col("wanted").alias(options.priority),
        F.lit(0).alias("wave"), F.col("run_seq").alias("a"), F.col("row_seq").alias("b"),
    )
    if listed is not None:
        targets = targets.unionByName(
            listed.where("text_char_count = 0").select(
                *_ID, options.priority, F.lit(1).alias("wave"),
                F.col("page").alias("a"), F.col("pos").cast("bigint").alias("b"),
            )
        )
    targets = stage(targets, "targets")
    wanting = targets.count()

    limits = [n for n in (options.text_cap, _left(options, report)) if n is not None]
    k = max(0, min(limits)) if limits else None
    if k is not None and wanting > k:
        by_cap = options.text_cap is not None and k == options.text_cap
        report.stopped_reason = (
            f"text limit {k}" if by_cap else f"page limit {options.budget} left {k} texts"
        )
    report.text_pending = wanting
    if wanting == 0 or k == 0:
        return fresh, None
    chosen = select_budget(targets, k, options.priority, ties=("wave", "a", "b"))
    at_most = wanting if k is None else min(k, wanting)
    previews = stage(fetch_previews(chosen, texts, options.chars, _ID, at_most), "previews")
    report.text_fetched = previews.count()
    report.text_pending = wanting - report.text_fetched

    if report.text_fetched == 0:
        return fresh, None
    got = report.text_fetched
    small = broadcast_if_small(previews, _BROADCAST_PREVIEWS, rows=got)
    if fresh is not None:
        fresh = attach_text(fresh, small, _ID)
    if not targets.where("wave = 0").join(previews.select(*_ID), list(_ID), "left_semi").limit(1).count():
        return fresh, None
    hit = broadcast_if_small(previews.select(*_ID), rows=got)
    old = targets.where("wave = 0").select(*_ID, F.col("a").alias("run_seq"), F.col("b").alias("row_seq"))
    old = old.join(hit, list(_ID), "left_semi")
    old = broadcast_if_small(old, rows=got)
    versions = stored().join(old, [*_ID, "run_seq", "row_seq"], "left_semi")
    return fresh, attach_text(versions, small, _ID)


def _left(options, report) -> int | None:
    return None if options.budget is None else options.budget - report.pages_read


def _account(written, base, report) -> None:
    """Count what this run has on disk and write its manifest."""
    (
        manifest(written, report.started_at).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_seq", "provider")
        .parquet(f"{base}/_manifest")
    )
    own = written.sparkSession.read.parquet(f"{base}/_manifest/run_seq={report.run_seq}/provider={report.provider}")
    report.rows_written = own.agg(F.sum("rows")).first()[0] or 0


def _set_aside(listed, raw, base, provider, report) -> None:
    """Keep malformed records where they can be looked at."""
    bad = listed.where(
        ~F.col("sound") & F.col("pos").isNotNull() & (F.col("page") <= report.last_page)
    )
    report.quarantined = bad.count()
    if report.quarantined:
        places = broadcast_if_small(bad.select(*_PLACE), rows=report.quarantined)
        (
            raw.join(places, list(_PLACE), "left_semi")
            .select("page", "pos", "raw")
            .withColumn("run_seq", F.lit(report.run_seq))
            .withColumn("provider", F.lit(provider))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_seq", "provider")
            .parquet(f"{base}/quarantine")
        )
