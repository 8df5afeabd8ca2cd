"""tomeworks: building and maintaining large record catalogs on Spark.

The names below are the public surface; everything takes and returns DataFrames.
"""

from .operators.catalog import (
    append_catalog,
    catalog_state,
    export,
    latest_shards,
    latest_wins,
    manifest,
    manifest_summary,
    read_catalog,
)
from .operators.changes import cap_pages, change_sequence, classify_changes, page_cap
from .operators.enrich import attach_text, display_text, fetch_previews, pending, select_budget
from .operators.filters import (
    exclude_withdrawn,
    filter_public_domain,
    missing_text,
    only_sources,
    text_quality,
)
from .operators.normalize import (
    display_info,
    flatten_listing,
    flatten_volumes,
    is_public_domain,
    normalize_listing,
    split_valid,
)
from .operators.profile import (
    counts,
    coverage,
    observed_fields,
    out_of_order,
    page_profile,
    scan_counters,
    shape,
    shares,
    status_counts,
)
from .operators.search import join_vectors, lookup, nan_to_null, search, union_sources
from .operators.snapshots import (
    apply_deltas,
    delta_gaps,
    delta_share,
    missing_ids,
    public_domain_flow,
    snapshot_diff,
    transitions,
)
from .operators.neighbours import neighbours as nearest_by_pivots
from .operators.vectors import nearest
from .operators.works import collapse_works, drop_known, with_work_key
from .plans.job import RunOptions, ingest, run
from .plans.providers import Provider, listing_provider, provider, register
from .plans.runlog import RunReport, read_run_log
from .schema import RECORD, conform
from .session import local_session

__all__ = [name for name in dir() if not name.startswith("_")]
