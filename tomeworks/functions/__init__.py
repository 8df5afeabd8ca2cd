"""Column helpers.  Every one takes and returns Columns built from Spark's own functions."""

from .hashing import record_hash, text_hash
from .parsing import (
    author_list,
    first_number,
    first_plain_text_url,
    issued_timestamp,
    json_int,
    string_list,
)
from .text import (
    after_front_matter,
    all_digits,
    iso_date,
    join_tags,
    path_quote,
    preview,
    search_blob,
    split_tags,
    strip_space,
    text_ladder,
    text_ladder_origin,
    first_chars,
)

__all__ = [
    "after_front_matter", "all_digits", "author_list", "first_chars", "first_number",
    "first_plain_text_url", "iso_date", "issued_timestamp", "join_tags", "json_int",
    "path_quote", "preview", "record_hash", "search_blob", "split_tags", "string_list",
    "strip_space", "text_hash", "text_ladder", "text_ladder_origin",
]
