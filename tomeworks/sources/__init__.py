"""Readers.  Every reader returns a lazy DataFrame with a fixed schema."""

from .listing import explode_pages, newest_pages, read_listing, read_listing_stream, read_pages
from .shards import read_flat_sources, read_shards
from .texts import read_texts
from .volumes import newest_file, parse_volumes, read_file_index, read_volumes, read_volumes_stream

__all__ = [
    "explode_pages", "newest_file", "newest_pages", "parse_volumes", "read_file_index",
    "read_flat_sources", "read_listing", "read_listing_stream", "read_pages", "read_shards",
    "read_texts", "read_volumes", "read_volumes_stream",
]
