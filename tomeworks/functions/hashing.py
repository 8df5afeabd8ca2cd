"""Content hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import HASHED


def record_hash() -> Column:
    """SHA-256 over the metadata of a canonical record.

    Two records hash alike exactly when every hashed column is equal: lists compare in
    order, maps regardless of order, nulls are written out.
    """
    prepared = {
        "identifiers": F.array_sort(F.map_entries("identifiers")),
        "issued_at": F.unix_micros("issued_at"),
    }
    fields = [prepared.get(name, F.col(name)).alias(name) for name in HASHED]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def text_hash(*columns: Column) -> Column:
    """SHA-256 over strings with a separator and a null mark that no text contains."""
    parts = [F.coalesce(c, F.lit("\x00")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
