"""Tolerant parsing of landed values.

A listing record is loosely typed: one field may be a string, a list, a number or an
object from one record to the next.  Records are therefore parsed to VARIANT and read
with ``try_variant_get``, which gives null where a value has another shape.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed
from ..schema import AUTHOR

_DATE_TIME = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?"
_INSTANT = rf"^(?:{_DATE_TIME}[+-]\d{{2}}:\d{{2}}|\d{{4}}-\d{{1,2}}-\d{{1,2}}T00:00:00\+00:00)$"


def variant_text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def variant_kind(value: Column) -> Column:
    """Shape of a variant value: STRING, BIGINT, OBJECT<…>, ARRAY<…>, VOID; null if absent."""
    return F.schema_of_variant(value)


def string_list(record: Column, path: str) -> Column:
    """A list of strings from a list, a bare string or nothing; items that are empty, false,
    zero or null are dropped."""

    def item_text(item: Column) -> Column:
        text, kind = F.try_variant_get(item, "$", "string"), variant_kind(item)
        unset = (text == "") | ((kind == "BOOLEAN") & (text == "false"))
        unset = unset | (kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (text.try_cast("double") == 0))
        return F.when(~unset, text)

    listed = F.transform(F.try_variant_get(record, path, "array<variant>"), item_text)
    items = F.filter(listed, lambda item: item.isNotNull())
    bare = variant_text(record, path)
    is_bare = variant_kind(F.try_variant_get(record, path, "variant")) == "STRING"
    return F.coalesce(
        items,
        F.when(is_bare & (bare != ""), F.array(bare)),
        F.array().cast("array<string>"),
    )


def author_list(record: Column, path: str) -> Column:
    """Authors given as objects or bare names, as an array of author structs."""

    def one(author: Column) -> Column:
        bare = F.when(variant_kind(author) == "STRING", author.cast("string"))
        return F.struct(
            F.coalesce(bare, F.try_variant_get(author, "$.name", "string"), F.lit("")).alias("name"),
            F.try_variant_get(author, "$.id", "string").alias("source_author_id"),
            F.try_variant_get(author, "$.birth_year", "int").alias("birth_year"),
            F.try_variant_get(author, "$.death_year", "int").alias("death_year"),
        )

    listed = F.transform(F.try_variant_get(record, path, "array<variant>"), one)
    return F.coalesce(listed, F.array()).cast(f"array<{AUTHOR.simpleString()}>")


def first_number(value: Column) -> Column:
    """The first number found in a text; null if there is none."""
    found = F.regexp_extract(value, fixed.NUMBER_PATTERN, 0)
    return F.nullif(found, F.lit("")).try_cast("double")


def number_of(record: Column, path: str) -> Column:
    """A number as it is, or the first number of a text."""
    kind = variant_kind(F.try_variant_get(record, path, "variant"))
    number = F.try_variant_get(record, path, "double")
    return F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), number).otherwise(
        first_number(variant_text(record, path))
    )


def issued_timestamp(value: Column) -> Column:
    """A calendar date or an ISO timestamp as an instant; one without offset is UTC.

    Texts outside the accepted shapes (a bare year, a year and month, prose) are null.
    An offset is always written out before the cast, so the session zone has no say.
    """
    steps = (
        (r"Z$", "+00:00"),
        (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
        (r"^(\d{4}-\d{1,2}-\d{1,2})$", "$1T00:00:00+00:00"),
        (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})($|[+-])", "$1:00$2"),
        (rf"^({_DATE_TIME})$", "$1+00:00"),
        (rf"^({_DATE_TIME}[+-]\d{{2}})(\d{{2}})$", "$1:$2"),
    )
    text = F.btrim(value, F.lit(fixed.WHITE_SPACE))
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    # One chain and one extract: the expression is not repeated for a test of its shape.
    return F.regexp_extract(text, _INSTANT, 0).try_cast("timestamp")


def first_plain_text_url(raw_json: Column) -> Column:
    """URL of the first ``text/plain…`` entry of the record's ``formats``, in the order
    the record lists them.  Read from the JSON text: a VARIANT sorts its keys."""
    formats = F.from_json(raw_json, "formats map<string,string>").getField("formats")
    plain = F.filter(
        F.map_entries(formats),
        lambda entry: F.startswith(entry.getField("key"), F.lit("text/plain"))
        & (entry.getField("value") != ""),
    )
    return F.get(plain, F.lit(0)).getField("value")


def json_int(text: Column, path: str) -> Column:
    return F.get_json_object(text, path).try_cast("int")
