"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed


def strip_space(text: Column) -> Column:
    """Unicode white space off both ends.  Only the ends are touched, so this stays
    cheap on whole books, unlike a pattern that scans the text."""
    return F.btrim(text, F.lit(fixed.WHITE_SPACE))


def first_chars(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def after_front_matter(
    text: Column,
    marker: str = fixed.FRONT_MATTER_MARKER,
    window: int = fixed.MARKER_WINDOW,
) -> Column:
    """The text behind the first marker that lies wholly inside the first ``window``
    characters; the text unchanged when there is none."""
    head = F.substring(text, 1, window)
    tail = F.substring(text, F.lit(window + 1), F.length(text))
    cut = F.concat(F.regexp_replace(head, f"(?isU)^.*?{marker}", ""), tail)
    return F.when(F.contains(head, F.lit("***")), cut).otherwise(text)


def preview(
    text: Column,
    chars: int = fixed.PREVIEW_CHARS,
    marker: str = fixed.FRONT_MATTER_MARKER,
) -> Column:
    """Opening ``chars`` characters of a full text behind its front matter, or null."""
    return F.nullif(first_chars(strip_space(after_front_matter(text, marker)), chars), F.lit(""))


def path_quote(value: Column) -> Column:
    """Percent-encoding for a URL path: ``/`` and ``~`` stay, blanks become ``%20``."""
    encoded = F.url_encode(value)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def join_tags(values: Column) -> Column:
    return F.concat_ws("; ", values)


def split_tags(joined: Column) -> Column:
    """Inverse of ``join_tags``; empty parts are dropped, null gives an empty list."""
    return F.filter(F.split(F.coalesce(joined, F.lit("")), "; "), lambda tag: tag != "")


def iso_date(value: Column) -> Column:
    return F.substring(value, 1, 10)


def all_digits(value: Column) -> Column:
    return value.rlike("^[0-9]+$")


def search_blob(*columns: Column) -> Column:
    """Lower-cased columns joined by single blanks.  A null column counts as empty but
    keeps its separator, so the position of later columns does not depend on it."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))


def text_ladder(summary: Column, description: Column, intro: Column, opening: Column) -> Column:
    """First non-empty text in the fixed order of preference."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (summary, description, intro, opening)])


def text_ladder_origin(
    summary: Column, description: Column, intro: Column, opening: Column
) -> Column:
    rungs = zip(fixed.TEXT_ORIGINS, (summary, description, intro, opening))
    tags = [F.when(F.nullif(c, F.lit("")).isNotNull(), F.lit(name)) for name, c in rungs]
    return F.coalesce(*tags, F.lit("none"))
