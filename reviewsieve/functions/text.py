"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewsieve.fixed_values import AMPERSAND_FORMS, ENTITIES

# All Unicode white space, including the four separators U+001C to U+001F that
# Java leaves out.
SPACE = r"\s\x1c-\x1f"

# Runs of white space other than one plain space. Leaving single spaces alone
# gives the same result as replacing every run, and most runs are single spaces.
UNTIDY_SPACE = rf"(?U)[[{SPACE}]&&[^ ]][{SPACE}]*| [{SPACE}]+"

MARKUP = r"<[^>]+>"

# Fixed patterns, applied in this order. A script or style that is never closed
# runs to the end of the text.
INVISIBLE_AND_TAGS = (
    r"(?s)<!--.*?-->",
    r"(?is)<script\b.*?(?:</script\s*>|\z)",
    r"(?is)<style\b.*?(?:</style\s*>|\z)",
    r"<[A-Za-z/!?][^>]*>",
)


def normalize_whitespace(text: Column) -> Column:
    """Collapse runs of white space to one space and trim both ends."""
    return F.trim(F.regexp_replace(text, UNTIDY_SPACE, " "))


def has_markup(text: Column) -> Column:
    """True where the text holds something that looks like a tag."""
    return F.contains(text, F.lit("<")) & F.rlike(text, F.lit(MARKUP))


def _decode_entities(text: Column) -> Column:
    for reference, character in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    for reference in AMPERSAND_FORMS:
        text = F.replace(text, F.lit(reference), F.lit("&"))
    return text


def _without_markup(text: Column) -> Column:
    for pattern in INVISIBLE_AND_TAGS:
        text = F.regexp_replace(text, pattern, " ")
    return text


def _where_references(raw: Column, decoded: Column, plain: Column) -> Column:
    """Decoding is left out for texts without `&`. The test is on the raw text,
    as a test on the stripped one would strip it a second time."""
    return F.when(F.contains(raw, F.lit("&")), decoded).otherwise(plain)


def strip_html(text: Column) -> Column:
    """Visible text: comments, scripts, styles and tags become spaces."""
    visible = _without_markup(text)
    return _where_references(text, _decode_entities(visible), visible)


def clean_html(text: Column) -> Column:
    """Decode character references first, then strip the markup.

    References that were escaped twice are decoded twice.
    """
    decoded = _decode_entities(_without_markup(_decode_entities(text)))
    return _where_references(text, decoded, _without_markup(text))


def normalize_review_text(text: Column) -> Column:
    """Null to empty; strip markup only where there is some; tidy white space."""
    stripped = F.when(has_markup(text), strip_html(text)).otherwise(text)
    return F.coalesce(normalize_whitespace(stripped), F.lit(""))


def normalize_for_duplicate(value: Column) -> Column:
    """Null to empty; tidy white space; markup is kept."""
    return F.coalesce(normalize_whitespace(value.cast("string")), F.lit(""))
