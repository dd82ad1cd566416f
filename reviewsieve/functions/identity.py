"""Review hash and key digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewsieve.functions.text import SPACE, normalize_for_duplicate

OUTER_SPACE = rf"(?U)^[{SPACE}]+|[{SPACE}]+\z"


def _stripped(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.regexp_replace(text, OUTER_SPACE, "")


def _never_null(digest: Column) -> Column:
    """State that a digest has a value, which saves joins a check that computes it again."""
    return F.coalesce(digest, F.lit(""))


def review_hash(
    asin: Column,
    user_id: Column,
    rating: Column,
    title: Column,
    text: Column,
    tidy: bool = False,
) -> Column:
    """SHA-256 of the canonical form of a review; null parts count as empty.

    `tidy=True` states that title and text are normalized already, which saves
    a second pass over them.
    """
    if not tidy:
        title, text = normalize_for_duplicate(title), normalize_for_duplicate(text)
    parts = {
        "asin": _stripped(asin),
        "user_id": _stripped(user_id),
        "rating": _stripped(rating),
        "title": title,
        "text": text,
    }
    labelled = [
        F.concat(F.lit(("|" if i else "") + name + "="), value)
        for i, (name, value) in enumerate(parts.items())
    ]
    return _never_null(F.sha2(F.concat(*labelled), 256))


def key_digest(keys: list[Column]) -> Column:
    """32-byte digest of a composite key in which nulls equal each other.

    Each part carries its length, so no two different keys share an encoding.
    Shuffles then move 32 bytes per row and not the key's text.
    """
    encoded = [
        F.coalesce(
            F.concat(F.length(k.cast("string")).cast("string"), F.lit(":"), k.cast("string")),
            F.lit("-"),
        )
        for k in keys
    ]
    digest = F.sha2(reduce(lambda a, b: F.concat(a, b), encoded), 256)
    return F.coalesce(F.unhex(digest), F.lit(b""))
