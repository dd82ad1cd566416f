"""Column functions built from Spark expressions only."""

from reviewsieve.functions.identity import key_digest, review_hash
from reviewsieve.functions.rating import validate_rating
from reviewsieve.functions.text import (
    clean_html,
    has_markup,
    normalize_for_duplicate,
    normalize_review_text,
    normalize_whitespace,
    strip_html,
)

__all__ = [
    "clean_html",
    "has_markup",
    "key_digest",
    "normalize_for_duplicate",
    "normalize_review_text",
    "normalize_whitespace",
    "review_hash",
    "strip_html",
    "validate_rating",
]
