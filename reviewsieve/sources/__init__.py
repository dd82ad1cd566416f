"""Readers and writers."""

from reviewsieve.sources.readers import (
    RAW_REVIEW_SCHEMA,
    detect_file_format,
    read_csv,
    read_json_document,
    read_json_records,
    read_jsonl,
    read_reviews,
    read_reviews_stream,
    read_uploaded_data,
    with_ingest_seq,
)
from reviewsieve.sources.writers import append_clean, read_clean, save_dataframe

__all__ = [
    "RAW_REVIEW_SCHEMA",
    "append_clean",
    "detect_file_format",
    "read_clean",
    "read_csv",
    "read_json_document",
    "read_json_records",
    "read_jsonl",
    "read_reviews",
    "read_reviews_stream",
    "read_uploaded_data",
    "save_dataframe",
    "with_ingest_seq",
]
