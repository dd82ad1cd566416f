"""Profiles of a review table. Each is one aggregation over the columns it reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.fixed_values import (
    RATING_ALIASES,
    REVIEW_LIKE_FIELDS,
    TARGET_LANGUAGE,
    TEXT_ALIASES,
)
from reviewsieve.functions import has_markup, normalize_whitespace
from reviewsieve.operators.language import LanguageModel, detect_language
from reviewsieve.operators.schema import _key_set, find_column


def first_rows(df: DataFrame, n: int, order: str = "ingest_seq") -> DataFrame:
    """The first `n` rows in `order`."""
    return df.orderBy(order).limit(n)


def rating_distribution(df: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Counts of the raw rating values, nulls left out, in ascending order."""
    return (
        df.where(F.col(rating_col).isNotNull())
        .groupBy(rating_col)
        .agg(F.count(F.lit(1)).alias("reviews"))
        .orderBy(rating_col)
    )


def _is_blank(text: Column) -> Column:
    return normalize_whitespace(text) == ""


def text_missing_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Null and blank texts, as counts and as shares of all rows."""
    text = F.col(text_col)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(text.isNull()).alias("null_count"),
        F.count_if(_is_blank(text)).alias("blank_count"),
    )
    return counted.withColumns(
        {
            "null_share": F.try_divide("null_count", "total_rows"),
            "blank_share": F.try_divide("blank_count", "total_rows"),
        }
    )


def column_null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count), from one pass."""
    names = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "null_count")


def seeded_sample(df: DataFrame, n: int, key: str = "ingest_seq", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones however the data is partitioned."""
    ticket = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    return df.orderBy(ticket, key).limit(n)


def language_estimate(
    df: DataFrame,
    model: LanguageModel,
    n: int = 1000,
    text_col: str = "text",
    key: str = "ingest_seq",
    seed: int = 42,
) -> DataFrame:
    """Non-English and undetectable texts in a sample of the non-empty ones."""
    texts = df.where(F.length(text_col) > 0).select(key, text_col)
    detected = detect_language(seeded_sample(texts, n, key, seed), text_col, model)
    counted = detected.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.count_if(F.col("language") != TARGET_LANGUAGE).alias("non_english"),
        F.count_if(F.col("language").isNull()).alias("undetectable"),
    )
    return counted.withColumns(
        {
            "non_english_share": F.try_divide("non_english", "sample_size"),
            "undetectable_share": F.try_divide("undetectable", "sample_size"),
        }
    )


def html_rate(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Texts that hold something like a tag, as count and share."""
    marked = F.coalesce(has_markup(F.col(text_col)), F.lit(False))
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(marked).alias("html_count")
    )
    return counted.withColumn("html_share", F.try_divide("html_count", "total_rows"))


def html_examples(
    df: DataFrame, n: int = 10, text_col: str = "text", order: str = "ingest_seq"
) -> DataFrame:
    """The first `n` texts with markup."""
    marked = df.where(has_markup(F.col(text_col))).select(order, text_col)
    return marked.orderBy(order).limit(n)


def exploration_summary(df: DataFrame) -> DataFrame:
    """One row with the main findings, from one pass over the data."""
    text = find_column(df.columns, TEXT_ALIASES)
    rating = find_column(df.columns, RATING_ALIASES)
    hits = {c.strip().lower() for c in df.columns} & set(REVIEW_LIKE_FIELDS)
    missing = F.lit(False)
    if text is not None:
        missing = F.col(text).isNull() | _is_blank(F.col(text).cast("string"))
    by_key_set = df.groupBy(_key_set(df).alias("key_set")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(missing).alias("missing")
    )
    counted = by_key_set.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_key_sets"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("null_or_blank_text"),
    )
    return counted.select(
        "total_rows",
        "distinct_key_sets",
        F.lit(rating).cast("string").alias("rating_column"),
        F.lit(text).cast("string").alias("text_column"),
        "null_or_blank_text",
        F.try_divide("null_or_blank_text", "total_rows").alias("null_or_blank_share"),
        F.lit(bool(hits) and text is not None and rating is not None).alias("is_review_data"),
    )
