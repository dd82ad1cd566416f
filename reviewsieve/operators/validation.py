"""Record validation and preprocessing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.fixed_values import (
    EMPTY_OR_TOO_SHORT,
    EMPTY_TEXT,
    INVALID_RATING,
    KEEP_UNDETECTABLE,
    MIN_TEXT_LENGTH,
    MISSING_TEXT,
    NON_ENGLISH,
    TARGET_LANGUAGE,
    UNDETECTABLE_LANGUAGE,
)
from reviewsieve.functions import normalize_review_text, review_hash, validate_rating
from reviewsieve.operators.language import LanguageModel, language_accepted, language_of


def _text_reason(raw: Column, normalized: Column, split_missing: bool) -> Column:
    too_short = F.when(F.length(normalized) < MIN_TEXT_LENGTH, F.lit(EMPTY_OR_TOO_SHORT))
    if not split_missing:
        return too_short
    missing = F.when(raw.isNull(), F.lit(MISSING_TEXT)).when(
        normalized == "", F.lit(EMPTY_TEXT)
    )
    return F.coalesce(missing, too_short)


def check_text_and_rating(
    df: DataFrame, text_col: str = "text", rating_col: str = "rating", split_missing: bool = False
) -> DataFrame:
    """Add `_text`, `_rating` and `_reason` from the checks that need no other row."""
    # Generated rather than projected, so that no filter or column above repeats the cleaning.
    cleaned = F.struct(
        normalize_review_text(F.col(text_col).cast("string")).alias("_text"),
        validate_rating(F.col(rating_col)).alias("_rating"),
    )
    normalized = df.select("*", F.explode(F.array(cleaned)).alias("_checked")).select(
        *df.columns, "_checked.*"
    )
    reason = F.coalesce(
        _text_reason(F.col(text_col), F.col("_text"), split_missing),
        F.when(F.col("_rating").isNull(), F.lit(INVALID_RATING)),
    )
    return normalized.withColumn("_reason", reason)


def attach_language(
    checked: DataFrame,
    model: LanguageModel | None,
    target: str = TARGET_LANGUAGE,
    keep_undetectable: bool = KEEP_UNDETECTABLE,
) -> DataFrame:
    """Add `_language` and complete `_reason`, row by row.

    Rows that failed a cheaper check give a null text to detection, which costs nothing.
    Without a model the language check is off and every other row has the target.
    """
    passed = F.col("_reason").isNull()
    if model is None:
        return checked.withColumn("_language", F.when(passed, F.lit(target)))
    language = language_of(F.when(passed, F.col("_text")), model, checked.sparkSession)
    judged = checked.withColumn("_language", language)
    language_reason = F.when(
        passed & ~language_accepted(F.col("_language"), target, keep_undetectable),
        F.when(F.col("_language").isNull(), F.lit(UNDETECTABLE_LANGUAGE)).otherwise(
            F.lit(NON_ENGLISH)
        ),
    )
    return judged.withColumn("_reason", F.coalesce(F.col("_reason"), language_reason))


def validate_reviews(
    df: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    rating_col: str = "rating",
    split_missing: bool = False,
    target: str = TARGET_LANGUAGE,
    keep_undetectable: bool = KEEP_UNDETECTABLE,
) -> DataFrame:
    """Add a `validation` struct; the first failed check gives the reason.

    Fields of checks that come after the failed one are null.
    """
    checked = check_text_and_rating(df, text_col, rating_col, split_missing)
    judged = attach_language(checked, model, target, keep_undetectable)
    text_failed = F.length("_text") < MIN_TEXT_LENGTH
    validation = F.struct(
        F.col("_reason").isNull().alias("valid"),
        F.col("_reason").alias("reason"),
        F.col("_text").alias("normalized_text"),
        F.when(~text_failed, F.col("_rating")).alias("normalized_rating"),
        F.col("_language").alias("detected_language"),
    )
    return judged.withColumn("validation", validation).select(*df.columns, "validation")


def clean_columns(
    df: DataFrame,
    text: Column,
    rating: Column,
    rating_col: str = "rating",
    title_col: str = "title",
    asin_col: str = "asin",
    user_id_col: str = "user_id",
) -> DataFrame:
    """Add the normalized text and title and the hash; overwrite the rating."""
    return df.withColumns(
        {
            "text_normalized": text,
            "title_normalized": normalize_review_text(F.col(title_col).cast("string")),
            rating_col: rating,
        }
    ).withColumn(
        "review_hash",
        review_hash(
            F.col(asin_col),
            F.col(user_id_col),
            F.col(rating_col),
            F.col("title_normalized"),
            F.col("text_normalized"),
            tidy=True,
        ),
    )


def preprocess_reviews(
    df: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    rating_col: str = "rating",
    title_col: str = "title",
    asin_col: str = "asin",
    user_id_col: str = "user_id",
) -> DataFrame:
    """Valid reviews with `text_normalized`, `title_normalized`, `review_hash`."""
    judged = attach_language(check_text_and_rating(df, text_col, rating_col), model)
    valid = judged.where(F.col("_reason").isNull())
    cleaned = clean_columns(
        valid, F.col("_text"), F.col("_rating"), rating_col, title_col, asin_col, user_id_col
    )
    return cleaned.drop("_text", "_rating", "_reason", "_language")


def rejected_reviews(
    df: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    rating_col: str = "rating",
    split_missing: bool = False,
) -> DataFrame:
    """Invalid reviews with their `reason`."""
    checked = check_text_and_rating(df, text_col, rating_col, split_missing)
    judged = attach_language(checked, model)
    return judged.where(F.col("_reason").isNotNull()).select(
        *df.columns, F.col("_reason").alias("reason")
    )
