"""Statistics and quality gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.fixed_values import MIN_REVIEW_COUNT, REASONS


def pipeline_stats(
    decided: DataFrame,
    clean_records: Column | None = None,
    reasons: tuple[str, ...] = REASONS,
    reason_col: str = "reason",
    hash_col: str = "review_hash",
) -> DataFrame:
    """One row: inputs, one count per reason, valid, duplicate and clean rows.

    `decided` has a reason (null when valid) and a hash per review. Without
    `clean_records`, every distinct hash among the valid rows counts as clean.
    """
    valid = F.col(reason_col).isNull()
    clean = clean_records
    if clean is None:
        clean = F.count_distinct(F.when(valid, F.col(hash_col)))
    counted = decided.agg(
        F.count(F.lit(1)).alias("input_records"),
        *[F.count_if(F.col(reason_col) == reason).alias(reason) for reason in reasons],
        F.count_if(valid).alias("valid_before_deduplication"),
        clean.cast("long").alias("clean_records"),
    )
    duplicates = F.col("valid_before_deduplication") - F.col("clean_records")
    return counted.select(
        "input_records",
        *reasons,
        "valid_before_deduplication",
        duplicates.alias("duplicate_records"),
        "clean_records",
    )


def accumulate_stats(stats: DataFrame, batch_columns=("run_id", "batch_id")) -> DataFrame:
    """Totals over the batches and their number."""
    counters = [c for c in stats.columns if c not in batch_columns]
    return stats.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counters],
        F.count(F.lit(1)).alias("chunks_processed"),
    )


def data_sufficiency(df: DataFrame, minimum: int = MIN_REVIEW_COUNT) -> DataFrame:
    """Whether there are enough reviews, and how many are missing."""
    least = F.lit(minimum).cast("long")
    return df.agg(F.count(F.lit(1)).alias("valid_review_count")).select(
        "valid_review_count",
        least.alias("minimum_required"),
        (F.col("valid_review_count") >= least).alias("is_sufficient"),
        F.greatest(F.lit(0).cast("long"), least - F.col("valid_review_count")).alias("deficit"),
    )


def reconcile(
    stats: DataFrame,
    clean_rows: DataFrame,
    stored_rows: DataFrame,
    expected_input: Column | int | None = None,
    minimum: int = MIN_REVIEW_COUNT,
    reasons: tuple[str, ...] = REASONS,
) -> DataFrame:
    """One row of checks that tie the counters to the rows actually written.

    The three inputs are counted on their own and brought together as labelled
    rows, so no table is joined.
    """
    counters = [c for c in stats.columns if c in set(reasons)] + [
        "input_records",
        "valid_before_deduplication",
        "duplicate_records",
        "clean_records",
    ]
    totals = stats.select(*[F.col(c).cast("long").alias(c) for c in counters])

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    rows = (
        totals.unionByName(counted(clean_rows, "output_rows"), allowMissingColumns=True)
        .unionByName(counted(stored_rows, "stored_hashes"), allowMissingColumns=True)
    )
    flat = rows.agg(*[F.sum(c).alias(c) for c in counters + ["output_rows", "stored_hashes"]])
    rejected = sum((F.col(r) for r in counters if r in set(reasons)), F.lit(0))
    valid, clean = F.col("valid_before_deduplication"), F.col("clean_records")
    expected = F.col("input_records") if expected_input is None else expected_input
    return flat.select(
        (clean == F.col("output_rows")).alias("clean_equals_output"),
        (F.col("stored_hashes") == clean).alias("stored_equals_clean"),
        ((clean <= valid) & (valid <= F.col("input_records"))).alias("counts_ordered"),
        (clean > minimum).alias("enough_clean"),
        (F.col("input_records") == expected).alias("input_as_expected"),
        (F.col("input_records") == rejected + valid).alias("input_accounted_for"),
        (valid == clean + F.col("duplicate_records")).alias("valid_accounted_for"),
        F.col("stored_hashes"),
        clean.alias("clean_records"),
    )
