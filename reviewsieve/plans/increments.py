"""One increment: validate, drop what is known, count.

Hash, verdict and output all come from the one cleaning expression. The verdict on each row is worked out on narrow rows (order, reason, hash) and
written once. Whole reviews move at most once, in a join on the unique order
column, so neither copies nor a large store skew that shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewsieve.operators.language import LanguageModel
from reviewsieve.operators.quality import pipeline_stats
from reviewsieve.operators.store import DedupeStore, Version, unknown_keys
from reviewsieve.operators.validation import (
    attach_language,
    check_text_and_rating,
    clean_columns,
)
from reviewsieve.session import WrittenTable, write_once


@dataclass(frozen=True)
class Increment:
    """Clean rows, the hashes to store, one row of statistics, scratch tables.

    The hashes are new in `seen`, the version of the store that they were compared with.
    """

    clean: DataFrame
    hashes: DataFrame
    stats: DataFrame
    tables: tuple[WrittenTable, ...]
    clean_rows: int = 0
    seen: Version | None = None

    def release(self) -> None:
        """Remove the scratch tables once all results have been written."""
        for table in self.tables:
            table.remove()


@dataclass(frozen=True)
class ReviewColumns:
    """Names of the columns that an increment reads."""

    text: str = "text"
    rating: str = "rating"
    title: str = "title"
    asin: str = "asin"
    user_id: str = "user_id"


def cleaned(df: DataFrame, names: ReviewColumns) -> DataFrame:
    """Reviews with `_reason` of the cheap checks, the cleaned columns and the hash."""
    checked = check_text_and_rating(df, names.text, names.rating)
    return clean_columns(checked, F.col("_text"), F.col("_rating"), names.rating, names.title, names.asin, names.user_id)


def decide_reviews(
    df: DataFrame,
    model: LanguageModel | None,
    names: ReviewColumns = ReviewColumns(),
    order: str = "ingest_seq",
) -> DataFrame:
    """(order, reason, review_hash) of each review; the hash is null if rejected."""
    judged = attach_language(cleaned(df, names).select(order, "_text", "_reason", "review_hash"), model)
    valid = F.col("_reason").isNull()
    return judged.select(
        order,
        F.col("_reason").alias("reason"),
        F.when(valid, F.col("review_hash")).alias("review_hash"),
    )


def preprocess_increment(
    df: DataFrame,
    store: DedupeStore | None,
    model: LanguageModel | None,
    run_id: str = "",
    batch_id: int = 0,
    names: ReviewColumns = ReviewColumns(),
    order: str = "ingest_seq",
) -> Increment:
    """Clean rows of a batch that no earlier batch has stored.

    Hashes stored by this very batch do not count as known, so a batch that
    failed half-way gives the same result when it is tried again. Without a
    store, only repeats within the batch are dropped.
    """
    decided = write_once(decide_reviews(df, model, names, order), "decided")
    firsts = write_once(
        decided.data.where(F.col("reason").isNull())
        .groupBy("review_hash")
        .agg(F.min(order).alias(order)),
        "first-of-hash",
    )
    tables, fresh, seen = (decided, firsts), firsts, None
    if store is not None:
        seen = store.version()
        fresh = write_once(unknown_keys(firsts, store.candidates(firsts.data, run_id, batch_id)), "fresh")
        tables = (decided, firsts, fresh)
    kept = df.join(fresh.sized_for_join().select(order), order)
    clean = cleaned(kept, names).select(*df.columns, "text_normalized", "title_normalized", "review_hash")
    stats = pipeline_stats(decided.data, F.lit(fresh.rows))
    return Increment(clean, fresh.data.select("review_hash"), stats, tables, fresh.rows, seen)
