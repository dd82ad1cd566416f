"""Duplicates within a batch.

A window over the key would send every copy of a review to one task together
with its whole row. Here only digests are grouped, with partial aggregation, so
a key that holds a third of the rows shrinks to one row per task before the
shuffle. The groups that have copies are then looked up from the rows.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.functions import key_digest, normalize_for_duplicate, validate_rating
from reviewsieve.session import BROADCAST_ROWS, WrittenTable, write_once

REVIEW_KEYS = ("asin", "user_id", "rating", "title_normalized", "text_normalized")


def add_duplicate_keys(df: DataFrame) -> DataFrame:
    """Bring raw reviews to the form in which they are compared."""
    return df.withColumns(
        {
            "rating": validate_rating(F.col("rating")),
            "title_normalized": normalize_for_duplicate(F.col("title")),
            "text_normalized": normalize_for_duplicate(F.col("text")),
        }
    )


def _key_columns(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def group_sizes(df: DataFrame, key: Column, order: str) -> DataFrame:
    """(_key, _first, _copies) of each key."""
    return (
        df.select(key.alias("_key"), F.col(order).alias("_order"))
        .groupBy("_key")
        .agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    )


def attach_groups(
    df: DataFrame, groups: WrittenTable, how: str = "left", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join rows that have a `_key` with their group's `_first` and `_copies`.

    Few groups are broadcast and the rows do not move. Otherwise the groups are
    split at a size that at most `limit` groups can reach: N rows hold no more
    than N / size groups of that size. The large groups are broadcast, and the
    shuffled join is left with groups of bounded size, hence without hot keys.
    """
    if groups.rows <= limit:
        return df.join(F.broadcast(groups.data), "_key", how)
    members = groups.data.agg(F.sum("_copies")).first()[0]
    large = ceil(members / limit)
    hot = F.broadcast(groups.data.where(F.col("_copies") >= large))
    cold = groups.data.where(F.col("_copies") < large)
    from_hot = df.join(hot, "_key", "inner")
    from_cold = df.join(hot, "_key", "left_anti").join(cold, "_key", how)
    return from_hot.unionByName(from_cold)


def _copied_groups(df: DataFrame, key: Column, order: str) -> WrittenTable:
    copied = group_sizes(df, key, order).where(F.col("_copies") > 1)
    return write_once(copied, "copied-groups")


def _marked(df: DataFrame, keys, order: str, how: str) -> DataFrame:
    key = key_digest(_key_columns(keys))
    groups = _copied_groups(df, key, order)
    return attach_groups(df.withColumn("_key", key), groups, how)


def drop_duplicate_reviews(
    df: DataFrame, keys=REVIEW_KEYS, order: str = "ingest_seq"
) -> DataFrame:
    """Keep the first row of each key in `order`, which must be unique."""
    marked = _marked(df, keys, order, "left")
    first = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
    return marked.where(first).select(*df.columns)


def duplicate_mask(
    df: DataFrame, keys=REVIEW_KEYS, order: str = "ingest_seq", keep: str = "first"
) -> DataFrame:
    """Add `is_duplicate`: later copies, or with `keep="none"` every copy."""
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    marked = _marked(df, keys, order, "left")
    copied = F.col("_first").isNotNull()
    flag = copied & (F.col(order) != F.col("_first")) if keep == "first" else copied
    return marked.withColumn("is_duplicate", F.coalesce(flag, F.lit(False))).select(
        *df.columns, "is_duplicate"
    )


def duplicate_groups(
    df: DataFrame, keys=REVIEW_KEYS, order: str = "ingest_seq"
) -> DataFrame:
    """Every member of a group with more than one row, with its `copies`."""
    marked = _marked(df, keys, order, "inner")
    return marked.select(*df.columns, F.col("_copies").alias("copies"))


def duplicate_report(df: DataFrame, keys=REVIEW_KEYS) -> DataFrame:
    """Row counts before and after removing duplicates, and the difference."""
    sizes = (
        df.select(key_digest(_key_columns(keys)).alias("_key"))
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    total = F.coalesce(F.sum("_copies"), F.lit(0))
    return sizes.agg(
        total.alias("before_count"),
        (total - F.count(F.lit(1))).alias("removed_count"),
        F.count(F.lit(1)).alias("after_count"),
    )


def hash_uniqueness(df: DataFrame, hash_col: str = "review_hash") -> DataFrame:
    """Number of rows, of distinct hashes, and of rows that repeat one."""
    sizes = df.groupBy(hash_col).agg(F.count(F.lit(1)).alias("_copies"))
    total = F.coalesce(F.sum("_copies"), F.lit(0))
    distinct = F.count(hash_col)
    return sizes.agg(
        total.alias("total_rows"),
        distinct.alias("unique_hashes"),
        (total - distinct).alias("repeated_rows"),
    )
