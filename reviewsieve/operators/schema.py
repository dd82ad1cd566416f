"""Schema inspection and validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.fixed_values import (
    METADATA_LIKE_FIELDS,
    RATING_ALIASES,
    REVIEW_LIKE_FIELDS,
    TEXT_ALIASES,
)
from reviewsieve.session import write_once


def find_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """The first candidate that is a column; both are compared without case and outer space.

    Where two columns fold to one name, the later one is taken.
    """
    rank = {_folded(alias): place for place, alias in reversed(list(enumerate(candidates)))}
    known = [(rank[_folded(c)], -place, c) for place, c in enumerate(columns) if _folded(c) in rank]
    return min(known)[2] if known else None


def _folded(name: str) -> str:
    return str(name).strip().lower()


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _is_present(field: T.StructField) -> Column:
    value = _quoted(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def _is_json(df: DataFrame) -> bool:
    """Whether the rows are JSON objects as they are (`read_json_records`), in one variant column."""
    return [type(f.dataType) for f in df.schema.fields] == [T.VariantType]


def _key_set(df: DataFrame) -> Column:
    """Names of the fields that are present in a row, sorted; of JSON objects whatever fields each has."""
    if _is_json(df):
        entries = F.map_filter(_quoted(df.columns[0]).cast("map<string,variant>"), lambda k, v: v.isNotNull() & ~F.is_variant_null(v))
        return F.array_sort(F.map_keys(entries))
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return F.array_compact(F.array(*[F.when(_is_present(f), F.lit(f.name)) for f in fields]))


def key_sets(
    df: DataFrame, max_records: int | None = None, order: str = "ingest_seq"
) -> DataFrame:
    """(key_set, records): how many records, or of the first ones in `order`, have exactly these fields."""
    rows = df if max_records is None else df.orderBy(order).limit(max_records)
    return rows.groupBy(_key_set(df).alias("key_set")).agg(F.count(F.lit(1)).alias("records"))


def _has(name: str) -> Column:
    return F.max(F.array_contains("key_set", name).cast("int"))


def schema_summary(df: DataFrame) -> DataFrame:
    """Row count, number and names of fields seen, number of key-sets."""
    if _is_json(df):
        fields = key_sets(df).select("records", F.posexplode_outer("key_set").alias("place", "field"))
        once = F.coalesce(F.col("place"), F.lit(0)) == 0
        summed = fields.agg(F.coalesce(F.sum(F.when(once, F.col("records"))), F.lit(0)).alias("total_rows"), F.count_if(once).alias("distinct_key_sets"), F.array_sort(F.collect_set("field")).alias("names"))
        return summed.select("total_rows", F.size("names").cast("long").alias("columns_seen_count"), F.array_join("names", ",").alias("columns_seen"), "distinct_key_sets")
    summed = key_sets(df).agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_key_sets"),
        F.array_compact(
            F.array(*[F.when(_has(c) == 1, F.lit(c)) for c in sorted(df.columns)])
        ).alias("columns_seen"),
    )
    return summed.select(
        "total_rows",
        F.size("columns_seen").cast("long").alias("columns_seen_count"),
        F.array_join("columns_seen", ",").alias("columns_seen"),
        "distinct_key_sets",
    )


def _most_common(sets: DataFrame, k: int) -> DataFrame:
    return sets.orderBy(F.desc("records"), F.asc("key_set")).limit(k)


def top_key_sets(df: DataFrame, k: int = 5) -> DataFrame:
    """The most common key-sets; equal counts are ordered by key-set."""
    return _most_common(key_sets(df), k)


def sometimes_absent_fields(df: DataFrame) -> DataFrame:
    """Fields seen somewhere that the most common key-set lacks."""
    sets = write_once(key_sets(df), "key-sets").data
    seen = sets.select(F.explode("key_set").alias("field"))
    usual = _most_common(sets, 1).select(F.explode("key_set").alias("field"))
    return seen.subtract(usual)


def field_presence(df: DataFrame) -> DataFrame:
    """(field, rows_present) of every field seen."""
    sets = write_once(key_sets(df), "key-sets").data
    return (
        sets.select(F.explode("key_set").alias("field"), "records")
        .groupBy("field")
        .agg(F.sum("records").alias("rows_present"))
    )


def _matches(fields: Iterable[str], known: Iterable[str]) -> list[str]:
    names = set(known)
    return sorted({c.strip().lower() for c in fields} & names)


def known_fields(df: DataFrame) -> DataFrame:
    """(field, kind, rows_present) of the fields that hint at a kind of data."""
    names = df.sparkSession.createDataFrame(
        [(name, "review") for name in REVIEW_LIKE_FIELDS]
        + [(name, "metadata") for name in METADATA_LIKE_FIELDS],
        "name string, kind string",
    )
    seen = field_presence(df).withColumn("name", F.lower(F.trim("field")))
    return seen.join(F.broadcast(names), "name").select("field", "kind", "rows_present")


def classify_dataset(df: DataFrame) -> DataFrame:
    """One row: known fields seen, and whether this is metadata or review data."""

    def names(kind: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.lower(F.trim("field")))))

    def any_of(aliases: Iterable[str]) -> Column:
        return F.coalesce(F.max(F.lower(F.trim("field")).isin(*aliases)), F.lit(False))

    found = known_fields(df).agg(
        names("review").alias("review"),
        names("metadata").alias("metadata"),
        any_of(TEXT_ALIASES).alias("has_text"),
        any_of(RATING_ALIASES).alias("has_rating"),
    )
    review, metadata = F.size("review"), F.size("metadata")
    return found.select(
        F.array_join("review", ",").alias("review_like_fields_found"),
        F.array_join("metadata", ",").alias("metadata_like_fields_found"),
        ((metadata > 0) & (review == 0)).alias("is_metadata_file"),
        ((review > 0) & F.col("has_text") & F.col("has_rating")).alias("is_review_data"),
    )


def validate_review_schema(
    df: DataFrame, text_col: str | None = None, rating_col: str | None = None
) -> DataFrame:
    """One-row report; raises when there is no text or no rating column."""
    text = text_col or find_column(df.columns, TEXT_ALIASES)
    rating = rating_col or find_column(df.columns, RATING_ALIASES)
    if text is None or text not in df.columns:
        raise ValueError("No review text column: the data may be metadata or use other names.")
    if rating is None or rating not in df.columns:
        raise ValueError("No rating column: the data does not look like rated reviews.")
    # The names of the report's columns.
    return df.sparkSession.createDataFrame(
        [
            (
                _matches(df.columns, REVIEW_LIKE_FIELDS),
                _matches(df.columns, METADATA_LIKE_FIELDS),
                text,
                rating,
                True,
            )
        ],
        "review_like_fields_found array<string>, metadata_like_fields_found array<string>, "
        "text_column string, rating_column string, is_valid_review_dataset boolean",
    )


def validate_required_columns(
    df: DataFrame, required: T.StructType | Iterable[str], name: str = ""
) -> DataFrame:
    """The same DataFrame, if its schema has the required names, and types where a schema is given.

    Raises before any job, with everything that does not fit.
    """
    typed = isinstance(required, T.StructType)
    wanted = {f.name: f.dataType for f in required.fields} if typed else dict.fromkeys(required)
    present = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for column, kind in wanted.items():
        if column not in present:
            faults.append(f"{column} is missing")
        elif kind is not None and present[column] != kind:
            faults.append(f"{column} is {present[column].simpleString()}, not {kind.simpleString()}")
    if faults:
        raise ValueError(f"{name or 'Data'} does not fit: {'; '.join(faults)}. Schema: {df.schema.simpleString()}")
    return df
