"""Registered queries: each operator on the driver's tables.

Every query reads whole tables. Intermediate files (JSON lines, CSV, stores,
stream output) are written by Spark from those tables to the scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from reviewsieve.fixed_values import RATING_ALIASES, TEXT_ALIASES
from reviewsieve.functions import (
    clean_html,
    normalize_for_duplicate,
    normalize_review_text,
    normalize_whitespace,
    review_hash,
    strip_html,
    validate_rating,
)
from reviewsieve.operators import dedupe, language, profiling, quality, schema, validation
from reviewsieve.operators.language import LanguageModel
from reviewsieve.operators.store import DedupeStore, known_hashes, new_hashes
from reviewsieve.plans.increments import preprocess_increment
from reviewsieve.plans.review_view import reviews
from reviewsieve.session import scratch_path, spread, write_once
from reviewsieve.sources import (
    append_clean,
    read_clean,
    read_csv,
    read_json_document,
    read_json_records,
    read_jsonl,
    read_reviews,
    read_reviews_stream,
    read_uploaded_data,
    save_dataframe,
)
from reviewsieve.streaming import StreamProgress, read_stats, run_keyed_stream, run_preprocess_stream, stream_progress

Query = Callable[[SparkSession, str], DataFrame]

# Increments in which the streaming queries get their input.
INCREMENTS = 3

_models: dict[tuple[str, str], LanguageModel] = {}


KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), KEYS[name])


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with one unique order column, a struct of conversation and turn."""
    order = F.struct("conv_id", "turn").alias("ingest_seq")
    return _table(spark, sf_dir, "conversations").select(order, "text")


def trained_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """Model from the labelled documents, trained once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = language.train_language_model(_table(spark, sf_dir, "documents"))
    return _models[key]


def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.preprocess_reviews(reviews(spark, sf_dir), trained_model(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid reviews without duplicates."""
    model = trained_model(spark, sf_dir)
    return preprocess_increment(reviews(spark, sf_dir), None, model).clean


# --- Sources and sinks -----------------------------------------------------------------


def _written(df: DataFrame, extension: str) -> str:
    path = scratch_path(df.sparkSession, "files") + extension
    save_dataframe(df, path)
    return path


def read_jsonl_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir)
    return read_jsonl(spark, _written(raw, ".jsonl"), raw.schema)


def read_csv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir)
    return read_csv(spark, _written(raw, ".csv"), raw.schema)


def read_reviews_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_reviews(spark, f"{sf_dir}/documents.parquet")


def read_json_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in files named `.json`."""
    raw = reviews(spark, sf_dir)
    return read_reviews(spark, _written(raw, ".json"), raw.schema, layout="lines")


# Documents in one file of the document query. The files of each layout are equal in number.
RECORDS_IN_FILE = 50


def read_json_document_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all layouts side by side: arrays, two wrappers, single objects."""
    raw = reviews(spark, sf_dir)
    path = scratch_path(spark, "documents") + ".json"
    # Of the fourth layout a file is a document, so one of each group; its others join the arrays.
    place = F.col("ingest_seq") % (4 * RECORDS_IN_FILE)
    kind, record = F.when(place == 3, 3).when(F.col("ingest_seq") % 4 == 3, 0).otherwise(F.col("ingest_seq") % 4), F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    one = raw.where(kind == 3).select(record.alias("value"))
    several = (
        raw.where(kind < 3)
        .groupBy(F.floor(F.col("ingest_seq") / (4 * RECORDS_IN_FILE)), kind.alias("kind"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("items"))
    )
    wrapped = F.when(F.col("kind") == 0, F.col("items")).when(F.col("kind") == 1, F.concat(F.lit('{"reviews": '), "items", F.lit(', "n": 1}')))
    wrapped = F.coalesce(wrapped, F.concat(F.lit('{"source": "x", "items":\n'), "items", F.lit("}")))
    # One value in each file.
    values = several.select(wrapped.alias("value")).union(one)
    values.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return read_json_document(spark, path, raw.schema)


def stream_read_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines through a stream, a few files at a time."""
    raw = reviews(spark, sf_dir)
    out = scratch_path(spark, "streamed")
    stream = read_reviews_stream(spark, _written(raw, ".jsonl"), raw.schema, files_per_trigger=2).drop("_file_place")
    started = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "offsets")).trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(raw.schema).parquet(out)


def read_uploaded_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir)
    return read_uploaded_data(spark, _written(raw, ".json"), raw.schema)


def save_dataframe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return spark.read.schema(turns.schema).json(_written(turns, ".jsonl"))


def append_clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one run, read back together."""
    clean = write_once(clean_reviews(spark, sf_dir), "clean-rows").data
    path = scratch_path(spark, "clean")
    append_clean(clean.where("verified_purchase"), path, "load", 0)
    append_clean(clean.where("NOT verified_purchase"), path, "load", 1)
    iso = clean.withColumn("timestamp", F.lit("")).schema
    return read_clean(spark, path, iso, "load").select(
        "ingest_seq", "rating", "text_normalized", "title_normalized", "review_hash", "timestamp"
    )


# --- Schema and profiles ---------------------------------------------------------------


def _joined_keys(sets: DataFrame) -> DataFrame:
    return sets.withColumn("key_set", F.array_join("key_set", ","))


def absent_label_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, which only some of them have."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return schema.sometimes_absent_fields(documents.join(labels, "doc_id", "left"))


def _open_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as JSON lines, without null fields and each with a field named by its source; no schema says which."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labelled = documents.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left")
    path = scratch_path(spark, "records")
    fixed = F.to_json(F.struct(*labelled.columns))
    named = F.concat(F.expr("substr(fixed, 1, length(fixed) - 1)"), F.lit(',"'), "source", F.lit('":[1]}'))
    labelled.withColumn("fixed", fixed).select(F.coalesce(named, "fixed").alias("value")).write.text(path)
    return read_json_records(spark, path)


def event_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return profiling.rating_distribution(events, "event_type")


def _found_columns(df: DataFrame) -> dict[str, str | None]:
    return {"text_column": schema.find_column(df.columns, TEXT_ALIASES), "rating_column": schema.find_column(df.columns, RATING_ALIASES)}


def find_column_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns found in three tables, with the values they hold."""
    tables = {"conversations": _table(spark, sf_dir, "conversations"), "pages": _table(spark, sf_dir, "pages"), "reviews": reviews(spark, sf_dir)}
    reports = []
    for name, df in tables.items():
        found = _found_columns(df)
        reports.append(
            df.agg(*[(F.count(c) if c else F.lit(0).cast("long")).alias(k.replace("column", "values")) for k, c in found.items()]).select(
                F.lit(name).alias("table_name"), *[F.lit(c).cast("string").alias(k) for k, c in found.items()], "text_values", "rating_values"
            )
        )
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def validate_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir)
    report = schema.validate_review_schema(raw).first().asDict()
    return raw.agg(F.count(F.lit(1)).alias("records")).select(
        "records",
        F.lit(",".join(report["review_like_fields_found"])).alias("review_like"),
        F.lit(",".join(report["metadata_like_fields_found"])).alias("metadata_like"),
        F.lit(report["text_column"]).alias("text_column"),
        F.lit(report["rating_column"]).alias("rating_column"),
        F.lit(report["is_valid_review_dataset"]).alias("is_valid"),
    )


def required_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a checked schema, counted by type."""
    events = schema.validate_required_columns(spark.read.parquet(f"{sf_dir}/events.parquet"), ["event_id", "event_type"], "events")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


# --- Validation ------------------------------------------------------------------------


def _validated(spark: SparkSession, sf_dir: str, split_missing: bool = False) -> DataFrame:
    return validation.validate_reviews(
        reviews(spark, sf_dir), trained_model(spark, sf_dir), split_missing=split_missing
    ).select("ingest_seq", "validation.*")


def rejection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("reviews"))


# --- Duplicates and the store ----------------------------------------------------------


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("ingest_seq", *dedupe.REVIEW_KEYS)
    return dedupe.add_duplicate_keys(reviews(spark, sf_dir)).select(*columns)


def _hashed_and_stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DedupeStore]:
    """All clean reviews, and a store with the hashes of those that are verified purchases."""
    columns = ("ingest_seq", "review_hash", "verified_purchase")
    clean = write_once(clean_reviews(spark, sf_dir).select(*columns), "clean-keys").data
    store = DedupeStore(spark, scratch_path(spark, "store")).create()
    store.insert(clean.where("verified_purchase").select("review_hash").distinct(), "load", 0)
    return clean.select("ingest_seq", "review_hash"), store


def _loaded(spark: SparkSession, sf_dir: str):
    """A store after two increments: verified purchases, then all reviews."""
    store = DedupeStore(spark, scratch_path(spark, "store")).create()
    model = trained_model(spark, sf_dir)
    raw = reviews(spark, sf_dir)
    increments = []
    for batch_id, rows in enumerate((raw.where("verified_purchase"), raw)):
        increment = preprocess_increment(rows, store, model, "load", batch_id)
        store.insert_absent(increment.hashes, "load", batch_id, increment.seen)
        increments.append(increment)
    return store, increments


def store_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _loaded(spark, sf_dir)
    return store.listing().select("review_hash", "run_id", "batch_id")


def increment_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, increments = _loaded(spark, sf_dir)
    return increments[1].clean.select(
        "ingest_seq", "rating", "text_normalized", "title_normalized", "review_hash"
    )


def increment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, increments = _loaded(spark, sf_dir)
    return increments[1].stats


# --- Quality ---------------------------------------------------------------------------


def _whole(spark: SparkSession, sf_dir: str):
    """One increment with all reviews into an empty store."""
    store = DedupeStore(spark, scratch_path(spark, "store")).create()
    increment = preprocess_increment(
        reviews(spark, sf_dir), store, trained_model(spark, sf_dir), "whole", 0
    )
    store.insert(increment.hashes, "whole", 0)
    return store, increment


def record_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(spark, sf_dir)[1].stats


def accumulate_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, (first, second) = _loaded(spark, sf_dir)
    return quality.accumulate_stats(first.stats.unionByName(second.stats))


def reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, increment = _whole(spark, sf_dir)
    expected = _table(spark, sf_dir, "documents").count()
    return quality.reconcile(increment.stats, increment.clean, store.read(), expected)


# --- Streams ---------------------------------------------------------------------------


def _in_increments(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land all reviews in three parts of any number of files, and let the stream take each as one increment."""
    raw = reviews(spark, sf_dir)
    source = scratch_path(spark, "landing")
    for increment in range(INCREMENTS):
        raw.where(F.col("ingest_seq") % INCREMENTS == increment).write.mode("append").json(source)
        start(read_reviews_stream(spark, source, raw.schema, files_per_trigger=10**6)).awaitTermination()


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stream all reviews against a store; the folders of rows and counters."""
    out, stats, offsets = (scratch_path(spark, name) for name in ("clean", "stats", "offsets"))
    store, model = DedupeStore(spark, scratch_path(spark, "store")), trained_model(spark, sf_dir)
    _in_increments(spark, sf_dir, lambda source: run_preprocess_stream(source, out, store, "stream", offsets, stats, model))
    return out, stats


def _keyed_stream(spark: SparkSession, sf_dir: str) -> tuple[str, StreamProgress]:
    """Stream all reviews with the known hashes in state; the folder of rows, and what a listener saw."""
    out, offsets = scratch_path(spark, "clean"), scratch_path(spark, "offsets")
    model, progress = trained_model(spark, sf_dir), StreamProgress()
    spark.streams.addListener(progress)
    try:
        _in_increments(spark, sf_dir, lambda source: run_keyed_stream(source, out, "keyed", offsets, model))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(progress)
    return out, progress


def keyed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _keyed_stream(spark, sf_dir)
    columns = ("ingest_seq", "review_hash", "rating", "title_normalized", "text_normalized")
    return read_clean(spark, out, clean_reviews(spark, sf_dir).select(*columns).schema, "keyed").select(*columns, "batch_id")


def listener_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener saw of each increment; the state then holds all hashes so far."""
    return _keyed_stream(spark, sf_dir)[1].frame(spark)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _streamed(spark, sf_dir)
    columns = ("review_hash", "asin", "user_id", "rating", "title_normalized", "text_normalized")
    schema = clean_reviews(spark, sf_dir).select(*columns).schema
    return read_clean(spark, out, schema, "stream").select(*columns)


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats = _streamed(spark, sf_dir)
    totals = quality.accumulate_stats(read_stats(spark, stats, "stream"))
    return totals.drop("chunks_processed")


def progress_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats = _streamed(spark, sf_dir)
    return stream_progress(read_stats(spark, stats, "stream"))


def queries() -> dict[str, Query]:
    def on_reviews(operator) -> Query:
        return lambda spark, sf_dir: operator(reviews(spark, sf_dir))

    def on_scan(operator) -> Query:
        return lambda spark, sf_dir: operator(reviews(spark, sf_dir, heavy=False))

    def on_keyed(operator) -> Query:
        return lambda spark, sf_dir: operator(_keyed(spark, sf_dir))

    def on_text(table: str, text: str, function, result: str, *keys: str) -> Query:
        return lambda spark, sf_dir: _table(spark, sf_dir, table).select(
            *keys, function(F.col(text)).alias(result)
        )

    def store_query(operator) -> Query:
        return lambda spark, sf_dir: operator(*_hashed_and_stored(spark, sf_dir))

    return {
        "s1_read_jsonl": read_jsonl_query,
        "s2_read_json_document": read_json_document_query,
        "s3_read_csv": read_csv_query,
        "s4_read_json_lines": read_json_lines_query,
        "s6_read_reviews_stream": stream_read_query,
        "c1_find_column": find_column_query,
        "c7_validate_review_schema": validate_schema_query,
        "c8_validate_required_columns": required_columns_query,
        "q3_sufficient": lambda spark, sf_dir: quality.data_sufficiency(clean_reviews(spark, sf_dir), 20),
        "s4_read_reviews": read_reviews_query,
        "s5_read_uploaded_data": read_uploaded_query,
        "s7_first_rows": on_scan(lambda df: profiling.first_rows(df, 150)),
        "s8_save_dataframe": save_dataframe_query,
        "s9_append_clean": append_clean_query,
        "c2_key_sets": on_reviews(lambda df: _joined_keys(schema.key_sets(df))),
        "c2_event_key_sets": lambda spark, sf_dir: _joined_keys(
            schema.key_sets(spark.read.parquet(f"{sf_dir}/events.parquet"))
        ),
        "c2_json_key_sets": lambda spark, sf_dir: _joined_keys(schema.key_sets(_open_records(spark, sf_dir))),
        "c3_json_schema_summary": lambda spark, sf_dir: schema.schema_summary(_open_records(spark, sf_dir)),
        "c5_json_absent_fields": lambda spark, sf_dir: schema.sometimes_absent_fields(_open_records(spark, sf_dir)),
        "c3_schema_summary": on_reviews(schema.schema_summary),
        "c4_top_key_sets": on_reviews(lambda df: _joined_keys(schema.top_key_sets(df))),
        "c5_sometimes_absent_fields": on_reviews(schema.sometimes_absent_fields),
        "c5_absent_label_fields": absent_label_fields,
        "c6_known_fields": on_reviews(schema.known_fields),
        "c6_classify_dataset": on_reviews(schema.classify_dataset),
        "p1_rating_distribution": on_scan(profiling.rating_distribution),
        "p1_event_distribution": event_distribution,
        "p2_text_missing_stats": on_reviews(profiling.text_missing_stats),
        "p3_column_null_counts": on_scan(profiling.column_null_counts),
        "p4_seeded_sample": on_scan(
            lambda df: profiling.seeded_sample(df.select("ingest_seq", "asin", "text"), 100)
        ),
        "p5_language_estimate": lambda spark, sf_dir: profiling.language_estimate(
            reviews(spark, sf_dir), trained_model(spark, sf_dir), 150
        ),
        "p6_html_rate": on_scan(profiling.html_rate),
        "p7_html_examples": on_scan(profiling.html_examples),
        "p8_exploration_summary": on_reviews(profiling.exploration_summary),
        "t1_normalize_whitespace": on_text(
            "documents", "text", normalize_whitespace, "tidy_text", "doc_id"
        ),
        "t2_strip_html": on_text("pages", "html", strip_html, "visible_text", "page_id"),
        "t3_clean_html": on_text("pages", "html", clean_html, "visible_text", "page_id"),
        "t4_normalize_review_text": on_reviews(
            lambda df: df.select(
                "ingest_seq", normalize_review_text(F.col("text")).alias("normalized_text")
            )
        ),
        "t4_normalize_page_text": on_text(
            "pages", "html", normalize_review_text, "normalized_text", "page_id"
        ),
        "t5_normalize_for_duplicate": on_text(
            "conversations", "text", normalize_for_duplicate, "comparable_text", "conv_id", "turn"
        ),
        "t6_validate_rating": on_scan(
            lambda df: df.select(
                "ingest_seq",
                F.col("rating").alias("raw_rating"),
                validate_rating(F.col("rating")).alias("rating"),
            )
        ),
        "t7_review_hash": on_reviews(
            lambda df: df.select(
                "ingest_seq",
                review_hash(
                    *[F.col(c) for c in ("asin", "user_id", "rating", "title", "text")]
                ).alias("review_hash"),
            )
        ),
        "l0_language_profiles": lambda spark, sf_dir: language.build_language_profiles(
            _table(spark, sf_dir, "documents")
        ),
        "l1_detect_language": lambda spark, sf_dir: language.detect_language(
            _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ingest_seq"), "text"),
            "text",
            trained_model(spark, sf_dir),
        ).select("ingest_seq", "language"),
        "l1_detect_turns": lambda spark, sf_dir: language.detect_language(
            _turns(spark, sf_dir), "text", trained_model(spark, sf_dir)
        ).select("ingest_seq.*", "language"),
        "l2_language_filter": lambda spark, sf_dir: language.language_filter(
            reviews(spark, sf_dir).select("ingest_seq", "text"),
            "text",
            trained_model(spark, sf_dir),
        ).select("ingest_seq", "language", "accepted"),
        "v1_validate_reviews": _validated,
        "v1_rejection_counts": rejection_counts,
        "v1_split_missing": lambda spark, sf_dir: _validated(spark, sf_dir, True).select(
            "ingest_seq", "reason"
        ),
        "v2_preprocess_reviews": clean_reviews,
        "v3_rejected_reviews": lambda spark, sf_dir: validation.rejected_reviews(
            reviews(spark, sf_dir), trained_model(spark, sf_dir)
        ),
        "u1_drop_duplicate_reviews": on_keyed(dedupe.drop_duplicate_reviews),
        "u2_duplicate_mask": on_keyed(
            lambda df: dedupe.duplicate_mask(df).select("ingest_seq", "is_duplicate")
        ),
        "u2_duplicate_turns": lambda spark, sf_dir: dedupe.duplicate_mask(
            _turns(spark, sf_dir), ["text"]
        ).select("ingest_seq.*", "is_duplicate"),
        "u3_duplicate_groups": on_keyed(dedupe.duplicate_groups),
        "u4_duplicate_report": on_keyed(dedupe.duplicate_report),
        "u5_hash_uniqueness": lambda spark, sf_dir: dedupe.hash_uniqueness(
            clean_reviews(spark, sf_dir)
        ),
        "u6_known_hashes": store_query(known_hashes),
        "u7_new_hashes": store_query(new_hashes),
        "u8_store_listing": store_listing,
        "u9_increment_clean": increment_clean,
        "u9_increment_stats": increment_stats,
        "q1_record_stats": record_stats,
        "q2_accumulate_stats": accumulate_stats_query,
        "q3_data_sufficiency": lambda spark, sf_dir: quality.data_sufficiency(
            clean_reviews(spark, sf_dir)
        ),
        "q4_reconcile": reconcile_query,
        "x1_stream_clean": stream_clean,
        "x1_keyed_clean": keyed_clean,
        "x2_stream_totals": stream_totals,
        "x2_listener_progress": listener_progress,
        "x2_stream_progress": progress_query,
    }
