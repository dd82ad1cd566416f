"""The whole dataset in increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from reviewsieve.fixed_values import REASONS
from reviewsieve.operators.language import LanguageModel
from reviewsieve.operators.store import DedupeStore
from reviewsieve.plans.increments import ReviewColumns, preprocess_increment
from reviewsieve.session import path_exists, spread, write_once
from reviewsieve.sources.readers import FILE_PLACE, numbered
from reviewsieve.sources.writers import append_clean

STATS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "input_records",
            *REASONS,
            "valid_before_deduplication",
            "duplicate_records",
            "clean_records",
        )
    ]
    + [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
)


def _append_stats(stats: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    rows = stats.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
    rows.coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_id", "batch_id").parquet(path)


def read_stats(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """One row per increment, as written while the stream runs."""
    rows = spark.read.schema(STATS_SCHEMA).parquet(path)
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def stream_progress(stats: DataFrame) -> DataFrame:
    """Rows read and clean rows so far, after each increment of each run."""
    so_far = Window.partitionBy("run_id").orderBy("batch_id")
    return stats.select(
        "run_id",
        "batch_id",
        "input_records",
        F.sum("input_records").over(so_far).alias("input_so_far"),
        F.sum("clean_records").over(so_far).alias("clean_so_far"),
    )


def run_preprocess_stream(
    source: DataFrame,
    out_path: str,
    store: DedupeStore,
    run_id: str,
    checkpoint: str,
    stats_path: str,
    model: LanguageModel | None,
    order: str = "ingest_seq",
    names: ReviewColumns = ReviewColumns(),
) -> StreamingQuery:
    """Start a query that processes everything that `source` has, then stops.

    Each batch writes its clean rows first, its hashes second and its counters
    last, each into a folder of the (run, batch) pair. A crash in between makes
    Spark repeat the batch, which then replaces what the first try wrote. Batch
    numbers start at 0 with a new checkpoint, so that needs a new `run_id`. Several runs may share a
    store: a review stays with the run that stores its hash first.

    Rows without an `order` column are numbered by their place in the files.
    """
    store.create()
    if path_exists(store.spark, f"{out_path}/run_id={run_id}") and not path_exists(
        store.spark, checkpoint
    ):
        raise ValueError(f"Run '{run_id}' has output already; a new checkpoint needs a new run.")

    def process(batch: DataFrame, batch_id: int) -> None:
        # Parsed once: the increment reads its rows several times.
        if order in batch.columns:
            rows = write_once(spread(batch, order), "batch")
        else:
            rows = numbered(batch, order)
        tables = [rows]
        try:
            while True:
                increment = preprocess_increment(rows.data, store, model, run_id, batch_id, names, order)
                tables += increment.tables
                clean = increment.clean.drop(FILE_PLACE)
                if order not in batch.columns:
                    clean = clean.drop(order)
                append_clean(clean, out_path, run_id, batch_id)
                # Fewer are stored if another run was faster with some; their rows then have to go again.
                if store.insert_absent(increment.hashes, run_id, batch_id, increment.seen) == increment.clean_rows:
                    break
            _append_stats(increment.stats, stats_path, run_id, batch_id)
        finally:
            for table in tables:
                table.remove()

    return (
        source.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
