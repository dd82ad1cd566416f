"""The whole dataset in increments, with the known hashes in keyed state instead of a store.

The state of the query holds, for each hash, where it was first seen. An increment reads and
writes the keys that it touches and no others, so its time follows its own size and not the length of the
history. Hashes are grouped with partial aggregation, so a review that holds a third of an increment is one
row per task before the shuffle, and state holds hashes and places, never reviews: the whole rows of
new hashes are read again from the files of their increment.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from reviewsieve.fixed_values import REASONS
from reviewsieve.operators.language import LanguageModel
from reviewsieve.operators.validation import attach_language
from reviewsieve.plans.increments import ReviewColumns, cleaned
from reviewsieve.session import path_exists, write_once
from reviewsieve.sources.readers import FILE_PLACE, read_stream_files
from reviewsieve.sources.writers import append_clean

# State on disk, of which an increment saves what it has changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COUNTERS = ("input_records", *REASONS, "valid_before_deduplication")
_PROGRESS = "run_id string, batch_id long, " + ", ".join(f"{c} long" for c in (*COUNTERS, "state_rows"))


class StreamProgress(StreamingQueryListener):
    """One row per finished increment of the queries named after their run, while they run.

    An increment that is tried again replaces its row.
    """

    def __init__(self) -> None:
        self.rows: dict[tuple[str, int], tuple] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = json.loads(event.progress.json)
        counts = found.get("observedMetrics", {}).get("increment")
        if counts:
            states = sum(s["numRowsTotal"] for s in found.get("stateOperators", ()))
            key = (found["name"], found["batchId"])
            self.rows[key] = (*key, *[counts[c] for c in COUNTERS], states)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.rows.values()), _PROGRESS)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def first_places(source: DataFrame, model: LanguageModel | None, names: ReviewColumns, order: str) -> DataFrame:
    """Streaming (review_hash, first, now): each hash that an increment touches, and where it was first seen.

    `first` is (arrived, order, file); a hash is new if it arrived now. Of the copies within an
    increment the one with the lowest order is first.
    """
    decided = attach_language(cleaned(source, names).select(F.col(order).alias("_order"), f"{FILE_PLACE}.file", "_text", "_reason", "review_hash"), model)
    reason = F.col("_reason")
    counts = [F.count(F.lit(1)).alias("input_records"), *[F.count_if(reason == r).alias(r) for r in REASONS], F.count_if(reason.isNull()).alias("valid_before_deduplication")]
    # The time of an increment stays the same when it is tried again.
    valid = decided.observe("increment", *counts).where(reason.isNull()).withColumn("arrived", F.current_timestamp())
    place = F.struct("arrived", F.col("_order").alias("order"), "file")
    return valid.groupBy("review_hash").agg(F.min(place).alias("first")).withColumn("now", F.current_timestamp())


def run_keyed_stream(
    source: DataFrame,
    out_path: str,
    run_id: str,
    checkpoint: str,
    model: LanguageModel | None,
    order: str = "ingest_seq",
    names: ReviewColumns = ReviewColumns(),
) -> StreamingQuery:
    """Start a query named `run_id` that processes everything that `source` has, then stops.

    `source` comes from `read_reviews_stream` and has a unique `order` column. Each increment writes its clean rows
    into a folder of its own; a crash makes Spark repeat the increment on the state before it, which replaces that folder.
    The state lives in the checkpoint, so a run that goes on with the same checkpoint knows all earlier hashes; a new
    checkpoint starts without any and needs a new `run_id`. The clock of the driver must not go back between increments.
    """
    spark = source.sparkSession
    if path_exists(spark, f"{out_path}/run_id={run_id}") and not path_exists(spark, checkpoint):
        raise ValueError(f"Run '{run_id}' has output already; a new checkpoint needs a new run.")
    schema = source.drop(FILE_PLACE).schema

    def process(touched: DataFrame, batch_id: int) -> None:
        new = touched.where(F.col("first.arrived") == F.col("now")).select(F.col("first.order").alias("_new"), F.col("first.file").alias("_file"))
        fresh = write_once(new, "new-hashes")
        try:
            files = [r[0] for r in fresh.data.select("_file").distinct().collect()]
            if files:
                rows = read_stream_files(touched.sparkSession, files, schema)
                kept = rows.join(fresh.sized_for_join().select("_new"), F.col(order) == F.col("_new"))
                clean = cleaned(kept, names).select(*schema.names, "text_normalized", "title_normalized", "review_hash")
                append_clean(clean, out_path, run_id, batch_id)
        finally:
            fresh.remove()

    with _settings(spark, STATE):
        return (
            first_places(source, model, names, order)
            .writeStream.queryName(run_id)
            .outputMode("update")
            .foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
