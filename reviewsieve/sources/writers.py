"""Writers. Output is a folder of part files, as Spark writes it."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def save_dataframe(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Write CSV or JSON lines; the format follows the extension when not given."""
    kind = (fmt or PurePosixPath(str(path)).suffix).lower().lstrip(".")
    if kind == "csv":
        # Nested columns have no CSV form and are written as JSON text.
        flat = df.select(
            *[
                F.to_json(F.col(f"`{f.name}`")).alias(f.name)
                if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
                else F.col(f"`{f.name}`")
                for f in df.schema.fields
            ]
        )
        (
            flat.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    elif kind in ("json", "jsonl"):
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"Cannot write '{kind}' files; writable are csv, json and jsonl.")


def append_clean(
    df: DataFrame, path: str, run_id: str, batch_id: int, time_col: str = "timestamp"
) -> None:
    """Write one batch of clean reviews as JSON lines with ISO times.

    The batch has a folder of its own; writing it again replaces only that.
    """
    times = {
        f.name: F.date_format(f.name, ISO_TIME)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    if time_col in df.columns and isinstance(df.schema[time_col].dataType, T.LongType):
        times[time_col] = F.date_format(F.timestamp_millis(time_col), ISO_TIME)
    rows = df.withColumns(
        {**times, "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")}
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy("run_id", "batch_id")
        .json(path)
    )


def read_clean(
    spark: SparkSession, path: str, schema: T.StructType, run_id: str | None = None
) -> DataFrame:
    """Clean reviews written by `append_clean`, of one run or of all."""
    partitioned = T.StructType(
        [
            *[f for f in schema.fields if f.name not in ("run_id", "batch_id")],
            T.StructField("run_id", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    rows = spark.read.schema(partitioned).json(path)
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)
