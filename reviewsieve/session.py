"""Spark session, shared scratch folder and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only when it was counted and has at most this
# many rows.
BROADCAST_ROWS = 250_000
# Nor may its files be larger than this.
BROADCAST_BYTES = 32 << 20


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are designed for."""
    builder = (
        SparkSession.builder.appName("reviewsieve")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Call sites of every column function are not worth the planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Joins on a unique key hash the narrow side, where each of its partitions
        # turns out small enough, and then need not sort whole reviews.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the cluster.

    A temporary folder is made only for a local session that names none.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/reviewsieve"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_scratch(spark.sparkContext.applicationId)


@cache
def _local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"reviewsieve-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; an absent folder is empty."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in file_system.listStatus(hadoop_path)] if file_system.exists(hadoop_path) else []


def read_file(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file as a whole, unless its name is taken; whether it was created.

    The content is written under another name first, which is then changed without replacing anything.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, draft = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}.draft")
    file_system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = file_system.create(draft, False)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else file_system.getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    never[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        context.rename(draft, target, never)
        return True
    except Py4JJavaError as error:
        file_system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path; 0 for a table that was never written."""
    if not path:
        return 0
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.getContentSummary(hadoop_path).getLength()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of an input that comes in fewer pieces than cores.

    For a DataFrame read straight from files. Large inputs have more pieces than
    that and are left alone, so only small ones are ever shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class WrittenTable:
    """A DataFrame written once: short lineage, known size, survives executors."""

    data: DataFrame
    rows: int
    path: str

    def sized_for_join(self, limit: int = BROADCAST_ROWS) -> DataFrame:
        """Broadcast when the counted rows and the written bytes allow it, else a shuffled join."""
        small = self.rows <= limit and stored_bytes(self.data.sparkSession, self.path) <= BROADCAST_BYTES
        return F.broadcast(self.data) if small else self.data

    def remove(self) -> None:
        remove_path(self.data.sparkSession, self.path)


def write_once(df: DataFrame, label: str) -> WrittenTable:
    """Write `df` to the scratch folder and read it back.

    The row count is observed during the write, so it costs no second job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return WrittenTable(table, seen.get["rows"], path)
