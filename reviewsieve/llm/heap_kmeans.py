"""Lloyd's clustering with heap-ordered bounds.

For a vector in cluster c, let `upper` be its distance to the centroid of c and `lower` that to the next
centroid. After centroids moved, it can only belong elsewhere once the gap `lower - upper` is used up by
what c moved plus the most that any other centroid moved. Each cluster adds these drifts up; a vector enters
the cluster's heap under its gap plus the drift so far, so keys never need an update and the vectors whose
gap has expired are those at the head, with a key below the drift of now.

On Spark, a heap is a list of sorted runs: each task writes its share of a cluster in the order of the keys,
and a sorted run is a heap that is popped in the order of its rows. Popping is a range of keys of each cluster,
which reaches the Parquet scan as a filter on sorted columns; the popped vectors are rescanned exactly and pushed as a new run.
Vectors never move between tasks, nothing is rewritten, and a row counts as popped from its run
because its key lies below a drift that only grows. All distances and sums are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.session import WrittenTable, write_once

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
# Squared distances of 64 components up to this size fit in 64 bits.
LARGEST = 1 << 27
# Added to the drift, far above the rounding of a square root: a gap below it counts as expired.
MARGIN = 1e-3
BATCH = 4096  # vectors whose distances to all centroids are in memory at once

_ENTRY = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("vector", T.ArrayType(T.IntegerType())),
        T.StructField("was", T.IntegerType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("key", T.DoubleType()),
    ]
)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows whose vector has all components, each as floor(scale * x)."""
    vector = F.col(vector_col)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where((F.size(vector) == dimensions) & ~bad)

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(y) <= LARGEST, y.cast("int")).otherwise(F.raise_error(F.lit(f"A component is beyond {LARGEST} / {scale}.")).cast("int"))

    return kept.select("vec_id", F.transform("v", whole).alias("vector"))


def seed_vectors(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; ties by their components, null ids last."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(rank.alias("rank"), "vector").orderBy(F.col("rank").asc_nulls_last(), "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in first], np.int64).reshape(len(first), -1)


def _components(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of `x` to each centroid."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = x - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the gap to the next, for each row."""
    d = squared_distances(x, centroids)
    cluster = d.argmin(axis=1)
    rows = np.arange(len(x))
    upper = np.sqrt(d[rows, cluster].astype(np.float64))
    if len(centroids) == 1:
        return cluster, np.full(len(x), np.inf)
    d[rows, cluster] = np.iinfo(np.int64).max
    return cluster, np.sqrt(d.min(axis=1).astype(np.float64)) - upper


def _scan(entries: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """New heap entries: exact nearest centroid and gap, offset by the drift of its cluster so far."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int32())), ("was", pa.int32()), ("cluster", pa.int32()), ("key", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                cluster, gap = nearest(_components(part.column(1)), centroids)
                columns = [part.column(0), part.column(1).cast(pa.list_(pa.int32())), part.column(2), pa.array(cluster.astype(np.int32)), pa.array(gap + drift[cluster])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return entries.select("vec_id", "vector", "was").mapInArrow(scan, _ENTRY).sortWithinPartitions("cluster", "key")


def _any(ranges: list[str]) -> Column:
    """Any of the SQL conditions, as one filter that reaches the scan."""
    return F.expr(" OR ".join(f"({r})" for r in ranges) or "false")


@dataclass
class Heaps:
    """Sorted runs of all clusters, the oldest first, and the drift up to which they are popped."""

    runs: list[WrittenTable]
    popped: np.ndarray  # of the runs but the last, which is not popped yet

    def expired(self, limit: np.ndarray) -> DataFrame:
        """Pop the entries with keys below `limit` of their cluster."""

        def head(run: WrittenTable, since: list[float] | None) -> DataFrame:
            ranges = [f"cluster = {j} AND key < {to!r}D" + ("" if since is None else f" AND key >= {since[j]!r}D") for j, to in enumerate(limit.tolist())]
            return run.data.where(_any(ranges)).selectExpr("vec_id", "vector", "cluster AS was")

        *older, last = self.runs
        return reduce(DataFrame.unionAll, [head(run, self.popped.tolist()) for run in older] + [head(last, None)])

    def push(self, run: WrittenTable, limit: np.ndarray) -> None:
        self.runs.append(run)
        self.popped = limit

    def entries(self) -> DataFrame:
        """All vectors, each as it was pushed last."""
        *older, last = self.runs
        left = _any([f"cluster = {j} AND key >= {x!r}D" for j, x in enumerate(self.popped.tolist())] if older else [])
        return reduce(DataFrame.unionAll, [run.data.where(left) for run in older] + [last.data])

    def remove(self) -> None:
        for run in self.runs:
            run.remove()


def _changes(entries: DataFrame, clusters: int, dimensions: int) -> list:
    """(cluster, n, i, total): by how much the entries that changed their cluster change the counts and sums of each.

    Each task adds its own up as 64-bit numbers and sends a row for each cluster; these are added as decimals.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(clusters, np.int64), np.zeros((clusters, dimensions), np.int64)
        for batch in batches:
            x, was, cluster = _components(batch.column(0)), batch.column(1), batch.column(2).to_numpy()
            np.add.at(counts, cluster, 1)
            np.add.at(sums, cluster, x)
            old = was.is_valid().to_numpy(zero_copy_only=False)
            left = was.drop_null().to_numpy()
            np.add.at(counts, left, -1)
            np.add.at(sums, left, -x[old])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(clusters), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    moved = entries.where("was IS NULL OR was <> cluster").select("vector", "was", "cluster")
    by_task = moved.mapInArrow(add, "cluster int, n long, sums array<long>")
    cells = by_task.select("cluster", "n", F.posexplode("sums").alias("i", "total"))
    return cells.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[Heaps, np.ndarray]:
    """Heaps with the final cluster of each of the whole-numbered `vectors`, and the final centroids."""
    centroids = seed_vectors(vectors, clusters, seed)
    k, dimensions = centroids.shape
    drift = np.zeros(k)
    counts, sums = [0] * k, [[0] * dimensions for _ in range(k)]
    start = vectors.withColumn("was", F.lit(None).cast("int"))
    run = write_once(_scan(start, centroids, drift), "heap-run")
    heaps = Heaps([run], np.full(k, -np.inf))
    for _ in range(rounds):
        for row in _changes(run.data, k, dimensions):
            counts[row["cluster"]] += row["n"] if row["i"] == 0 else 0
            sums[row["cluster"]][row["i"]] += int(row["total"])
        following = np.array([[s // n for s in total] if n else list(c) for n, total, c in zip(counts, sums, centroids)], np.int64)
        moved = np.sqrt(((following - centroids) ** 2).sum(axis=1).astype(np.float64))
        others = np.array([max(np.delete(moved, j), default=0.0) for j in range(k)])
        drift, centroids = drift + moved + others, following
        limit = drift + MARGIN
        run = write_once(_scan(heaps.expired(limit), centroids, drift), "heap-run")
        heaps.push(run, limit)
    return heaps, centroids


def centroid_clusters(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector.

    Vectors that are null, of another length, or with a null or non-finite component are left out. Components become
    floor(256 * x); one beyond 2**27 stops the job, as squared distances would not fit in 64 bits. Fewer vectors than
    clusters give as many centroids as vectors; no vector gives no row. Repeated ids and equal vectors are rows of their
    own; as seeds, equal ids go by their components and null ids come last. Ties go to the smaller cluster, and an empty
    cluster keeps its centroid. Other columns are not read.
    """
    kept = write_once(whole_vectors(rows, id_col, vector_col, dimensions), "vectors")
    names = "vec_id long, cluster int, distance long"
    if not kept.rows:
        empty = rows.sparkSession.createDataFrame([], names)
        return empty.select("*", *[F.lit(None).cast("long").alias(c) for c in ("cluster_inertia", "inertia")], F.lit(None).cast("string").alias("centroid_sha256"))
    heaps, centroids = cluster_vectors(kept.data, clusters, rounds, seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _components(batch.column(1)) - centroids[batch.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.einsum("ij,ij->i", d, d))], ["vec_id", "cluster", "distance"])

    placed = write_once(heaps.entries().select("vec_id", "vector", "cluster").mapInArrow(measure, names), "placed")
    heaps.remove()
    kept.remove()
    inertia = {r["cluster"]: int(r["d"]) for r in placed.data.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    total = sum(inertia.values())
    digests = [(j, d, total, hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, d in inertia.items()]
    of_cluster = rows.sparkSession.createDataFrame(digests, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.data.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
