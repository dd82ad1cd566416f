"""Helpers that several operators share: words, hashes, prefix sums, joins with hot keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.session import BROADCAST_BYTES, BROADCAST_ROWS, WrittenTable, stored_bytes, write_once

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_FOLD = bytes.maketrans(_UPPER, _LOWER)
_KEEP = set(b"0123456789") | set(_LOWER) | set(range(0x80, 0x100))
# A-Z become a-z; all other ASCII characters but digits and letters become spaces.
_ALNUM = bytes(c if c in _KEEP else 0x20 for c in _FOLD)

# A key with at least this share of the rows is joined by broadcast. There can be no
# more than HOT_KEYS of them, so the broadcast has a fixed bound.
HOT_KEYS = 1000


def folded_words(data: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case. Null has none."""
    return data.translate(_FOLD).split() if data else []


def alnum_words(data: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return data.translate(_ALNUM).split() if data else []


def utf8(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the multiplier and of its inverse, at least `n` of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        for i, base in enumerate((_MULTIPLIER, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def substring_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], all from one running sum."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by spaces, and where each starts and ends."""
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return data, ends - lengths, ends


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    return substring_hashes(*word_bounds(words))


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `n` words; fewer words, but not none, are one run."""
    if not words:
        return np.zeros(0, np.uint64)
    data, starts, ends = word_bounds(words)
    if len(words) < n:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    return np.unique(substring_hashes(data, starts, ends))


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str], label: str) -> tuple[DataFrame, WrittenTable]:
    """Inclusive running sum `<value>_end` of each column of `values` in the given order.

    Rows are range-partitioned, so that no key lands in one task; each partition sums its
    rows and the totals of the partitions (one row each) give the offsets.
    """
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, *(T.StructField(f"{v}_end", T.LongType()) for v in values), T.StructField("_part", T.IntegerType())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base = dict.fromkeys(values, 0)
        for batch in batches:
            arrays = list(batch.columns)
            for v in values:
                ends = np.cumsum(batch.column(batch.schema.get_field_index(v)).to_numpy(zero_copy_only=False).astype(np.int64)) + base[v]
                base[v] = int(ends[-1]) if len(ends) else base[v]
                arrays.append(pa.array(ends, pa.int64()))
            arrays.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    ordered = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    table = write_once(ordered.mapInArrow(sums, schema), label)
    parts = sorted(table.data.groupBy("_part").agg(*[F.max(f"{v}_end").alias(v) for v in values]).collect(), key=lambda r: r["_part"])
    offsets, base = [], [0] * len(values)
    for row in parts:
        offsets.append((row["_part"], *base))
        base = [b + row[v] for b, v in zip(base, values)]
    shift = spark.createDataFrame(offsets, ", ".join(["_part int", *(f"_{v}_before long" for v in values)]))
    total = table.data.join(F.broadcast(shift), "_part")
    return total.select(*df.columns, *[(F.col(f"{v}_end") + F.col(f"_{v}_before")).alias(f"{v}_end") for v in values]), table


def join_unique(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """Inner or left join of `rows` with `table`, which is unique in `key` and counts in `weight` the rows of each key.

    Keys that hold at least 1 / HOT_KEYS of all rows are broadcast; the rest is shuffled.
    """
    hot = table.where(F.col(weight) * HOT_KEYS >= total)
    cold = table.where(F.col(weight) * HOT_KEYS < total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key, how))



def join_written(rows: DataFrame, table: WrittenTable, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """As `join_unique`, but a small table is broadcast as a whole."""
    if table.rows <= BROADCAST_ROWS and stored_bytes(rows.sparkSession, table.path) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table.data), key, how)
    return join_unique(rows, table.data, key, weight, total, how)


def map_rows(df: DataFrame, schema: T.StructType | str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    return df.mapInArrow(work, schema)


def as_frame(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type, from_pandas=isinstance(columns[f.name], pd.Series)) for f in schema], schema=schema)
