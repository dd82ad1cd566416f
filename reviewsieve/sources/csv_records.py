"""Records of quoted CSV files, put together in many tasks for each file.

Spark splits a text file at line ends, but a line may end inside quotes. Each block of a file is therefore followed
twice, as if it began outside and inside quotes, which gives one small row. Chaining these rows by file tells how
each block really begins, and a second pass joins lines to records. Only the record that a block's end
cuts has to meet its other pieces, under the block in which it began.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewsieve.session import BROADCAST_BYTES, BROADCAST_ROWS, stored_bytes, write_once

# Functions that run in tasks travel with the job, so executors need no copy of the library.
register_pickle_by_value(sys.modules[__name__])

_BLOCK = "file string, block long, open boolean, origin long"
_RECORD = "file string, block long, number long, origin long, head boolean, record string"


def ends_open(line: str, is_open: bool) -> bool:
    """Whether a line that begins outside or inside quotes ends inside them.

    A quote opens at the start of a field only; inside, two quotes are one of the text.
    """
    at, size = 0, len(line)
    while True:
        if is_open:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            is_open = False
        elif at < size and line[at] == '"':
            is_open, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """Runs of lines of one block, in order; a block may come in several runs."""
    for batch in batches:
        files, blocks, lines = (c.to_pylist() for c in batch.columns[:3])
        start = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or blocks[i] != blocks[start] or files[i] != files[start]:
                yield files[start], blocks[start], lines[start:i]
                start = i


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, how it ends if it begins outside and inside quotes, and whether it then closes them."""
    found: dict[tuple[str, int], list[bool]] = {}
    for file, block, lines in _by_block(batches):
        state = found.setdefault((file, block), [False, True, False])
        for line in lines:
            if '"' in line:
                state[0], state[1] = ends_open(line, state[0]), ends_open(line, state[1])
            state[2] |= not state[1]
    rows = [(*key, *state) for key, state in found.items()]
    names = ["file", "block", "if_closed", "if_open", "closes"]
    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema([("file", pa.string()), ("block", pa.int64()), *((n, pa.bool_()) for n in names[2:])]))


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """How each block of a file begins, and in which block the record that it begins in began."""
    rows, is_open, origin = [], False, 0
    for b in blocks.sort_values("block").itertuples():
        rows.append((b.file, b.block, is_open, origin))
        if not is_open or b.closes:
            origin = b.block
        is_open = b.if_open if is_open else b.if_closed
    return pd.DataFrame(rows, columns=["file", "block", "open", "origin"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks. What a block's end cuts, or its begin, is a piece with the block of its begin as origin."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("origin", pa.int64()), ("head", pa.bool_()), ("record", pa.string())])
    key, pending, is_open, number, origin, head, seen = None, [], False, 0, None, False, True

    def rest() -> list[tuple]:
        return [(*key, number, key[1] if origin is None else origin, head, "\n".join(pending))] if pending else []

    for batch in batches:
        out: list[tuple] = []
        opens, origins = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        at = 0
        for file, block, lines in _by_block([batch]):
            if (file, block) != key:
                out += rest()
                key, pending, number, is_open = (file, block), [], 0, opens[at]
                # A piece at the begin belongs to a record of an earlier block.
                origin, head = (origins[at] if is_open else None), False
                seen = is_open or block > 0
            at += len(lines)
            for line in lines:
                if not pending and origin is None:
                    head = not seen and bool(line.strip("﻿ \t\r"))
                    seen |= head
                pending.append(line)
                if is_open or '"' in line:
                    is_open = ends_open(line, is_open)
                if not is_open:
                    out.append((file, block, number, origin, head, "\n".join(pending)))
                    pending, origin, head = [], None, False
                    number += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if rest():
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rest()), schema)], schema=schema)


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, number, head, record) of each record that is not blank; `head` marks a file's first.

    Lines end with a line feed, which may follow a carriage return. Records are in the order of block and number.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("place"))
    ends = lines.drop("place").mapInArrow(_ends, "file string, block long, if_closed boolean, if_open boolean, closes boolean")
    blocks = write_once(ends.groupBy("file").applyInPandas(_chain, _BLOCK), "csv-blocks")
    # A small row for each block of the input. A broadcast join leaves lines in place, a shuffled one mixes them up.
    small = blocks.rows <= BROADCAST_ROWS and stored_bytes(spark, blocks.path) <= BROADCAST_BYTES
    placed = lines.join(F.broadcast(blocks.data) if small else blocks.data, ["file", "block"])
    if not small:
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "place")
    placed = placed.select("file", "block", "line", "open", "origin")
    pieces = placed.mapInArrow(_records, _RECORD)
    whole = pieces.where("origin IS NULL").drop("origin")
    cut = pieces.where("origin IS NOT NULL").groupBy("file", "origin").agg(
        F.max("head").alias("head"),
        F.min_by("number", "block").alias("number"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), "\n").alias("record"),
    )
    records = whole.unionByName(cut.withColumnRenamed("origin", "block"))
    tidy = F.regexp_replace(F.col("record"), "\r$", "")
    tidy = F.when(F.col("head"), F.regexp_replace(tidy, "^﻿", "")).otherwise(tidy)
    return records.withColumn("record", tidy).where(F.trim("record") != "")
