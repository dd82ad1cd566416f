"""Records of large JSON documents, found in many tasks for each file.

A document is read as pieces that end at a closing brace, which Spark can split anywhere. Each block of a file
is followed twice, as if it began outside and inside a string, which gives one small row: the brackets that it closes and
leaves open. Chaining these rows by file tells the open brackets at the begin of each block, and a second pass cuts the
items out. What is left of the document, with an empty object for each run of items, is its outline; it says
what kind of document it is, and whether it is one at all.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewsieve.session import BROADCAST_BYTES, BROADCAST_ROWS, stored_bytes, write_once

# Functions that run in tasks travel with the job, so executors need no copy of the library.
register_pickle_by_value(sys.modules[__name__])

_ENDS = "file string, block long, bytes long, size long, first string, " + ", ".join(f"inside_{h} boolean, closes_{h} long, opens_{h} string" for h in "ab")
_BEGINS = "file string, block long, inside boolean, stack string, root string, origin long, last boolean, terminated boolean"
_PIECE = "file string, block long, origin long, record string, outline string, cut boolean"
_TOKEN = re.compile(r'\\.|["\[\]{}]', re.S)


def follow(text: str, inside: bool, opened: list[str]) -> tuple[bool, int]:
    """Follow a text that begins outside or inside a string: whether it ends inside one, and how many brackets
    of before it closes. The brackets that it leaves open are added to `opened`."""
    closed = 0
    for token in _TOKEN.findall(text):
        if token == '"':
            inside = not inside
        elif inside or token[0] == "\\":
            continue
        elif token in "[{":
            opened.append(token)
        elif opened:
            opened.pop()
        else:
            closed += 1
    return inside, closed


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, how it ends if it begins outside (a) and inside (b) a string."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, block, size, piece in zip(*(c.to_pylist() for c in batch.columns[:4])):
            state = found.setdefault((file, block), [0, size, None, False, 0, [], True, 0, []])
            state[0] += len(piece.encode()) + 1
            for at in (3, 6):
                state[at], closed = follow(piece + "}", state[at], state[at + 2])
                state[at + 1] += closed
            if state[2] is None and (root := re.search(r"[\[{]", piece)):
                state[2] = root[0]
    rows = [(*key, *s[:5], "".join(s[5]), *s[6:8], "".join(s[8])) for key, s in found.items()]
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64()), ("first", pa.string())] + [(f"{n}_{h}", t) for h in "ab" for n, t in (("inside", pa.bool_()), ("closes", pa.int64()), ("opens", pa.string()))])
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each block of a file begins, and in which block the item that it begins in began.

    Rows come sorted by file and block; those of one file are held at a time.
    """
    names = ["file", "block", "inside", "stack", "root", "origin", "last", "terminated"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]

    def begins(blocks: list[tuple]) -> Iterator[tuple]:
        # The text behind the last brace is a piece too, but no brace ends it. Sizes tell, unless the file is compressed.
        terminated = sum(b[2] for b in blocks) == blocks[0][3]
        root = next((b[4] for b in blocks if b[4] is not None), "")
        level = 1 if root == "[" else 2
        inside, stack, origin = False, "", 0
        for n, (file, block, _, _, _, *ends) in enumerate(blocks):
            yield file, block, inside, stack, root, origin, n + 1 == len(blocks), terminated
            now_inside, closes, opens = ends[3:] if inside else ends[:3]
            if len(stack) - closes <= level:
                origin = block
            stack = stack[: max(len(stack) - closes, 0)] + opens
            inside = now_inside

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    held: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                out += begins(held)
                held = []
            held.append(row)
        if out:
            yield batch_of(out)
    if held:
        yield batch_of([*begins(held)])


class _Block:
    """Cuts the items out of the pieces of one block, one after the other."""

    def __init__(self, file: str, block: int, inside: bool, stack: str, root: str, origin: int, last: bool, terminated: bool) -> None:
        self.key, self.inside, self.stack, self.last, self.terminated = (file, block), inside, list(stack), last, terminated
        self.prefix = ["["] if root == "[" else ["{", "["]
        n = len(self.prefix)
        self.in_item = self.stack[:n] == self.prefix and self.stack[n : n + 1] == ["{"]
        self.origin = origin if self.in_item else None
        self.item: list[str] = []
        self.gap: list[str] = []
        self.outline: list[str] = []
        self.cut = self.in_item

    def add(self, piece: str, ended: bool) -> list[str | tuple[int, str]]:
        """Items that end in a piece; one that began in an earlier block comes with that block."""
        text, at, out = piece + "}" if ended else piece, 0, []
        for match in _TOKEN.finditer(text):
            token = match[0]
            if token == '"':
                self.inside = not self.inside
            elif self.inside or token[0] == "\\":
                continue
            elif token in "[{":
                if token == "{" and not self.in_item and self.stack == self.prefix:
                    self.gap.append(text[at : match.start()])
                    self._close_gap()
                    self.in_item, self.cut, at = True, True, match.start()
                self.stack.append(token)
            else:
                if self.stack:
                    self.stack.pop()
                if self.in_item and len(self.stack) == len(self.prefix):
                    self.item.append(text[at : match.end()])
                    record = "".join(self.item)
                    out.append(record if self.origin is None else (self.origin, record))
                    self.item, self.in_item, self.origin, at = [], False, None, match.end()
        (self.item if self.in_item else self.gap).append(text[at:])
        return out

    def _close_gap(self) -> None:
        """Keep the text before an item in the outline, unless it is the comma behind another item of this block."""
        gap = "".join(self.gap)
        if not self.outline or gap.strip() != ",":
            self.outline += [gap, "{}"]
        self.gap = []

    def end(self) -> tuple[tuple[int, str] | None, str]:
        """The begin of an item that the block's end cuts, and the outline."""
        begun = (self.key[1] if self.origin is None else self.origin, "".join(self.item)) if self.in_item else None
        return begun, "".join([*self.outline, *self.gap])


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of the blocks, pieces of cut items under the block where they begin, and the outline of each block, with whether an item was cut out of it."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("origin", pa.int64()), ("record", pa.string()), ("outline", pa.string()), ("cut", pa.bool_())])
    block, held = None, None

    def rows(found) -> list[tuple]:
        return [(*block.key, None, r, None, None) if isinstance(r, str) else (*block.key, *r, None, None) for r in found]

    def finish() -> list[tuple]:
        if block is None:
            return []
        # Whether a brace ends the last piece of a file is known from its size; else an open bracket tells.
        out = rows(block.add(held, not block.last or block.terminated))
        begun, outline = block.end()
        return out + ([(*block.key, *begun, None, None)] if begun else []) + [(*block.key, None, None, outline, block.cut)]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for batch in batches:
        out: list[tuple] = []
        for file, number, piece, *begin in zip(*(c.to_pylist() for c in batch.columns)):
            if block is None or block.key != (file, number):
                out += finish()
                block = _Block(file, number, *begin)
            else:
                out += rows(block.add(held, True))
            held = piece
        if out:
            yield batch_of(out)
    if block is not None:
        yield batch_of(finish())


def document_items(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, record) of the items of the documents' arrays or lists, and (file, outline, cut) of each document.

    Items are the objects of an array that is the root, or of lists of an object that is. An outline is the
    document with an empty object in place of each run of items that only commas part; without an item to cut it is the document.
    """
    text = spark.read.option("lineSep", "}").text(path)
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    pieces = text.select(*meta, F.col("_metadata.file_size").alias("size"), F.col("value").alias("piece"), F.monotonically_increasing_id().alias("place"))
    ends = pieces.select("file", "block", "size", "piece").mapInArrow(_ends, _ENDS)
    blocks = write_once(ends.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_chain, _BEGINS), "json-blocks")
    # A small row for each block of the input. A broadcast join leaves pieces in place, a shuffled one mixes them up.
    small = blocks.rows <= BROADCAST_ROWS and stored_bytes(spark, blocks.path) <= BROADCAST_BYTES
    placed = pieces.join(F.broadcast(blocks.data) if small else blocks.data, ["file", "block"])
    if not small:
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "place")
    found = placed.select("file", "block", "piece", "inside", "stack", "root", "origin", "last", "terminated").mapInArrow(_items, _PIECE)
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", c))), lambda p: p[c]), "")
    whole = found.where("record IS NOT NULL AND origin IS NULL").select("file", "record")
    cut = found.where("origin IS NOT NULL").groupBy("file", "origin").agg(joined("record").alias("record")).drop("origin")
    outlines = found.where("outline IS NOT NULL").groupBy("file").agg(joined("outline").alias("outline"), F.max("cut").alias("cut"))
    return whole.unionByName(cut), outlines
