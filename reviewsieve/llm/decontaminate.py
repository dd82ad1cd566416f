"""Benchmark decontamination with a generalised suffix automaton of the items' words.

The words of a document are streamed through the automaton, which knows after each word the
longest match that ends there. A match of at least `window` words, or of a whole shorter item,
marks its words. Items come in blocks of a bounded number of words; each block is one automaton,
broadcast by its words and built in each task, and the documents pass it without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.llm.common import _ALNUM, alnum_words, utf8
from reviewsieve.session import WrittenTable, write_once

WINDOW = 10
# Words of benchmark items in one automaton; more items make more automata.
BLOCK_WORDS = 200_000
# Documents with more than this share of their words marked are dropped as a whole.
MOST_COVERAGE = 0.5

Spans = list[tuple[int, int]]


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if ids:
                coded.append((name, ids))
                last = 0
                for word in ids:
                    last = self._extend(last, word)
        self._label(coded)

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # the string is known from another item
            to = self.next[last][word]
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, at: int, word: int, to: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[to]))
        self.link[copy], self.link[to] = self.link[to], copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _label(self, coded: list[tuple[str | None, list[int]]]) -> None:
        window = self.window
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        # The state that holds the last `window` words of a state's matches.
        self.tail = [0] * len(self.next)
        for s in order:
            up = self.link[s]
            self.tail[s] = s if self.length[up] < window <= self.length[s] else self.tail[up]
        self.items: dict[int, set[str | None]] = {}
        ends: dict[int, list[tuple[int, str | None]]] = {}  # whole items shorter than a window
        for name, ids in coded:
            state = 0
            for i, word in enumerate(ids):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.items.setdefault(self.tail[state], set()).add(name)
            if len(ids) < window:
                ends.setdefault(state, []).append((len(ids), name))
        # Short items that end wherever a state does: its own and those of its suffixes.
        self.short: list[list[tuple[int, str | None]]] = [[] for _ in self.next]
        for s in order:
            self.short[s] = ends.get(s, []) + self.short[self.link[s]] if s in ends else self.short[self.link[s]]
        lengths = [n for found in ends.values() for n, _ in found]
        self.least = min([window, *lengths])

    def scan(self, words: list[bytes]) -> tuple[Spans, set[str | None]]:
        """Spans [first, end) of marked words, apart from each other, and the items that mark them."""
        following, link, length, window, least = self.next, self.link, self.length, self.window, self.least
        root = following[0]
        spans: list[tuple[int, int]] = []
        tails: set[int] = set()
        names: set[str | None] = set()
        state = matched = 0
        for i, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                state = matched = 0
                continue
            to = following[state].get(word)
            if to is None:
                while state and word not in following[state]:
                    state = link[state]
                if word in following[state]:
                    matched = length[state] + 1
                    state = following[state][word]
                else:
                    state, matched = root[word], 1
            else:
                state = to
                matched += 1
            if matched < least:
                continue
            longest = 0
            if matched >= window:
                longest = matched
                tails.add(self.tail[state])
            for n, name in self.short[state]:
                if n <= matched:
                    names.add(name)
                    longest = max(longest, n)
            if longest:
                start = i - longest + 1
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for tail in tails:
            names |= self.items[tail]
        return spans, names


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of about `block_words` words; only one block is on the driver at a time."""
    block, held = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = alnum_words(row[1].encode()) if row[1] else []
        if words:
            block.append((row[0], words))
            held += len(words)
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def _merged(one: Spans, two: Spans) -> Spans:
    out: Spans = []
    for start, end in sorted([*one, *two]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _spans(column: pa.Array) -> list[Spans]:
    return [[(s["first"], s["end"]) for s in spans] for spans in column.to_pylist()]


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Words of each document that lie in an occurrence of a window of a benchmark item.

    Returns one row per document: doc_id, n_words, spans (array of [first, end) in words, apart from
    each other) and items (ids, as sorted distinct strings, of the items whose windows occur).

    Null, empty and wordless texts have no words and no hits; items without words are ignored; hits of an item
    with a null id count, but it is not listed. Repeated documents and items are each taken as they are, empty
    tables give no rows or no hits, and other columns are not read.
    """
    blocks = item_blocks(benchmark, item_id_col, item_text_col, block_words)
    first, second = next(blocks, []), next(blocks, None)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if second is None:
        out = rows.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast((first, window)), True), _found_schema(rows))
    else:
        rows = write_once(rows, "to-scan")
        out = _over_blocks(rows.data, chain([first, second], blocks), window, True).data
        rows.remove()
    listed = F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull())))
    return out.select(F.col("doc_id").alias(id_col), "n_words", "spans", listed.alias("items"))


def _found_schema(rows: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", _SPANS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )


def _finder(shared, every: bool):
    """What a broadcast block finds in rows (row, doc_id, text): in every row, or only rows with spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(*shared.value)
        for batch in batches:
            kept, counts, spans, items = [], [], [], []
            for i, text in enumerate(utf8(batch.column(2))):
                words = alnum_words(text)
                found, names = automaton.scan(words)
                if every or found:
                    kept.append(i)
                    counts.append(len(words))
                    spans.append([{"first": a, "end": b} for a, b in found])
                    items.append([*names])
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(counts, pa.int64()), pa.array(spans, _ARROW_SPANS), pa.array(items, pa.list_(pa.string()))], names=["row", "doc_id", "n_words", "spans", "items"])

    return work


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"first": a, "end": b} for a, b in _merged([], row)] for row in _spans(batch.column(3))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, _ARROW_SPANS), batch.column(4)], names=batch.schema.names)


def _over_blocks(rows: DataFrame, blocks: Iterable[list], window: int, every: bool) -> WrittenTable:
    """What all blocks find in the written `rows` (row, doc_id, text), by row.

    Each block is a job of its own: a worker holds one automaton and the driver one block, whatever their number. Only
    narrow rows are written and grouped; texts are read once for each block and do not move.
    """
    spark, schema, parts = rows.sparkSession, _found_schema(rows), []
    for block in blocks:
        shared = spark.sparkContext.broadcast((block, window))
        parts.append(write_once(rows.mapInArrow(_finder(shared, every and not parts), schema), "block"))
        shared.destroy()
    found = spark.read.schema(schema).parquet(*[part.path for part in parts])
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items")]
    found = found.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *lists)
    merged = write_once(found.mapInArrow(_merge, schema), "spans")
    for part in parts:
        part.remove()
    return merged


def _free(name: str, taken: list[str]) -> str:
    """A column name like `name` that is not taken."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def _without(data: bytes, spans: Spans) -> bytes:
    """The text without the words of the spans and what stands between them."""
    plain = np.frombuffer(b" " + data.translate(_ALNUM) + b" ", np.uint8) != 0x20
    edges = np.flatnonzero(plain[1:] != plain[:-1])
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, end in spans:
        out.append(data[at : starts[first]])
        at = int(ends[end - 1])
    return b"".join([*out, data[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    most_coverage: float = MOST_COVERAGE,
    block_words: int = BLOCK_WORDS,
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """The documents without their benchmark passages.

    Every span of at least `window` words, or of a whole shorter item, is cut from the text, again until
    none is left; a document with more than `most_coverage` of its words in spans is dropped. Columns stay as they
    are, but for the text and, where there is one, the number of its characters. Documents without spans are
    unchanged. Null and empty texts stay; empty tables and repeated rows are taken as they are.

    The result does not depend on the blocks. One block needs one pass; with several, the documents are
    written, pass them one after the other, and those that were cut pass all blocks again.
    """
    blocks = lambda: item_blocks(benchmark, item_id_col, item_text_col, block_words)
    few = list(islice(blocks(), 2))
    position, schema = docs.columns.index(text_col), docs.schema
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def with_texts(batch: pa.RecordBatch, texts: list[bytes | None], changed: dict[int, bytes]) -> list[pa.Array]:
        """Columns of a batch with the texts that changed, and their numbers of characters."""
        columns = list(batch.columns)[: len(schema)]
        if changed:
            for i, text in changed.items():
                texts[i] = text
            columns[position] = pa.array(texts, pa.binary()).cast(pa.string())
            if chars is not None:
                counts = columns[chars].to_pylist()
                for i, text in changed.items():
                    counts[i] = len(text.decode())
                columns[chars] = pa.array(counts, columns[chars].type)
        return columns

    def rewrite(shared):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = SuffixAutomaton(*shared.value)
            for batch in batches:
                texts, keep, changed = utf8(batch.column(position)), [], {}
                for i, text in enumerate(texts):
                    words = alnum_words(text)
                    spans, _ = automaton.scan(words)
                    keep.append(sum(b - a for a, b in spans) <= most_coverage * len(words))
                    while spans and keep[-1]:
                        text = changed[i] = _without(text, spans)
                        spans, _ = automaton.scan(alnum_words(text))
                batch = pa.RecordBatch.from_arrays(with_texts(batch, texts, changed), names=batch.schema.names)
                yield batch.filter(pa.array(keep, pa.bool_()))

        return work

    if len(few) <= 1:
        return docs.mapInArrow(rewrite(docs.sparkSession.sparkContext.broadcast((few[0], window))), schema) if few else docs
    row_col, spans_col, cut_col = (_free(name, docs.columns) for name in ("_row", "_spans", "_cut"))

    def cut(whole: bool):
        """Cut the spans; of `whole` documents, drop those with too many words in them."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, keep, changed = utf8(batch.column(position)), [], {}
                for i, spans in enumerate(_spans(batch.columns[-1])):
                    keep.append(not whole or sum(b - a for a, b in spans) <= most_coverage * len(alnum_words(texts[i])))
                    if spans and keep[-1]:
                        changed[i] = _without(texts[i], spans)
                was_cut = pa.array([i in changed for i in range(len(texts))], pa.bool_())
                yield pa.RecordBatch.from_arrays([*with_texts(batch, texts, changed), was_cut], names=[*batch.schema.names[:-1], cut_col]).filter(pa.array(keep, pa.bool_()))

        return work

    parts, todo, whole = [], docs, True
    while True:
        held = write_once(todo.withColumn(row_col, F.monotonically_increasing_id()), "to-scan")
        rows = held.data.select(F.col(row_col).alias("row"), F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        found = _over_blocks(rows, blocks(), window, False)
        spans = WrittenTable(found.data.select(F.col("row").alias(row_col), F.col("spans").alias(spans_col)), found.rows, found.path)
        joined = held.data.join(spans.sized_for_join(), row_col, "left")
        joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(spans_col, F.array().cast(_SPANS)).alias(spans_col))
        table = write_once(joined.mapInArrow(cut(whole), T.StructType([*schema.fields, T.StructField(cut_col, T.BooleanType())])), "decontaminated")
        held.remove()
        found.remove()
        parts.append(table.data.where(~F.col(cut_col)).drop(cut_col))
        todo, whole = table.data.where(cut_col).drop(cut_col), False
        if todo.isEmpty():
            return reduce(DataFrame.union, parts)
