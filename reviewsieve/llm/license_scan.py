"""Licence notices in whole texts, exact phrases and fuzzy ones.

A notice may occur with up to `errors` edits. Split into errors + 1 pieces, at least one piece
must then stand unchanged (pigeonhole), so all pieces are searched exactly, in one pass of an
Aho-Corasick automaton over the normalised text. Around each find, the regex library's
bounded-error matching decides and gives the span and the number of edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.llm.common import alnum_words, utf8

# Exact phrases and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)


@dataclass(frozen=True)
class Notice:
    """A short notice of normalised words, searched with up to `errors` edited characters."""

    label: str
    text: str
    errors: int


NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    Notice("cc-by", "creative commons attribution 4 0 international license", 4),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 2),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license", 4),
    Notice("reserved", "all rights reserved", 2),
)


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """The notice in errors + 1 pieces of near equal length, each with its offset."""
    n, parts = len(notice.text), notice.errors + 1
    edges = [n * i // parts for i in range(parts + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(edges, edges[1:])]


class NoticeSearch:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices = notices
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.errors}}}") for n in notices]
        self.seeds = ahocorasick.Automaton()
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for offset, piece in pieces(notice):
                by_piece.setdefault(piece, []).append((i, offset))
        for piece, uses in by_piece.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.any = bool(by_piece)
        if self.any:
            self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of each place, in characters of the normalised text."""
        windows: dict[int, list[list[int]]] = {}
        if self.any:
            for last, (length, uses) in self.seeds.iter(text):
                for i, offset in uses:
                    slack = 2 * self.notices[i].errors
                    start = last - length + 1 - offset - slack
                    end = start + len(self.notices[i].text) + 2 * slack
                    windows.setdefault(i, []).append([max(start, 0), end])
        found = []
        for i, places in windows.items():
            places.sort()
            joined: list[list[int]] = []
            for place in places:
                if joined and place[0] <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], place[1])
                else:
                    joined.append(place)
            for start, end in joined:
                for m in self.patterns[i].finditer(text, start, min(end, len(text))):
                    if m.end() > m.start():
                        found.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def _places(text: str, phrase: str) -> list[int]:
    """Starts, in characters, of all places of a phrase between word ends; text is padded with spaces."""
    out, at = [], text.find(f" {phrase} ")
    while at >= 0:
        out.append(at)
        at = text.find(f" {phrase} ", at + 1)
    return out


_MATCH = [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int64()), ("score", pa.float64())]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Notices of each text.

    Returns one row per document: doc_id, n_words, n_base (places of exact phrases), first_word and
    last_word (start of the first and the last such place, words from 0; null without), base_labels and labels
    (distinct, sorted, joined by commas; the second also has the fuzzy notices), score (1 for an exact phrase,
    else 1 - edits / length of the best fuzzy notice, 0 without) and matches (label, words of the span, edits and
    score of each fuzzy notice, in order).

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case; whole texts are
    read. Null and empty texts have no words and no notices. Each row stands for itself; other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_base", T.LongType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("base_labels", T.StringType()),
            T.StructField("labels", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField(
                "matches",
                T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("errors", T.LongType()), T.StructField("score", T.DoubleType())])),
            ),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(notices)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(_MATCH))]
        for batch in batches:
            rows = [scan_text(text, search) for text in utf8(batch.column(0 + 1))]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, schema).withColumnRenamed("doc_id", id_col)


def scan_text(data: bytes | None, search: NoticeSearch) -> tuple:
    words = alnum_words(data)
    text = " " + b" ".join(words).decode() + " "
    places, labels = [], set()
    for phrase, label in PHRASES:
        if at := _places(text, phrase):
            places += at
            labels.add(label)
    matches, found = [], search.find(text)
    # Places of the spaces, so that the word at a place is looked up and not counted from the start of the text.
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 0x20) if places or found else None
    before = lambda at: int(np.searchsorted(spaces, at))
    for i, start, end, errors in found:
        notice = search.notices[i]
        # Words that the span touches; a span may begin or end with a space.
        inner = text[start:end]
        begin = start + len(inner) - len(inner.lstrip(" "))
        stop = end - (len(inner) - len(inner.rstrip(" ")))
        first = before(begin) - 1
        matches.append({"label": notice.label, "first_word": first, "last_word": before(stop) - 1, "errors": errors, "score": 1 - errors / len(notice.text)})
    starts = [before(at) for at in (min(places), max(places))] if places else [None, None]
    score = 1.0 if places else max((m["score"] for m in matches), default=0.0)
    every = sorted(labels | {m["label"] for m in matches})
    return len(words), len(places), *starts, ",".join(sorted(labels)), ",".join(every), score, matches
