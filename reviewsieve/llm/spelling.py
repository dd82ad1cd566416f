"""Groups of spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart, let the first be the shorter (or either, if equally long). It is cut into two
disjoint chunks; one edit leaves one of them whole in the other word, at its own place or, behind an insertion, one place
further on. The other word contributes all its positional grams of the chunks' lengths that can lie there, so an equi-join
on chunk and gram finds the pair, and comparing the words verifies it.

Long vocabularies have chunks that thousands of words share. The rest of the word, which holds the edit, is
therefore cut into two disjoint chunks again, and one of these is whole too: the key is a chunk with
one half of the rest, in all four ways. What a key leaves open is a quarter of the word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.llm.common import join_unique, utf8
from reviewsieve.session import write_once

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
DOMINANCE = 5  # a form is at least so many times as frequent
NOISE = 199  # one run of so many loses a letter
FLUSH = 200_000  # distinct words counted in a task before they are sent on

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, id_col: str, text_col: str, noise: int = NOISE, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all runs of letters, A-Z in lower case, in whole texts; n may come in several parts.

    A run whose hash with its document's id `noise` divides loses one letter, as a typing error would. Equal runs of a
    document have equal hashes, so each is looked at once; counts are added up before they leave the task.
    """
    pattern, schema = f"[{LETTERS}]+", pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, total = re.compile(pattern).findall, Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
            total.clear()
            return out

        for batch in batches:
            for doc_id, data in zip(utf8(batch.column(0)), utf8(batch.column(1))):
                prefix = zlib.crc32((doc_id or b"") + b":")
                for run, n in Counter(runs(data.translate(_LOWER).decode())).items() if data else ():
                    h = zlib.crc32(run.encode(), prefix)
                    if h % noise == 0:
                        i = h % len(run)
                        run = run[:i] + run[i + 1 :]
                    if len(run) >= least_length:
                        total[run] += n
                if len(total) >= FLUSH:
                    yield flush()
        if total:
            yield flush()

    return docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")


def _key(first: Column, second: Column, place: int, length: Column) -> Column:
    """64-bit hash of a chunk, half of the rest, their places and the length of the word that was cut."""
    return F.xxhash64(F.lit(place), length, first, second)


def _cuts(length: Column) -> tuple[Column, ...]:
    """Where a word of `length` is cut: into chunks at the second place, and these into halves at the others."""
    middle = F.floor(length / 2).cast("int")
    return F.floor(middle / 2).cast("int"), middle, (middle + F.floor((length - middle) / 2)).cast("int")


def _part(word: Column, start: Column, end: Column) -> Column:
    return F.substring(word, start + 1, end - start)


def chunk_keys(word: Column) -> Column:
    """The four keys of a word that is cut: each chunk with each half of the other."""
    n, zero = F.length(word), F.lit(0)
    a, b, c = _cuts(n)
    low, high = _part(word, zero, b), _part(word, b, n)
    return F.array(
        _key(low, _part(word, b, c), 0, n),
        _key(low, _part(word, c, n), 1, n),
        _key(high, _part(word, zero, a), 2, n),
        _key(high, _part(word, a, b), 3, n),
    )


def gram_keys(word: Column) -> Column:
    """Keys of a word's positional grams: those of words of its length, and of words one letter shorter.

    In the latter case whatever lies behind the inserted letter is shifted by one.
    """
    keys, zero = [], F.lit(0)
    for more in (0, 1):
        size, n = F.length(word), F.length(word) - more
        a, b, c = _cuts(n)
        low, high = _part(word, zero, b), _part(word, b + more, size)
        keys += [
            # The edit lies in the last quarter; in the third, so that the last is shifted; in the second; in the first.
            _key(low, _part(word, b, c), 0, n),
            _key(low, _part(word, c + more, size), 1, n),
            _key(high, _part(word, zero, a), 2, n),
            _key(high, _part(word, a + more, b + more), 3, n),
        ]
    return F.array(*keys)


def near_words(short: Column, long: Column) -> Column:
    """Whether two words are exactly one inserted, deleted or replaced code point apart; a distance above 1 is not computed."""
    return F.levenshtein(short, long, 1) == 1


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, b) of all words of `vocabulary` (unique in `word`) that are one edit apart, each pair once, `a` not longer."""
    cut = vocabulary.select(F.col("word").alias("a"), F.explode(chunk_keys(F.col("word"))).alias("key"))
    grams = vocabulary.select(F.col("word").alias("b"), F.explode(gram_keys(F.col("word"))).alias("key"))
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    found = cut.join(grams, "key").where(once & F.length("b").between(F.length("a"), F.length("a") + 1) & near_words(F.col("a"), F.col("b")))
    return found.select("a", "b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """(word, root): from each `word`, follow `form` to the last.

    `links` is unique in `word`. Counts grow at least fivefold with each step, so a path has at
    most some 27 links, and as each round doubles what was followed, five rounds at most do.
    """
    table = write_once(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        weight = table.data.groupBy(F.col("root").alias("word")).agg(F.count("*").alias("w"))
        onward = table.data.select("word", F.col("root").alias("next")).join(weight, "word")
        step = write_once(onward.select(F.col("word").alias("root"), "next", "w"), "root-steps")
        if not step.rows:
            step.remove()
            return table.data
        total = max(table.rows, 1)
        ahead = join_unique(table.data, step.data, "root", "w", total, "left")
        following = write_once(ahead.select("word", F.coalesce("next", "root").alias("root")), "roots")
        step.remove()
        table.remove()
        table = following


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, dominance: int = DOMINANCE
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of at least `least_length` letters and `least_count` occurrences.

    `form` is the most frequent word one edit away (ties: the first in the order of code points) if it is
    `dominance` times as frequent, else null; `root` is the last form reached, or the word itself. Null and empty texts
    have no words, a null id counts as empty in the hash, repeated rows count again, and texts are taken whole. An empty
    table gives no row. Other columns are not read.
    """
    counts = word_counts(docs, id_col, text_col, noise, least_length).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = write_once(counts.where(F.col("n") >= least_count), "vocabulary")
    pairs = write_once(near_pairs(vocabulary.data.select("word")), "near-words")
    both = pairs.data.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.data.select("b", "a"))
    frequency = vocabulary.data.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    partners = both.join(frequency, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = vocabulary.data.join(partners, "word", "left")
    strong = -F.col("best.n") >= dominance * F.col("n")
    judged = write_once(
        joined.select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, -F.col("best.n")).alias("form_n"),
        ),
        "judged",
    )
    vocabulary.remove()
    pairs.remove()
    last = roots(judged.data.where("form IS NOT NULL").select("word", "form"))
    return judged.data.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
