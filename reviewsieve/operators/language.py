"""Language identification by character trigrams.

Profiles are trained from labelled text as a grouping job. Detection scores each text where it is: an
Arrow-batched function looks up the trigrams of a batch as packed numbers in numpy and adds up their weights, from a
broadcast of the profiles, so no row moves and the input is read once. The weights are integers, so
every engine and every partitioning gives the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewsieve.fixed_values import KEEP_UNDETECTABLE, PROFILE_SIZE, TARGET_LANGUAGE
from reviewsieve.session import write_once

# Characters that are scored together. A longer text is cut between words and its sums are added up.
PIECE = 1 << 18
# Up to this many packed trigrams a table holds the place of each; beyond it, known ones are searched in order.
TABLE = 1 << 22

# Every position of a word, one code point at a time, with the three characters
# that start there.
TRIGRAM = "(?=(.{3}))."


def letters_only(text: Column) -> Column:
    """Lower-case words separated by single spaces; everything else is dropped."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def _words(text: Column) -> Column:
    return F.split(letters_only(text), " ")


def _trigrams(word: Column) -> Column:
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(TRIGRAM), 1)


def _word_counts(labeled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return (
        labeled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.explode(_words(F.col(text_col))).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("uses"))
    )


def _profiles(word_counts: DataFrame, k: int) -> DataFrame:
    grams = (
        word_counts.select("lang", "uses", F.explode(_trigrams(F.col("word"))).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.sum("uses").alias("uses"))
    )
    by_frequency = Window.partitionBy("lang").orderBy(F.desc("uses"), F.asc("gram"))
    return (
        grams.withColumn("rank", F.row_number().over(by_frequency))
        .where(F.col("rank") <= k)
        .select("lang", "gram", "rank")
    )


def build_language_profiles(
    labeled: DataFrame, k: int = PROFILE_SIZE, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The `k` most frequent trigrams of each language with their rank.

    Counting words first keeps the shuffles at the size of the vocabulary.
    The rank filter is applied before the last shuffle as well, so no task
    holds more than `k` trigrams of a language per input partition.
    """
    return _profiles(_word_counts(labeled, text_col, lang_col), k)


@dataclass(frozen=True)
class LanguageModel:
    """Weights of trigrams: for each, a few pairs of (language, weight).

    At most `k` trigrams of each language are known, whatever the size of the labelled text. The driver holds
    them, and a session broadcasts them to the tasks of each query.
    """

    languages: tuple[str, ...]
    weights: dict[str, tuple[tuple[int, int], ...]]


def train_language_model(
    labeled: DataFrame,
    k: int = PROFILE_SIZE,
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Profiles of the labelled text as a model.

    A trigram of rank r weighs k + 1 - r, an unknown one nothing. The language
    with the highest sum is the one with the lowest sum of ranks when unknown
    trigrams are charged k + 1.
    """
    counts = write_once(_word_counts(labeled, text_col, lang_col), "word-counts")
    try:
        profiles = _profiles(counts.data, k).collect()
    finally:
        counts.remove()
    if not profiles:
        raise ValueError("the labelled text holds no words to build a profile from")
    languages = tuple(sorted({row["lang"] for row in profiles}))
    place = {lang: i for i, lang in enumerate(languages)}
    weights: dict[str, list[tuple[int, int]]] = {}
    for row in profiles:
        weights.setdefault(row["gram"], []).append((place[row["lang"]], k + 1 - row["rank"]))
    return LanguageModel(languages, {gram: tuple(w) for gram, w in weights.items()})


def language_of(text: Column, model: LanguageModel, spark: SparkSession) -> Column:
    """Language of a text: null for a null text and where no trigram is known."""
    shared, piece, most = spark.sparkContext.broadcast((model.languages, model.weights)), PIECE, TABLE

    # All that runs in a task is inside, so that it travels with the query.
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        languages, weights = shared.value
        # Characters of the profiles are numbered from 1, all others are 0, and a trigram is a number of three such digits.
        letters = sorted({letter for gram in weights for letter in gram})
        number = np.zeros(0x110000, np.int32)
        number[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        base = len(letters) + 1
        points = np.array([[ord(letter) for letter in gram] for gram in weights])
        packed = number[points].astype(np.int64) @ np.array([base * base, base, 1])
        order = np.argsort(packed)
        known = packed[order]
        # A row of weights for each language; the last place is that of unknown trigrams.
        by_language = np.zeros((len(languages), len(known) + 1), np.int32)
        found = list(weights.values())
        for place, gram in enumerate(order):
            for language, weight in found[gram]:
                by_language[language, place] = weight
        table = None
        if base**3 <= most:
            table = np.full(base**3, len(known), np.int32)
            table[known] = np.arange(len(known))
            number = number.astype(np.int16 if base < 1 << 15 else np.int32)

        def places(codes: np.ndarray) -> np.ndarray:
            if table is not None:
                return table[codes]
            at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            return np.where(known[at] == codes, at, len(known))

        def score(words: list[str]) -> np.ndarray:
            """Sums of weights, languages by texts; a trigram belongs to the character in its middle."""
            joined = f" {' '.join(words)} ".encode("utf-32-le")
            digits = number[np.frombuffer(joined, "<u4")].astype(np.int64 if table is None else np.int32)
            at = places((digits[:-2] * base + digits[1:-1]) * base + digits[2:])
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            starts = np.cumsum(sizes) - sizes
            return np.stack([np.add.reduceat(row[at], starts, dtype=np.int64) for row in by_language])

        def pieces(texts: list[str | None]) -> Iterator[tuple[int, str]]:
            for row, words in enumerate(texts):
                start = 0
                while words and start < len(words):
                    end = words.find(" ", start + piece) if len(words) - start > piece else -1
                    end = len(words) if end < 0 else end
                    yield row, words[start:end]
                    start = end + 1

        for batch in batches:
            sums = np.zeros((len(languages), len(batch)), np.int64)
            rows, held, size = [], [], 0
            for row, words in pieces(batch.to_pylist()):
                rows.append(row)
                held.append(words)
                size += len(words)
                if size >= piece:
                    np.add.at(sums, (slice(None), rows), score(held))
                    rows, held, size = [], [], 0
            if held:
                np.add.at(sums, (slice(None), rows), score(held))
            # Languages are in alphabetical order, so a tie goes to the first of them.
            yield pa.array(languages, pa.string()).take(pa.array(sums.argmax(axis=0), mask=sums.max(axis=0) == 0))

    return F.arrow_udf(detect, "string")(letters_only(text))


def detect_language(
    df: DataFrame,
    text_col: str,
    model: LanguageModel,
    target: str = TARGET_LANGUAGE,
    enabled: bool = True,
) -> DataFrame:
    """Add `language`: null where undetectable, the target where the text is empty.

    With `enabled=False` every row gets the target.
    """
    if not enabled:
        return df.withColumn("language", F.lit(target))
    text = F.coalesce(F.col(text_col), F.lit(""))
    detected = language_of(text, model, df.sparkSession)
    return df.withColumn("language", F.when(text == "", F.lit(target)).otherwise(detected))


def language_accepted(
    language: Column, target: str = TARGET_LANGUAGE, keep_undetectable: bool = KEEP_UNDETECTABLE
) -> Column:
    return F.when(language.isNull(), F.lit(keep_undetectable)).otherwise(language == target)


def language_filter(
    df: DataFrame,
    text_col: str,
    model: LanguageModel,
    target: str = TARGET_LANGUAGE,
    keep_undetectable: bool = KEEP_UNDETECTABLE,
    enabled: bool = True,
) -> DataFrame:
    """Add `language` and `accepted`."""
    detected = detect_language(df, text_col, model, target, enabled)
    return detected.withColumn(
        "accepted", language_accepted(F.col("language"), target, keep_undetectable)
    )
