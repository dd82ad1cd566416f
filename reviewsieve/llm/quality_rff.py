"""Quality scores: random Fourier features, ridge regression by normal equations, isotonic calibration.

Statistics of each whole text are turned into random cosines whose inner products approximate a Gaussian
kernel. Ridge weights over them need only sums of products, which each task adds up over its rows and Spark adds up
over the tasks. Folds have sums of their own, so the models that have not seen a fold come from subtracting its sums, and
the calibration is fitted on scores of rows that their model has not seen. Calibration counts rows by
bins of the score and pools neighbours that violate the order.

Statistics and cosines are rounded to whole numbers before they are summed, so sums are exact and do not
depend on how rows are spread over tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewsieve.llm.common import utf8
from reviewsieve.session import write_once

FEATURES = 256  # random cosines
WIDTH = 3.0  # of the kernel, in standard deviations of a statistic
RIDGE = 1e-4  # for each row
SEED = 12
LIMIT = 4.0  # standard deviations beyond which statistics are not told apart
THRESHOLD = 0.7
FOLDS = 4
HELD_OUT = 2
BINS = 4096  # of raw scores between -0.5 and 1.5
UNIT = 1_000_000  # whole numbers for each unit of a statistic
_STEP = 1 << 15  # for each unit of a cosine
_ROWS = 8192  # rows of a matrix in memory at once

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _UPPER + _UPPER.lower()
STATISTICS = (
    "words", "word length", "spread of word lengths", "longest word", "single characters", "capitals", "symbols", "bars", "marks", "digits",
    "distinct words", "commonest word", "words equal to the one before", "repeated runs of three words", "repeated lines", "lines", "words before punctuation",
)


def statistics(data: bytes | None) -> list[float]:
    """The `STATISTICS` of one text; all 0 without a word."""
    words = data.split() if data else []
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.int64, n)
    mean = float(lengths.mean())

    def chars(of: bytes) -> int:
        return len(data) - len(data.translate(None, of))

    counts = Counter(words)
    runs = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 0
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        float(np.log(mean)),
        float(lengths.std()) / mean,
        float(np.log(lengths.max())),
        float((lengths == 1).mean()),
        chars(_UPPER) / max(chars(_LETTERS), 1),
        float(np.sqrt(chars(b"#*$%&|<>") / n)),
        float(np.sqrt(chars(b"|") / n)),
        float(np.sqrt(chars(b"!?") / n)),
        float(np.sqrt(chars(b"0123456789") / len(data))),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - runs / (n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines),
        float(np.sqrt(len(lines) / n)),
        sum(w[-1] in b".,;:" for w in words) / n,
    ]


def text_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x) of each document, x in whole numbers."""
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.rint(np.array(statistics(t)) * UNIT).astype(np.int64).tolist() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.int64()))], ["doc_id", "x"])

    schema = f"doc_id {kind.simpleString()}, x array<long>"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


@dataclass(frozen=True)
class FourierFeatures:
    """Random cosines of standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int) -> FourierFeatures:
        rng = np.random.default_rng(seed)
        return FourierFeatures(mean, scale, rng.normal(0, 1 / width, (len(mean), features)), rng.uniform(0, 2 * np.pi, features))

    def whole(self, x: np.ndarray) -> np.ndarray:
        """The cosines of each row as whole numbers, with a constant behind them."""
        z = np.cos(np.clip((x - self.mean) / self.scale, -LIMIT, LIMIT) @ self.waves + self.phase)
        return np.hstack([np.rint(z * _STEP), np.full((len(x), 1), float(_STEP))])


@dataclass(frozen=True)
class QualityModel:
    features: FourierFeatures
    weights: np.ndarray
    knots: np.ndarray  # raw scores
    levels: np.ndarray  # calibrated scores at the knots

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.features.whole(x) @ self.weights / _STEP
        return np.clip(np.interp(raw, self.knots, self.levels), 0.0, 1.0)


def ridge(products: np.ndarray, targets: np.ndarray, rows: int, strength: float) -> np.ndarray:
    """Ridge weights from the sums of z z' and of z y; the constant, which comes last, is not shrunk."""
    penalty = np.full(len(targets), strength * max(rows, 1))
    penalty[-1] = 1e-9
    return np.linalg.solve(products + np.diag(penalty), targets)


def isotonic(places: np.ndarray, weights: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function nearest to `values`, as knots (mean place of each block) and levels."""
    blocks: list[list[float]] = []  # weight, sum of values, sum of places
    for p, w, v in zip(places, weights, values):
        blocks.append([w, w * v, w * p])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    w, v, p = np.array(blocks).T
    return p / w, v / w


def _sums(training: DataFrame, features: FourierFeatures) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """Per fold the sums of z z' and z y, and the rows."""
    size = len(features.phase) + 1
    upper = np.triu_indices(size)
    cells = len(upper[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                z, y, fold = features.whole(_matrix(part.column(0))), part.column(1).to_numpy(), part.column(2).to_numpy()
                for f in np.unique(fold).tolist():
                    mine = z[fold == f]
                    # Products of whole numbers below 2**30, some thousand of them: exact.
                    sums = np.concatenate([(mine.T @ mine)[upper], mine.T @ np.rint(y[fold == f] * _STEP), [len(mine)]]).astype(np.int64)
                    total[f] = total[f] + sums if f in total else sums
        for f, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sums), f, np.int32)), pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["fold", "cell", "total"])

    parts = training.select("x", "y", "fold").mapInArrow(add, "fold int, cell int, total long")
    found: dict[int, np.ndarray] = {}
    for row in parts.groupBy("fold", "cell").agg(F.sum("total").alias("total")).toLocalIterator():
        found.setdefault(row["fold"], np.zeros(cells + size + 1))[row["cell"]] = row["total"]
    out = {}
    for f, sums in found.items():
        products = np.zeros((size, size))
        products[upper] = sums[:cells]
        products = products + np.triu(products, 1).T
        out[f] = products / _STEP**2, sums[cells:-1] / _STEP**2, int(sums[-1])
    return out


def fit(training: DataFrame, features: int = FEATURES, width: float = WIDTH, strength: float = RIDGE, seed: int = SEED) -> QualityModel | None:
    """Model of rows (x, y, fold), y between 0 and 1; None without a row.

    Every row is used. The driver gets sums whose number depends on `features` and `BINS` only.
    """
    n = len(STATISTICS)
    cell = training.select(F.posexplode("x").alias("i", "v")).withColumn("v", F.col("v").cast("decimal(20,0)"))
    moments = {r["i"]: r for r in cell.groupBy("i").agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).collect()}
    if not moments:
        return None
    rows = moments[0]["n"]
    mean = np.array([float(moments[i]["s"]) / rows for i in range(n)])
    spread = np.array([max(float(moments[i]["q"]) / rows - mean[i] ** 2, 0.0) for i in range(n)]) ** 0.5
    cosines = FourierFeatures.draw(mean, np.maximum(spread, 1e-3 * UNIT), features, width, seed)

    sums = _sums(training, cosines)
    whole = [sum(s[k] for s in sums.values()) for k in range(3)]
    weights = ridge(*whole, strength)
    # Each fold is scored by the model of the others; a fold that is alone by the model of all.
    others = {f: ridge(*[t - p for t, p in zip(whole, part)], strength) if part[2] < whole[2] else weights for f, part in sums.items()}

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = cosines.whole(_matrix(batch.column(0))), batch.column(2).to_numpy()
            raw = np.zeros(len(z))
            for f, w in others.items():
                raw[fold == f] = z[fold == f] @ w / _STEP
            place = np.clip(np.rint((raw + 0.5) * BINS / 2), 0, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], ["bin", "y"])

    scored = training.select("x", "y", "fold").mapInArrow(bins, "bin int, y double")
    counted = sorted(scored.groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).collect())
    place, weight, value = (np.array(c, np.float64) for c in zip(*counted))
    return QualityModel(cosines, weights, *isotonic(place * 2 / BINS - 0.5, weight, value))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of `docs`.

    A document's fold is crc32 of its id as text modulo `FOLDS`; labels of the fold `HELD_OUT` are never read. Labels other than 0
    and 1 and null ids are passed over, and several labels of one id count with their mean. Null and empty
    texts have statistics of 0 and are scored like others; a null id is not held out. Repeated rows are rows of their own, with
    equal scores. Without any label all scores are 0.5; with one class only, they are its label. An empty table gives
    no row. Columns other than the named ones are not read.
    """
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0)).cast("int")
    table = write_once(text_statistics(docs, id_col, text_col).withColumn("fold", fold), "text-statistics")
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    known = known.where(fold != HELD_OUT).groupBy("doc_id").agg(F.avg("y").alias("y"))
    training = write_once(table.data.join(write_once(known, "labels").sized_for_join(), "doc_id").select("x", "y", "fold"), "training")
    model = fit(training.data)
    training.remove()
    kind = table.data.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1))) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score)], ["doc_id", "fold", "score"])

    scored = table.data.mapInArrow(work, f"doc_id {kind}, fold int, score double")
    return scored.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
