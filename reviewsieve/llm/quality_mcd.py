"""Quality rules from robust multivariate outliers, with DataFrame operations only.

Each text gets a vector of transformed statistics. Per language and source, the minimum covariance
determinant gives a centre and a covariance that a quarter of odd texts cannot move: concentration
steps take the three quarters of the vectors that are nearest in the present metric and compute mean
and covariance anew. Of two starts the one with the smaller determinant is taken, then reweighted. Texts whose
Mahalanobis distance is beyond the cut-off are rejected.

A step is one aggregation: moments are summed up by group and bin of distance, so that the bin with
the h-th smallest distance and the moments up to it come from a few hundred rows of each group. Vectors
are whole numbers and sums are exact, so results do not depend on the order in which rows are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewsieve.session import WrittenTable, write_once

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MIN_GROUP = 50  # distinct vectors needed for an estimate
SUBSET = 0.75
STEPS = 3
REWEIGHT = 0.975
# Squared distance: chi-square of 4 degrees of freedom, tail probability 1e-6.
CUTOFF = 33.38
# Spread below which a statistic is not told apart: relative word length, root of symbols for each
# word, share of repeated lines, share of repeated words.
FLOORS = (0.05, 0.1, 0.1, 0.1)
UNIT = 10_000  # whole numbers for each unit of a statistic
BINS = 32  # of distance, for each factor of e

N = len(FLOORS)
_X = [f"x{i}" for i in range(N)]
_PAIRS = [(i, j) for i in range(N) for j in range(i + 1)]
_SPACE = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, window: int = 3) -> Column:
    """Number of words in runs of `window` words that occur twice or more in the array.

    Hashes of all runs are sorted with their places; neighbours of equal hash are repeats.
    """

    def count(runs: Column) -> Column:
        def twice(k: Column) -> Column:
            h = F.get(runs, k)["h"]
            before, after = F.get(runs, k - 1)["h"], F.get(runs, k + 1)["h"]
            return F.coalesce(h == before, F.lit(False)) | F.coalesce(h == after, F.lit(False))

        repeats = F.filter(F.sequence(F.lit(0), F.size(runs) - 1), twice)
        places = F.array_sort(F.transform(repeats, lambda k: F.get(runs, k)["at"]))
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        add = lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(window), at - s["last"])).alias("n"))
        return F.aggregate(places, start, add, lambda s: s["n"].cast("long"))

    def runs(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - window)
        return F.sort_array(F.transform(places, lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(window)]).alias("h"), i.alias("at"))))

    return _let(words, lambda w: F.when(F.size(w) > window, _let(runs(w), count)).otherwise(F.lit(0).cast("long")))


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    """Counts over each whole text, and its vector of transformed statistics. `more` columns come along."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    along = [docs.select(c).columns[0] for c in more]
    cut = docs.select(
        *more,
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        text.alias("text"),
        F.filter(F.split(text, _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    counted = cut.select(
        *along,
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.size(F.regexp_extract_all("text", F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    vector = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / words,
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *[F.round(v * UNIT).cast("long").alias(x) for v, x in zip(vector, _X)])


def _groups(vectors: DataFrame, min_group: int) -> DataFrame:
    """Key of the estimate of each language and source: its own, else the rest of the language, else the rest."""
    counts = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = counts.withColumn("own", F.col("n") >= min_group)
    counts = counts.withColumn("rest", F.sum("n").over(Window.partitionBy("lang", "own")))
    counts = counts.withColumn("level", F.when(F.col("own"), 0).when(F.col("rest") >= min_group, 1).otherwise(2))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy("level")))
    key = (
        F.when(F.col("level") == 0, F.to_json(F.struct("level", "lang", "source")))
        .when(F.col("level") == 1, F.to_json(F.struct("level", "lang")))
        .when(F.col("all") >= min_group, F.to_json(F.struct("level")))
    )
    return counts.select("lang", "source", key.alias("key"))


def _with_key(rows: DataFrame, groups: WrittenTable) -> DataFrame:
    named = groups.sized_for_join().alias("g") if isinstance(groups, WrittenTable) else groups
    same = rows["lang"].eqNullSafe(F.col("g.lang")) & rows["source"].eqNullSafe(F.col("g.source"))
    return rows.join(named, same, "left").select(rows["*"], F.col("g.key").alias("key"))


def _distance() -> Column:
    """Squared Mahalanobis distance of x to centre m, by forward substitution through the Cholesky factor l."""
    z: list[Column] = []
    for i in range(N):
        rest = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def _cholesky(estimate: DataFrame) -> DataFrame:
    """Lower factor l of the covariance c, and the logarithm of its determinant."""
    for i in range(N):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return estimate.withColumn("logdet", 2 * sum((F.log(f"l{i}{i}") for i in range(N)), F.lit(0.0)))


def _chi4(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def _quantile4(p: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi4(middle) < p else (low, middle)
    return low


def _consistency(p: float) -> float:
    """Factor that makes the covariance of the nearest share `p` of normal vectors that of all."""
    return p / _chi6(_quantile4(p))


def _estimate(vectors: DataFrame, state: DataFrame | None, share: float, within: float | None = None) -> DataFrame:
    """Mean and covariance of the nearest `share` of the vectors of each key and start, or of those `within` a distance.

    Without a state, distances are from the middle of the floors' metric that the vectors bring along.
    """
    by = ["key", "start"]
    rows = vectors if state is None else vectors.join(state, by)
    distance = F.col("d0") if state is None else _distance()
    binned = rows.withColumn("bin", F.floor(F.log1p(distance) * BINS).cast("int"))
    if within is not None:
        binned = binned.where(distance <= within)
    exact = lambda c: F.sum(c.cast("decimal(20,0)")).cast("decimal(38,0)")
    sums = [exact(F.col(x)).alias(f"s{i}") for i, x in enumerate(_X)] + [exact(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]
    names = [f"s{i}" for i in range(N)] + [f"q{i}{j}" for i, j in _PAIRS]
    moments = binned.groupBy(*by, "bin").agg(F.count("*").alias("n"), *sums)
    if within is None:
        whole = Window.partitionBy(*by)
        below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        before, total = F.coalesce(F.sum("n").over(below), F.lit(0)), F.sum("n").over(whole)
        # Bins up to the one in which the h-th smallest distance lies.
        moments = moments.withColumn("_before", before).withColumn("_total", total).where(F.col("_before") < F.ceil(F.col("_total") * share))
    sums = moments.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).cast("double").alias(c) for c in names])
    factor = _consistency(share)
    means = sums.select(*by, "n", *[(F.col(f"s{i}") / F.col("n") / UNIT).alias(f"m{i}") for i in range(N)], *[(F.col(f"q{i}{j}") / F.col("n") / (UNIT * UNIT)).alias(f"q{i}{j}") for i, j in _PAIRS])
    spread = means.select(
        *by,
        "n",
        *[f"m{i}" for i in range(N)],
        *[(factor * (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in _PAIRS],
    )
    return _cholesky(spread).select(*by, "n", *[f"m{i}" for i in range(N)], *[f"l{i}{j}" for i, j in _PAIRS], "logdet")


def _medians(vectors: DataFrame) -> DataFrame:
    """Middle value of each statistic by key; whole numbers are counted, so groups of any size are fine."""
    stacked = vectors.select("key", F.posexplode(F.array(*_X)).alias("i", "x")).groupBy("key", "i", "x").agg(F.count("*").alias("n"))
    w = Window.partitionBy("key", "i")
    running = F.sum("n").over(w.orderBy("x"))
    middle = stacked.withColumn("up", running).withColumn("total", F.sum("n").over(w)).where(F.col("up") * 2 >= F.col("total"))
    return middle.groupBy("key").agg(*[F.min(F.when(F.col("i") == i, F.col("x"))).alias(f"middle{i}") for i in range(N)])


def mcd(vectors: DataFrame) -> WrittenTable:
    """Reweighted minimum covariance determinant of each key: centre m, Cholesky factor l."""
    medians = write_once(_medians(vectors), "medians")
    from_middle = sum((F.pow((F.col(f"x{i}") - F.col(f"middle{i}")) / (UNIT * FLOORS[i]), F.lit(2)) for i in range(N)), F.lit(0.0))
    near = vectors.join(medians.sized_for_join(), "key").withColumn("d0", from_middle)
    # Start 0: the vectors nearest to the middle. Start 1: all vectors.
    starts = near.select("key", *_X, "d0", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    first = _estimate(starts.where("start = 0"), None, SUBSET).union(_estimate(starts.where("start = 1"), None, 1 - 1e-9))
    state = write_once(first, "mcd")
    for _ in range(STEPS):
        following = write_once(_estimate(starts, state.sized_for_join(), SUBSET), "mcd")
        state.remove()
        state = following
    lowest = state.data.groupBy("key").agg(F.min(F.struct("logdet", "start")).alias("best"))
    best = state.data.join(lowest, (state.data["key"] == lowest["key"]) & (state.data["start"] == lowest["best.start"]), "left_semi")
    best = write_once(best, "mcd")
    final = write_once(_estimate(starts, best.sized_for_join(), REWEIGHT, _quantile4(REWEIGHT)), "mcd")
    for table in (medians, state, best):
        table.remove()
    return final


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """Statistics and verdict of each document.

    Returns one row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (too few words or too many repeated ones), kept, distance (squared; null without an estimate).

    Only documents that pass the base rules, and each distinct vector of a language and source once, make
    estimates, so copies have no weight. A language and source with fewer than `min_group` such vectors is judged with
    the small ones of its language, these if still too few with all others left; if those are too few,
    the base rules alone decide. A null language or source counts as a value. A null text has no words and fails, as
    does an empty one. Repeated rows get equal verdicts; empty tables give no rows; other columns are not read.
    """
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return _judged(write_once(statistics(docs, id_col, text_col, lang_col, source_col), "statistics"), min_group, cutoff, columns).withColumnRenamed("doc_id", id_col)


def accepted_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """The documents that `quality_verdicts` keeps, with all their columns, unchanged.

    Documents are written once beside their statistics, so that the verdict needs no join of texts.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = write_once(statistics(docs, id_col, text_col, lang_col, source_col, whole), "statistics")
    return _judged(rows, min_group, cutoff, ["whole"]).where("kept").select("whole.*")


def _judged(rows: WrittenTable, min_group: int, cutoff: float, columns: list[str]) -> DataFrame:
    vectors = write_once(rows.data.where("NOT base_failed").select("lang", "source", *_X).distinct(), "vectors")
    groups = write_once(_groups(vectors.data, min_group), "groups")
    keyed = write_once(_with_key(vectors.data, groups).where("key IS NOT NULL").select("key", *_X), "vectors")
    estimates = mcd(keyed.data)
    judged = _with_key(rows.data, groups).join(estimates.sized_for_join().drop("n", "logdet", "start"), "key", "left").withColumn("distance", _distance())
    return judged.select(
        *columns,
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"),
        "distance",
    )
