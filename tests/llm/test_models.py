"""Clustering, quality scores and spelling variants beside brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewsieve.llm import heap_kmeans, quality_rff, spelling
from tests.llm.plain import area_under_curve, pool_adjacent

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


# --- clustering ------------------------------------------------------------------------


def lloyd(rows, dimensions, clusters, rounds):
    """Plain rounds over all vectors, in Python integers."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[near(v)[0]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    placed = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, j, d in placed:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in placed), key=repr)


def clustered(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(7) for c in ("cluster", "key", "vector", "was", "distance")})
    return sorted(map(tuple, heap_kmeans.centroid_clusters(df.repartition(3), **options).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_are_those_of_plain_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(0, 0.3, 6)]) for i in range(400)]
    assert clustered(spark, rows, dimensions=6, clusters=7, rounds=6) == lloyd([(i, np.float32(v).tolist()) for i, v in rows], 6, 7, 6)


def test_clusters_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float(i % 3), 0.5]) for i in range(30)]  # ties and copies
    rows += [(1, [9.0, 9.0]), (1, [9.0, 9.0]), (None, [-4.0, 2.0]), (50, None), (51, []), (52, [1.0]), (53, [1.0, 2.0, 3.0]), (54, [1.0, None]), (55, [inf, 1.0]), (56, [nan, 1.0])]
    got = clustered(spark, rows, dimensions=2, clusters=6, rounds=3)
    assert got == lloyd(rows, 2, 6, 3)
    assert len(got) == 33
    assert clustered(spark, rows[:2], dimensions=2, clusters=6, rounds=3) == lloyd(rows[:2], 2, 6, 3)
    assert clustered(spark, [(5, [1.0, 1.0])], dimensions=2) == lloyd([(5, [1.0, 1.0])], 2, 40, 5)
    assert clustered(spark, [(5, None)], dimensions=2) == clustered(spark, [], dimensions=2) == []
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(5, [1e30, 1.0])], dimensions=2)


def test_only_expired_vectors_are_rescanned(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.eye(4)[i % 4] * 50 + rng.normal(0, 0.05, 4)]) for i in range(400)]
    rescanned, write = [], heap_kmeans.write_once

    def spy(df, label):
        table = write(df, label)
        rescanned.append(table.rows) if label == "heap-run" else None
        return table

    monkeypatch.setattr(heap_kmeans, "write_once", spy)
    assert clustered(spark, rows, dimensions=4, clusters=4, rounds=5) == lloyd([(i, np.float32(v).tolist()) for i, v in rows], 4, 4, 5)
    assert rescanned[0] == 400 and rescanned[-1] == 0


# --- quality ---------------------------------------------------------------------------


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality_rff.quality_scores(docs, labels)
    assert dict(scores.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = scores.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert area_under_curve([r.score for r in held], [r.quality for r in held]) > 0.99
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    assert sorted(quality_rff.quality_scores(docs, labels).collect()) == sorted(quality_rff.quality_scores(other.repartition(5), turned).collect())


def test_model_is_kernel_ridge_on_its_features(spark):
    """Sums by fold against numpy over all rows at once; features against the kernel; bins against pooling."""
    rng = np.random.default_rng(5)
    n = len(quality_rff.STATISTICS)
    x = np.rint(rng.normal(0, 1, (600, n)) * quality_rff.UNIT).astype(int)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    fold = rng.choice([0, 1, 3], 600)
    df = spark.createDataFrame([(a.tolist(), float(b), int(c)) for a, b, c in zip(x, y, fold)], "x array<long>, y double, fold int").repartition(3)
    model = quality_rff.fit(df, features=64)
    standard = (x - x.mean(axis=0)) / x.std(axis=0)
    z = np.hstack([np.cos(np.clip(standard, -4, 4) @ model.features.waves + model.features.phase), np.ones((600, 1))])
    solve = lambda m: np.linalg.solve(z[m].T @ z[m] + np.diag([quality_rff.RIDGE * m.sum()] * 64 + [1e-9]), z[m].T @ y[m])
    everything = np.ones(600, bool)
    assert np.allclose(model.weights, solve(everything), atol=1e-2)
    raw = np.zeros(600)
    for f in (0, 1, 3):
        raw[fold == f] = z[fold == f] @ solve(fold != f)
    levels = pool_adjacent(raw, y)
    assert np.abs(np.interp(raw, model.knots, model.levels) - levels).mean() < 0.05
    assert (np.diff(model.levels) > 0).all() and (np.diff(model.knots) > 0).all()

    wide = quality_rff.FourierFeatures.draw(np.zeros(n), np.full(n, float(quality_rff.UNIT)), 4000, 3.0, 1)
    some = wide.whole(x[:20])[:, :-1] / (1 << 15)
    gap = ((np.clip(x[:20] / quality_rff.UNIT, -4, 4)[:, None] - np.clip(x[:20] / quality_rff.UNIT, -4, 4)[None]) ** 2).sum(axis=2)
    assert np.abs(2 * some @ some.T / 4000 - np.exp(-gap / 18)).max() < 0.1


def test_scores_of_odd_rows(spark):
    schema = "doc_id long, text string, score string, x int, fold string, y int"
    rows = [(i, "good plain words of a text " * (i % 7 + 2) if i % 2 else "### $$$ ### !!", "a", 1, "b", 2) for i in range(40)]
    rows += [(100, None, "", 0, "", 0), (101, "", "", 0, "", 0), (102, " \n ", "", 0, "", 0), (None, "no id", "", 0, "", 0), (103, "longword " * 200_000, "", 0, "", 0), (3, rows[3][1], "", 0, "", 0)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    labels = [(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (1, None, 0), (5, 7, 0), (7, 0, 0), (7, 1, 0), (999, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    got = quality_rff.quality_scores(docs, table).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[100].score == by_id[101].score == by_id[102].score and not by_id[None].held_out
    assert min(by_id[i].score for i in range(9, 40, 2)) > max(by_id[i].score for i in range(8, 40, 2))
    assert {r.score for r in got if r.doc_id == 3} == {by_id[3].score}
    none = quality_rff.quality_scores(docs, table.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert {r.score for r in quality_rff.quality_scores(docs, table.where("quality = 1")).collect()} == {1.0}
    assert quality_rff.quality_scores(docs.limit(0), table).collect() == []


# --- spelling --------------------------------------------------------------------------


def variants(rows, noise=199, least=6, often=5, times=5):
    """All pairs of words by the definition of one edit."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % noise == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= often}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1 :])

    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=repr)


def spelled(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "form", "root", "key")})
    return sorted(map(tuple, spelling.spelling_variants(df.repartition(3), **options).collect()), key=repr)


def test_variants_of_a_real_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, spelling.spelling_variants(docs).collect()), key=repr)
    assert got == variants([tuple(r) for r in docs.collect()]) and sum(r[1] is not None for r in got) > 10


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_of_crowded_words(spark, seed):
    """Few letters, so that words have many neighbours and keys are shared by many."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abCéÉ"))
    words = ["".join(letters[rng.integers(0, 5, rng.integers(3, 10))]) for _ in range(400)]
    text = " ".join(np.array(words)[(rng.random(6000) ** 3 * 400).astype(int)])
    got = spelled(spark, [(1, text)], noise=7, least_count=2, dominance=2, least_length=4)
    assert got == variants([(1, text)], noise=7, often=2, times=2, least=4)
    assert any(r[1] and r[1] != r[2] for r in got)


def test_variants_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Straße Straße"), (3, "window windows " * 50_000), (4, "wlndow winow windöw windoww" * 6), (4, "wlndow winow " * 6), (5, "0123 中文 !"), (5, "0123 中文 !")]
    rows += [(6, "colour color " * 5), (7, "abcdex abcdey abcdez " * 9)]
    got = spelled(spark, rows)
    assert got == variants(rows)
    by_word = {r[0]: r for r in got}
    assert by_word["wlndow"][1:3] == ("window", "window") and by_word["abcdex"][4] == 2
    assert spelled(spark, []) == spelled(spark, rows[:2]) == []


def test_every_edit_of_a_word_shares_a_key(spark):
    words = ["window", "écoleés", "abcdefghijk", "aaaaaaaa", "abababab"]
    pairs = set()
    for w in words:
        for i in range(len(w) + 1):
            pairs |= {(w, w[:i] + c + w[i:]) for c in "xa"} | ({(w, w[:i] + c + w[i + 1 :]) for c in "xa"} if i < len(w) else set())
    pairs = {p for p in pairs if p[0] != p[1]}
    df = spark.createDataFrame([*pairs, *((b, a) for a, b in pairs if len(a) == len(b))], "a string, b string")
    shared = F.arrays_overlap(spelling.chunk_keys(F.col("a")), spelling.gram_keys(F.col("b")))
    assert df.where(~shared).collect() == [] and df.where(~spelling.near_words(F.col("a"), F.col("b"))).collect() == []
