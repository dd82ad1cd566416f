"""Sharding, quality rules and mixing beside brute-force versions, and their edge cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewsieve.llm import mixing, quality_mcd, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHES = ["size", "shard", "digest", "key", "place", "words", "x0", "whole", "copies", "component", "band", "n_words"]
LONG = "word " * 60_000


def edge_docs(spark):
    rows = [
        (1, None, "en", "src1", 0),
        (2, "", "en", None, 0),
        (3, "  \n\t ", None, "src1", 5),
        (4, LONG, "en", "src1", len(LONG)),
        (5, "same text here", "de", "src2", 14),
        (5, "same text here", "de", "src2", 14),
        (None, "same text here", "de", "src2", 14),
        (6, "same text here", "de", "src2", 14),
        (7, "é ü 漢字 😀", "fr", "src3", 9),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


def greedy(sizes, shards, capacity):
    used, held = 1, 0
    for s in sizes:
        if held + s > capacity:
            used, held = used + 1, 0
        held += s
        if s > capacity:
            return False
    return used <= shards


@pytest.mark.parametrize("seed", range(30))
def test_capacity_is_the_smallest(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 5, rng.randint(1, 400), 1000 * (rng.random() < 0.05) + 1]) for _ in range(rng.randint(1, 300))]
    ends = [int(e) for e in np.cumsum(sizes)]
    asked = []

    def fetch(gaps, pieces):
        asked.append(len(gaps))
        found = {}
        for gap, (a, b) in enumerate(gaps):
            for i, e in enumerate(ends, 1):
                if a < e < b:
                    piece = (e - a) * pieces // (b - a)
                    low, high = found.get((gap, piece), ((e, i), (e, i)))
                    found[gap, piece] = (min(low, (e, i)), max(high, (e, i)))
        return [p for pair in found.values() for p in pair]

    shards = rng.randint(1, 20)
    sharding_ends = sharding.Ends(ends[-1], len(ends), lambda gaps, pieces: fetch(gaps, min(pieces, 3)))
    capacity = sharding.smallest_capacity(sharding_ends, shards, max(sizes))
    assert greedy(sizes, shards, capacity) and not greedy(sizes, shards, capacity - 1)
    found = sharding.cuts(sharding_ends, shards, capacity)
    assert found == sorted(found) and found[-1] == ends[-1] and set(found) <= {0, *ends}
    assert max(b - a for a, b in zip([0, *found], found)) <= capacity


def test_shards_of_edge_cases(spark):
    rows = sharding.shard_documents(edge_docs(spark), shards=3).collect()
    assert len(rows) == 9 and {r["law"] for r in rows} == {"bytes"}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}[1] == (1, 0)
    by_text = defaultdict(set)
    for r in rows:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0


def brute_statistics(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), len(lines)


def brute_mcd(vectors):
    """Concentration steps in numpy, with the same bins of distance."""
    x = np.array(vectors) / quality_mcd.UNIT
    floors = np.diag(np.square(quality_mcd.FLOORS))

    def estimate(distance, share, within=None):
        if within is None:
            bins = np.floor(np.log1p(distance) * quality_mcd.BINS)
            last = np.sort(bins)[math.ceil(len(bins) * share) - 1]
            part = x[bins <= last]
        else:
            part = x[distance <= within]
        m = part.mean(axis=0)
        return m, quality_mcd._consistency(share) * ((part - m).T @ (part - m) / len(part)) + floors

    def distances(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    middle = np.sort(x, axis=0)[(len(x) - 1) // 2]
    best = None
    for start in (0, 1):
        near = (((x - middle) / quality_mcd.FLOORS) ** 2).sum(axis=1)
        m, c = estimate(near, quality_mcd.SUBSET if start == 0 else 1 - 1e-9)
        for _ in range(quality_mcd.STEPS):
            m, c = estimate(distances(m, c), quality_mcd.SUBSET)
        if best is None or np.linalg.slogdet(c)[1] < best[0]:
            best = (np.linalg.slogdet(c)[1], m, c)
    return estimate(distances(*best[1:]), quality_mcd.REWEIGHT, quality_mcd._quantile4(quality_mcd.REWEIGHT))


def test_quality_beside_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in quality_mcd.quality_verdicts(docs, min_group=20).collect()}
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert got.keys() == texts.keys()
    vectors, groups = {}, defaultdict(set)
    for i, row in texts.items():
        n, chars, symbols, duplicates, repeated, lines = brute_statistics(row["text"])
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, duplicates, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        raw = (math.log(max(chars, 1) / max(n, 1)), math.sqrt(symbols / max(n, 1)), duplicates / max(lines, 1), repeated / max(n, 1))
        vectors[i] = tuple(math.floor(v * quality_mcd.UNIT + 0.5) for v in raw)
        if not r["base_failed"]:
            groups[row["lang"], row["source"]].add(vectors[i])
    small = defaultdict(set)
    for (lang, source), found in groups.items():
        if len(found) < 20:
            small[lang].update((source, v) for v in found)
    estimates = {}
    for i, row in texts.items():
        own = groups[row["lang"], row["source"]]
        members = own if len(own) >= 20 else [v for _, v in small[row["lang"]]]
        if not own or len(members) < 20:
            continue
        key = (row["lang"], row["source"] if len(own) >= 20 else None)
        if key not in estimates:
            estimates[key] = brute_mcd(sorted(members))
        m, c = estimates[key]
        d = np.array(vectors[i]) / quality_mcd.UNIT - m
        distance = d @ np.linalg.inv(c) @ d
        assert math.isclose(got[i]["distance"], distance, rel_tol=1e-6, abs_tol=1e-9)
        assert got[i]["kept"] == (not got[i]["base_failed"] and distance <= quality_mcd.CUTOFF)
    assert len(estimates) >= 4


def test_quality_follows_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    counts = {(r["quality"], r["kept"]): r["n"] for r in quality_mcd.quality_verdicts(docs).where("n_words >= 50").join(docs.select("doc_id", "quality"), "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert counts[1, True] >= 0.99 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] >= 0.9 * (counts[0, False] + counts.get((0, True), 0))


def test_quality_of_edge_cases(spark):
    docs = edge_docs(spark)
    rows = quality_mcd.quality_verdicts(docs).collect()
    assert len(rows) == 9 and not any(r["kept"] for r in rows)
    text = " ".join(f"word{i}" for i in range(80))
    more = docs.unionByName(docs.where("doc_id = 5").limit(1).withColumn("text", F.lit(text)).withColumn("doc_id", F.lit(99).cast("long")).withColumn("lang", F.lit(None).cast("string")))
    kept = quality_mcd.accepted_documents(more)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [99]
    assert quality_mcd.quality_verdicts(spark.createDataFrame([], DOCS)).count() == 0


def brute_shares(children, budget):
    """{name: (weight, room)}: what each gets, by filling the child that is first full again and again."""
    given, left, open_ = {}, budget, {n: wr for n, wr in children.items() if wr[0] > 0}
    given.update({n: 0.0 for n in children if n not in open_})
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {n for n, (w, room) in open_.items() if room * total <= left * w}
        if not full:
            given.update({n: left * w / total for n, (w, _) in open_.items()})
            break
        for n in full:
            given[n] = float(open_[n][1])
            left -= open_.pop(n)[1]
    return given


@pytest.mark.parametrize("share,epochs,last_rows", [(0.6, 4, 10_000), (1.7, 2, 1), (0.02, 1, 1), (9.0, 2, 5)])
def test_mixing_beside_brute_force(spark, share, epochs, last_rows):
    import hashlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.mixture(docs, share=share, epochs=epochs, last_rows=last_rows).collect()
    tokens, members = Counter(), defaultdict(list)
    for r in rows:
        leaf = (r["domain"], r["lang"], r["source"])
        tokens[leaf] += r["n_tokens"]
        members[leaf].append(r)
    weight = lambda level, name: mixing.WEIGHTS[level].get(name, 1)
    budgets = {(): float(int(sum(tokens.values()) * share))}
    for depth in range(3):
        for parent in [p for p in budgets if len(p) == depth]:
            children = defaultdict(int)
            for leaf, n in tokens.items():
                if leaf[:depth] == parent:
                    children[leaf[depth]] += epochs * n
            for name, got in brute_shares({c: (weight(depth, c), room) for c, room in children.items()}, budgets[parent]).items():
                budgets[(*parent, name)] = got
    for leaf, found in members.items():
        whole = math.floor(budgets[leaf] + 1e-6)
        assert abs(found[0]["budget"] - whole) <= 1
        full, rest = divmod(found[0]["budget"], tokens[leaf])
        held = 0
        for r in sorted(found, key=lambda r: hashlib.md5(f"17:{full}:{r['doc_id']}".encode()).hexdigest()):
            held += r["n_tokens"]
            assert r["copies"] == full + (held <= rest)


def test_mixing_of_edge_cases(spark):
    docs = edge_docs(spark)
    rows = mixing.mixture(docs, share=1.0).collect()
    assert len(rows) == 9
    assert len({r["copies"] for r in rows if r["doc_id"] == 5}) == 1
    mixed = mixing.mixed_documents(docs, share=1.0)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mixture(spark.createDataFrame([], DOCS)).count() == 0
