import random

import pytest
from pyspark.sql import functions as F

from reviewsieve.functions import key_digest
from reviewsieve.operators import dedupe
from reviewsieve.session import write_once


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some keys are null, many are single."""
    random.seed(7)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            key = ("hot", "hot")
        elif i % 3 == 1:
            key = (random.choice([None, "a", "b"]), random.choice([None, "x", "y", "z"]))
        else:
            key = (f"k{i}", "single")
        rows.append((i, *key))
    random.shuffle(rows)
    return rows, spark.createDataFrame(rows, "ingest_seq long, a string, b string").repartition(6)


def groups_of(rows):
    groups = {}
    for seq, a, b in rows:
        groups.setdefault((a, b), []).append(seq)
    return groups


def test_keep_first(skewed):
    rows, df = skewed
    got = {r.ingest_seq for r in dedupe.drop_duplicate_reviews(df, ["a", "b"]).collect()}
    assert got == {min(g) for g in groups_of(rows).values()}


def test_mask(skewed):
    rows, df = skewed
    firsts = {min(g) for g in groups_of(rows).values()}
    got = {r.ingest_seq: r.is_duplicate for r in dedupe.duplicate_mask(df, ["a", "b"]).collect()}
    assert got == {seq: seq not in firsts for seq, _, _ in rows}
    single = {g[0] for g in groups_of(rows).values() if len(g) == 1}
    every = dedupe.duplicate_mask(df, ["a", "b"], keep="none").collect()
    assert {r.ingest_seq for r in every if not r.is_duplicate} == single


def test_groups_and_report(skewed):
    rows, df = skewed
    want = {s: len(g) for g in groups_of(rows).values() if len(g) > 1 for s in g}
    got = {r.ingest_seq: r.copies for r in dedupe.duplicate_groups(df, ["a", "b"]).collect()}
    assert got == want
    report = dedupe.duplicate_report(df, ["a", "b"]).first()
    n = len(groups_of(rows))
    assert tuple(report) == (len(rows), len(rows) - n, n)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [0.5, 1, 3, 8, 1000])
def test_hot_and_cold_groups_give_the_broadcast_result(skewed, how, limit):
    rows, df = skewed
    key = key_digest([F.col("a"), F.col("b")])
    copied = dedupe.group_sizes(df, key, "ingest_seq").where("_copies > 1")
    groups = write_once(copied, "test-groups")
    keyed = df.withColumn("_key", key)
    got = dedupe.attach_groups(keyed, groups, how, limit).collect()
    members = groups_of(rows)
    want = {
        (s, min(g) if len(g) > 1 else None)
        for g in members.values()
        for s in g
        if how == "left" or len(g) > 1
    }
    assert len(got) == len(want)
    assert {(r.ingest_seq, r["_first"]) for r in got} == want


def test_padding_does_not_hide_a_copy(spark):
    rows = [
        (1, "B1", "U1", "5", "A title", "some text"),
        (2, "B1", "U1", "5.0", "  A title ", "   some\ttext   "),
        (3, "B1", "U1", "4", "A title", "some text"),
    ]
    raw = spark.createDataFrame(
        rows, "ingest_seq long, asin string, user_id string, rating string, title string, text string"
    )
    kept = dedupe.drop_duplicate_reviews(dedupe.add_duplicate_keys(raw)).collect()
    assert {r.ingest_seq for r in kept} == {1, 3}


def test_hash_uniqueness(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "review_hash string")
    assert tuple(dedupe.hash_uniqueness(df).first()) == (3, 2, 1)
    assert tuple(dedupe.hash_uniqueness(df.where("false")).first()) == (0, 0, 0)
