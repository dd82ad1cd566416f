from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewsieve.operators import language
from reviewsieve.operators.language import (
    build_language_profiles,
    detect_language,
    language_filter,
    train_language_model,
)
from tests.conftest import SF

TRAINING = [
    ("en", "the cat and the dog are in the house with the other animals"),
    ("fr", "le chat et le chien sont dans la maison avec les autres animaux"),
    ("en", "the weather is nice and they think that this is the best thing"),
    ("fr", "il fait beau et nous pensons que c'est la meilleure des choses"),
]


def small_model(spark, k=300):
    labeled = spark.createDataFrame(TRAINING, "lang string, text string")
    return train_language_model(labeled, k)


def trigrams(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    return [f" {w} "[i : i + 3] for w in words for i in range(len(w))]


def test_profiles_equal_brute_force(spark):
    k = 20
    counts = {}
    for lang, text in TRAINING:
        counts.setdefault(lang, Counter()).update(trigrams(text))
    want = {
        (lang, gram, rank)
        for lang, grams in counts.items()
        for rank, (gram, _) in enumerate(sorted(grams.items(), key=lambda g: (-g[1], g[0]))[:k], 1)
    }
    df = spark.createDataFrame(TRAINING, "lang string, text string")
    assert {tuple(r) for r in build_language_profiles(df, k).collect()} == want


@pytest.mark.parametrize("piece, table", [(1, 0), (1, 1 << 22), (7, 0), (1 << 18, 1 << 22)])
def test_detection_equals_brute_force(spark, monkeypatch, piece, table):
    k = 40
    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "TABLE", table)
    ranks = {
        (r.lang, r.gram): r["rank"]
        for r in build_language_profiles(
            spark.createDataFrame(TRAINING, "lang string, text string"), k
        ).collect()
    }
    texts = ["the dog", "le chien et la chose", "thing beau", "chat", "animal", "zzz", "q", "the \U0001d4b6 ça \U00020000the", "日the"]

    def want(text):
        scores = {
            lang: sum(max(0, k + 1 - ranks.get((lang, g), k + 1)) for g in trigrams(text))
            for lang in ("en", "fr")
        }
        best = max(scores.values())
        return min(x for x in scores if scores[x] == best) if best else None

    df = spark.createDataFrame(list(enumerate(texts)), "ingest_seq long, text string")
    got = {r.text: r.language for r in detect_language(df, "text", small_model(spark, k)).collect()}
    assert got == {t: want(t) for t in texts}


def test_undetectable_empty_and_disabled(spark):
    model = small_model(spark)
    df = spark.createDataFrame(
        [(1, "12345"), (2, ""), (3, None), (4, "日本語"), (5, "the house")],
        "ingest_seq long, text string",
    )
    got = {r.ingest_seq: (r.language, r.accepted) for r in language_filter(df, "text", model).collect()}
    assert got == {
        1: (None, False),
        2: ("en", True),
        3: ("en", True),
        4: (None, False),
        5: ("en", True),
    }
    kept = language_filter(df, "text", model, keep_undetectable=True)
    assert {r.ingest_seq: r.accepted for r in kept.collect()}[1] is True
    off = language_filter(df, "text", model, enabled=False)
    assert {(r.language, r.accepted) for r in off.collect()} == {("en", True)}


def test_accuracy_on_held_out_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_language_model(documents.where("doc_id % 2 = 0"))
    held_out = documents.where("doc_id % 2 = 1").select(
        F.col("doc_id").alias("ingest_seq"), "text", "lang"
    )
    right, total = (
        detect_language(held_out, "text", model)
        .agg(F.count_if(F.col("language") == F.col("lang")), F.count(F.lit(1)))
        .first()
    )
    assert total == 500 and right >= 498


def test_whole_text_counts(spark):
    """The end of a long text decides as much as its start."""
    model = small_model(spark)
    text = "the house " + "le chien et la maison avec les choses " * 2000
    df = spark.createDataFrame([(1, text)], "ingest_seq long, text string")
    assert detect_language(df, "text", model).first().language == "fr"
