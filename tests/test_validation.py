from reviewsieve.operators.validation import (
    preprocess_reviews,
    rejected_reviews,
    validate_reviews,
)
from tests.test_language import small_model

SCHEMA = (
    "ingest_seq long, text string, rating string, title string, asin string, user_id string"
)
ENGLISH = "the dog and the cat are in the house"
CASES = {
    1: (ENGLISH, "5", None, None),
    2: (None, "5", "empty_or_too_short", "missing_text"),
    3: ("     ", "5", "empty_or_too_short", "empty_text"),
    4: ("ok", "5", "empty_or_too_short", "empty_or_too_short"),
    5: (ENGLISH, "7", "invalid_rating", "invalid_rating"),
    6: (None, "7", "empty_or_too_short", "missing_text"),
    7: ("12345", "5", "undetectable_language", "undetectable_language"),
    8: ("le chien et le chat sont dans la maison", "5", "non_english", "non_english"),
    9: ("the<br/>house", "4.0", None, None),
}


def reviews(spark):
    rows = [
        (i, text, rating, "  A <b>title</b>", "B1", "U1")
        for i, (text, rating, _, _) in CASES.items()
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_reasons(spark):
    model = small_model(spark)
    for split, place in ((False, 2), (True, 3)):
        got = {
            r.ingest_seq: r.validation.reason
            for r in validate_reviews(reviews(spark), model, split_missing=split).collect()
        }
        assert got == {i: case[place] for i, case in CASES.items()}


def test_fields_after_the_failed_check_are_null(spark):
    got = {
        r.ingest_seq: r.validation
        for r in validate_reviews(reviews(spark), small_model(spark)).collect()
    }
    assert tuple(got[1]) == (True, None, ENGLISH, 5, "en")
    assert tuple(got[4]) == (False, "empty_or_too_short", "ok", None, None)
    assert tuple(got[5]) == (False, "invalid_rating", ENGLISH, None, None)
    assert tuple(got[7]) == (False, "undetectable_language", "12345", 5, None)
    assert got[8].detected_language == "fr" and got[8].normalized_rating == 5


def test_preprocess_and_rejects_split_the_rows(spark):
    model, raw = small_model(spark), reviews(spark)
    clean = {r.ingest_seq: r for r in preprocess_reviews(raw, model).collect()}
    assert set(clean) == {1, 9}
    assert clean[9].rating == 4 and clean[9].text == "the<br/>house"
    assert clean[9].text_normalized == "the house"
    assert clean[9].title_normalized == "A title"
    assert len(clean[9].review_hash) == 64
    rejected = {r.ingest_seq: r.reason for r in rejected_reviews(raw, model).collect()}
    assert rejected == {i: c[2] for i, c in CASES.items() if c[2]}


def test_language_check_can_be_off(spark):
    valid = preprocess_reviews(reviews(spark), None)
    assert {r.ingest_seq for r in valid.collect()} == {1, 7, 8, 9}


def test_other_column_names(spark):
    renamed = reviews(spark).withColumnsRenamed({"text": "body", "rating": "stars"})
    got = preprocess_reviews(renamed, small_model(spark), "body", "stars").collect()
    assert {r.ingest_seq for r in got} == {1, 9} and {r.stars for r in got} == {5, 4}


def test_language_is_judged_without_moving_rows(spark):
    """One scan and no exchange, with the text cleaned once."""
    from reviewsieve.operators.language import train_language_model
    from reviewsieve.plans.review_view import reviews
    from tests.conftest import SF_SMALL

    model = train_language_model(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    clean = preprocess_reviews(reviews(spark, SF_SMALL, heavy=False), model)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
