import pytest
from pyspark.sql import functions as F

from reviewsieve.fixed_values import RATING_ALIASES, TEXT_ALIASES
from reviewsieve.operators import profiling, schema
from reviewsieve.sources import read_json_records
from tests.test_language import small_model

NAN = float("nan")


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [
            (1, "5", "text", 1.0, []),
            (2, None, "  ", 2.0, [1]),
            (3, "4", None, NAN, None),
            (4, "5", "<b>x</b>", 1.0, []),
            (5, "5", "y", 1.0, []),
        ],
        "ingest_seq long, rating string, text string, price double, images array<int>",
    ).repartition(2)


def test_find_column():
    assert schema.find_column(["Stars", " Review_Text ", "Text"], TEXT_ALIASES) == "Text"
    assert schema.find_column(["Stars", " Review_Text "], TEXT_ALIASES) == " Review_Text "
    assert schema.find_column(["score", "OVERALL"], RATING_ALIASES) == "OVERALL"
    assert schema.find_column(["Text", "text"], TEXT_ALIASES) == "text"
    assert schema.find_column(["a"], TEXT_ALIASES) is None
    assert schema.find_column(["Text"], ["Text"]) == schema.find_column([" text"], ["TEXT "]).title().strip() == "Text"
    assert schema.find_column(["b", "a"], ["A", " a", "B"]) == "a"


def test_key_sets(mixed):
    got = {tuple(r.key_set): r.records for r in schema.key_sets(mixed).collect()}
    full = ("images", "ingest_seq", "price", "rating", "text")
    assert got == {
        full: 3,
        ("images", "ingest_seq", "price", "text"): 1,
        ("ingest_seq", "rating"): 1,
    }
    assert schema.key_sets(mixed, max_records=2).agg(F.sum("records")).first()[0] == 2
    top = schema.top_key_sets(mixed, 2).collect()
    assert [(tuple(r.key_set), r.records) for r in top] == [
        (full, 3),
        (("images", "ingest_seq", "price", "text"), 1),
    ]
    summary = schema.schema_summary(mixed).first()
    assert tuple(summary) == (5, 5, "images,ingest_seq,price,rating,text", 3)


def test_sometimes_absent(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    assert [r.field for r in schema.sometimes_absent_fields(df).collect()] == ["b"]


def test_classify(spark, mixed):
    got = schema.classify_dataset(mixed).first()
    assert tuple(got) == ("rating,text", "images,price", False, True)
    metadata = spark.createDataFrame([("t", "b")], "title string, Brand string")
    assert tuple(schema.classify_dataset(metadata).first()) == ("", "brand,title", True, False)
    other = spark.createDataFrame([(1,)], "z int")
    assert tuple(schema.classify_dataset(other).first()) == ("", "", False, False)
    presence = {r.field: r.rows_present for r in schema.known_fields(mixed).collect()}
    assert presence == {"rating": 4, "text": 4, "price": 4, "images": 4}


def test_schema_validation(spark, mixed):
    report = schema.validate_review_schema(mixed).first()
    assert report.text_column == "text" and report.rating_column == "rating"
    assert report.review_like_fields_found == ["rating", "text"]
    with pytest.raises(ValueError, match="text"):
        schema.validate_review_schema(mixed.drop("text"))
    with pytest.raises(ValueError, match="rating"):
        schema.validate_review_schema(mixed.drop("rating"))
    assert schema.validate_required_columns(mixed, ["text"]) is mixed
    with pytest.raises(ValueError, match="stars is missing"):
        schema.validate_required_columns(mixed, ["text", "stars"], "upload.csv")


def test_profiles(mixed):
    ratings = [tuple(r) for r in profiling.rating_distribution(mixed).collect()]
    assert ratings == [("4", 1), ("5", 3)]
    assert tuple(profiling.text_missing_stats(mixed).first()) == (5, 1, 1, 0.2, 0.2)
    nulls = {r.column_name: r.null_count for r in profiling.column_null_counts(mixed).collect()}
    assert nulls == {"ingest_seq": 0, "rating": 1, "text": 1, "price": 0, "images": 1}
    assert tuple(profiling.html_rate(mixed).first()) == (5, 1, 0.2)
    assert [r.text for r in profiling.html_examples(mixed).collect()] == ["<b>x</b>"]
    assert [r.ingest_seq for r in profiling.first_rows(mixed, 2).collect()] == [1, 2]
    summary = profiling.exploration_summary(mixed).first()
    assert tuple(summary) == (5, 3, "rating", "text", 2, 0.4, True)


def test_empty_table(mixed):
    none = mixed.where("false")
    assert tuple(profiling.text_missing_stats(none).first()) == (0, 0, 0, None, None)
    assert profiling.exploration_summary(none).first().total_rows == 0
    assert schema.schema_summary(none).first().total_rows == 0


def test_sample_ignores_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "ingest_seq")
    one = [r.ingest_seq for r in profiling.seeded_sample(df.repartition(1), 20).collect()]
    many = [r.ingest_seq for r in profiling.seeded_sample(df.repartition(7), 20).collect()]
    other = [r.ingest_seq for r in profiling.seeded_sample(df, 20, seed=1).collect()]
    assert one == many and len(set(one)) == 20 and other != one
    assert profiling.seeded_sample(df, 1000).count() == 500


def test_language_estimate(spark):
    df = spark.createDataFrame(
        [(1, "the house"), (2, "le chien et la maison"), (3, "123"), (4, ""), (5, None)],
        "ingest_seq long, text string",
    )
    got = profiling.language_estimate(df, small_model(spark)).first()
    assert tuple(got) == (3, 1, 1, 1 / 3, 1 / 3)


def test_required_types(spark, mixed):
    from pyspark.sql import types as T

    fits = T.StructType([T.StructField("text", T.StringType()), T.StructField("price", T.DoubleType())])
    assert schema.validate_required_columns(mixed, fits) is mixed
    other = T.StructType([T.StructField("text", T.LongType()), T.StructField("stars", T.LongType())])
    with pytest.raises(ValueError, match="text is string, not bigint; stars is missing"):
        schema.validate_required_columns(mixed, other)


def test_padded_names_are_classified_by_their_trimmed_form(spark):
    df = spark.createDataFrame([("a", "5")], "` Text` string, `rating ` string")
    row = schema.classify_dataset(df).first()
    assert row.review_like_fields_found == "rating,text" and row.is_review_data
    assert schema.find_column(df.columns, ["body", "text"]) == " Text"
    assert schema.find_column(["text", "TEXT "], ["text"]) == "TEXT "
    assert schema.find_column(["review", "text"], ["text", "review"]) == "text"


def test_first_records_of_key_sets_are_ordered(spark):
    df = spark.createDataFrame([(i, "x" if i < 5 else None) for i in range(40)], "ingest_seq long, t string").repartition(7)
    assert [tuple(r) for r in schema.key_sets(df, 5).collect()] == [(["ingest_seq", "t"], 5)]


def test_key_sets_of_json_records_without_a_schema(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"b": 1, "a": {"x": null}}\n\n{"a": null, "b": [], "9": ""}\n {"B": 0, "b": "x", "9": false}\n{}\n')
    records = read_json_records(spark, str(path))
    sets = {tuple(r.key_set): r.records for r in schema.key_sets(records).collect()}
    assert sets == {("a", "b"): 1, ("9", "b"): 1, ("9", "B", "b"): 1, (): 1}
    assert tuple(schema.schema_summary(records).first()) == (4, 4, "9,B,a,b", 4)
    assert {r.field for r in schema.sometimes_absent_fields(records).collect()} == {"9", "a", "B", "b"}
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n[2]\n{"a": 1, "a": 2}\n{"a": \n')
    with pytest.raises(Exception, match="JSON|DUPLICATE"):
        read_json_records(spark, str(tmp_path / "bad.jsonl")).collect()
    assert read_json_records(spark, str(tmp_path / "bad.jsonl"), strict=False).count() == 1
