from pyspark.sql import functions as F

from reviewsieve.fixed_values import SPLIT_REASONS
from reviewsieve.operators import quality


def decided(spark):
    rows = [("a", None), ("a", None), ("b", None), (None, "non_english"), (None, "invalid_rating")]
    return spark.createDataFrame(rows, "review_hash string, reason string").repartition(2)


def test_stats_and_totals(spark):
    stats = quality.pipeline_stats(decided(spark)).first().asDict()
    assert stats == {
        "input_records": 5,
        "empty_or_too_short": 0,
        "invalid_rating": 1,
        "undetectable_language": 0,
        "non_english": 1,
        "valid_before_deduplication": 3,
        "duplicate_records": 1,
        "clean_records": 2,
    }
    known = quality.pipeline_stats(decided(spark), F.lit(1)).first()
    assert (known.duplicate_records, known.clean_records) == (2, 1)
    split = quality.pipeline_stats(decided(spark), reasons=SPLIT_REASONS)
    assert "missing_text" in split.columns
    one = quality.pipeline_stats(decided(spark))
    totals = quality.accumulate_stats(one.unionByName(one)).first()
    assert totals.input_records == 10 and totals.chunks_processed == 2


def test_sufficiency(spark):
    for rows, want in ((9_998, (False, 2)), (12_500, (True, 0)), (10_000, (True, 0))):
        got = quality.data_sufficiency(spark.range(rows)).first()
        assert (got.is_sufficient, got.deficit) == want
        assert got.valid_review_count == rows and got.minimum_required == 10_000


def test_reconcile(spark):
    stats = quality.pipeline_stats(decided(spark))
    good = quality.reconcile(stats, spark.range(2), spark.range(2), 5, minimum=1).first()
    assert all(v for k, v in good.asDict().items() if isinstance(v, bool))
    bad = quality.reconcile(stats, spark.range(3), spark.range(1), 6, minimum=2).first()
    failed = {k for k, v in bad.asDict().items() if v is False}
    assert failed == {
        "clean_equals_output",
        "stored_equals_clean",
        "enough_clean",
        "input_as_expected",
    }
