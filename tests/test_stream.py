import pytest
from pyspark.sql import functions as F

from reviewsieve.operators.quality import accumulate_stats, reconcile
from reviewsieve.operators.store import DedupeStore
from reviewsieve.operators.validation import preprocess_reviews
from reviewsieve.plans.review_view import reviews
from reviewsieve.sources import RAW_REVIEW_SCHEMA, read_clean, read_reviews_stream
from reviewsieve.streaming import read_stats, run_preprocess_stream, runner
from tests.conftest import SF_SMALL

FILES = 3


@pytest.fixture
def landed(spark, tmp_path):
    raw = reviews(spark, SF_SMALL)
    raw.repartitionByRange(FILES, "ingest_seq").write.json(f"{tmp_path}/in")
    hashes = {r.review_hash for r in preprocess_reviews(raw, None).collect()}
    return raw, hashes


def start(spark, tmp_path, schema, run="one", offsets="offsets"):
    store = DedupeStore(spark, f"{tmp_path}/store")
    query = run_preprocess_stream(
        read_reviews_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1),
        f"{tmp_path}/clean",
        store,
        run,
        f"{tmp_path}/{offsets}",
        f"{tmp_path}/stats",
        None,
    )
    query.awaitTermination()
    return query, store


def written(spark, tmp_path, run=None):
    schema = spark.createDataFrame([], "review_hash string").schema
    return [r.review_hash for r in read_clean(spark, f"{tmp_path}/clean", schema, run).collect()]


def test_stream_equals_batch_and_reruns_add_nothing(spark, tmp_path, landed):
    raw, hashes = landed
    query, store = start(spark, tmp_path, raw.schema)
    got = written(spark, tmp_path)
    assert sorted(got) == sorted(hashes)
    assert {r.review_hash for r in store.read().collect()} == hashes and store.count() == len(hashes)

    stats = read_stats(spark, f"{tmp_path}/stats", "one")
    totals = accumulate_stats(stats)
    first = totals.first()
    assert first.chunks_processed == FILES == len(query.recentProgress)
    assert sum(p.numInputRows for p in query.recentProgress) >= raw.count()
    assert first.input_records == raw.count() and first.clean_records == len(hashes)
    clean = spark.createDataFrame([(h,) for h in got], "review_hash string")
    checks = reconcile(totals.drop("chunks_processed"), clean, store.read(), raw.count(), 10).first()
    assert all(v for v in checks.asDict().values() if isinstance(v, bool))

    # The same query again has nothing to do; a new run drops everything.
    start(spark, tmp_path, raw.schema)
    assert len(written(spark, tmp_path)) == len(hashes)
    start(spark, tmp_path, raw.schema, run="two", offsets="offsets2")
    assert len(written(spark, tmp_path)) == store.count() == len(hashes)
    again = accumulate_stats(read_stats(spark, f"{tmp_path}/stats", "two")).first()
    assert again.clean_records == 0
    assert again.duplicate_records == again.valid_before_deduplication

    # A new checkpoint under an old name would overwrite its output.
    with pytest.raises(ValueError, match="new run"):
        start(spark, tmp_path, raw.schema, run="one", offsets="offsets3")


@pytest.mark.parametrize("step", ["append_clean", "insert_absent", "_append_stats"])
def test_crash_within_a_batch_loses_and_repeats_nothing(spark, tmp_path, landed, monkeypatch, step):
    raw, hashes = landed
    owner = DedupeStore if step == "insert_absent" else runner
    real = getattr(owner, step)
    calls = []

    def failing(*args, **kwargs):
        calls.append(1)
        result = real(*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(Exception, match="lost"):
        start(spark, tmp_path, raw.schema)
    monkeypatch.setattr(owner, step, real)
    _, store = start(spark, tmp_path, raw.schema)
    assert sorted(written(spark, tmp_path)) == sorted(hashes)
    assert store.count() == len(hashes)
    totals = accumulate_stats(read_stats(spark, f"{tmp_path}/stats", "one")).first()
    assert totals.input_records == raw.count() and totals.clean_records == len(hashes)


def test_another_run_stores_some_hashes_first(spark, tmp_path, landed, monkeypatch):
    """While a batch writes its rows, another run stores a third of the hashes: their rows go again."""
    raw, hashes = landed
    taken, real = sorted(hashes)[::3], runner.append_clean

    def raced(*args):
        real(*args)
        monkeypatch.setattr(runner, "append_clean", real)
        DedupeStore(spark, f"{tmp_path}/store").insert_absent(spark.createDataFrame([(h,) for h in taken], "review_hash string"), "other", 0)

    monkeypatch.setattr(runner, "append_clean", raced)
    _, store = start(spark, tmp_path, raw.schema)
    assert sorted(written(spark, tmp_path)) == sorted(hashes - set(taken))
    assert sorted(r.review_hash for r in store.read().collect()) == sorted(hashes)
    totals = accumulate_stats(read_stats(spark, f"{tmp_path}/stats", "one")).first()
    assert totals.clean_records == len(hashes) - len(taken) and totals.input_records == raw.count()


def test_rows_without_an_order_column(spark, tmp_path, landed):
    raw, hashes = landed
    fields = [f for f in RAW_REVIEW_SCHEMA.fields if f.name in raw.columns]
    _, store = start(spark, tmp_path, type(RAW_REVIEW_SCHEMA)(fields))
    assert sorted(written(spark, tmp_path)) == sorted(hashes)
    one = spark.read.json(f"{tmp_path}/clean").drop("run_id", "batch_id")
    assert "ingest_seq" not in one.columns and "_file_place" not in one.columns
    assert one.where(F.col("timestamp").rlike("^2020-01-0")).count() == one.count()


def test_failed_and_finished_batches_leave_no_scratch(spark, tmp_path, landed, monkeypatch):
    from reviewsieve import session
    from reviewsieve.plans import increments

    made = []

    def noted(df, label):
        table = session.write_once(df, label)
        made.append(table.path)
        return table

    monkeypatch.setattr(increments, "write_once", noted)
    monkeypatch.setattr(runner, "write_once", noted)
    raw, hashes = landed

    def broken(*args):
        raise RuntimeError("stop")

    with monkeypatch.context() as m:
        m.setattr(runner, "_append_stats", broken)
        with pytest.raises(Exception, match="stop"):
            start(spark, tmp_path, raw.schema)
    start(spark, tmp_path, raw.schema)
    assert made and not any(session.path_exists(spark, path) for path in made)
    assert sorted(written(spark, tmp_path)) == sorted(hashes)


def test_other_column_names(spark, tmp_path):
    from reviewsieve.plans.increments import ReviewColumns, preprocess_increment

    raw = reviews(spark, SF_SMALL)
    renamed = raw.withColumnsRenamed({"text": "body", "rating": "stars", "title": "head", "asin": "item", "user_id": "who"})
    names = ReviewColumns("body", "stars", "head", "item", "who")
    want = {r.review_hash for r in preprocess_increment(raw, None, None).clean.collect()}
    assert {r.review_hash for r in preprocess_increment(renamed, None, None, names=names).clean.collect()} == want
    numbers = raw.withColumn("text", F.col("ingest_seq") + 1000).withColumn("title", F.lit(7))
    for r in preprocess_increment(numbers, None, None).clean.collect():
        assert (r.text_normalized, r.title_normalized) == (str(r.text), "7")
