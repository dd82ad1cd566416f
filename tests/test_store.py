import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewsieve.operators import store as store_module
from reviewsieve.functions.bloom import any_passes, bloom_filter
from reviewsieve.operators.store import DedupeStore, StoreConflict, known_hashes, known_keys, new_hashes, unknown_keys
from reviewsieve.plans.increments import preprocess_increment
from reviewsieve.plans.review_view import reviews
from reviewsieve.session import create_file, list_names, path_exists, read_file, write_once
from tests.conftest import SF_SMALL

FIELDS = "ingest_seq long, review_hash string"


def test_insert_list_reset(spark, tmp_path):
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    assert store.count() == 0
    store.insert(spark.createDataFrame([("a",), ("b",)], "review_hash string"), "r", 0)
    store.create()
    store.insert(spark.createDataFrame([("c",)], "review_hash string"), "r", 1)
    assert store.count() == 3
    listed = store.listing().collect()
    assert [r.review_hash for r in listed] == ["a", "b", "c"]
    assert {(r.run_id, r.batch_id) for r in listed} == {("r", 0), ("r", 1)}
    assert all(isinstance(r.created_at, datetime) for r in listed)
    store.insert(spark.createDataFrame([("d",)], "review_hash string"), "r", 1)
    assert {r.review_hash for r in store.read().collect()} == {"a", "b", "d"}
    assert {r.review_hash for r in store.hashes("r", 1).collect()} == {"a", "b"}
    assert store.reset().count() == 0


def digests(*numbers):
    return [hashlib.sha256(str(i).encode()).hexdigest() for i in numbers]


def column(spark, hashes):
    return spark.createDataFrame([(h,) for h in hashes], "review_hash string").repartition(2)


def filled(spark, path, batches=4, size=300, digits=2):
    store = DedupeStore(spark, path, digits).create()
    for b in range(batches):
        store.insert(column(spark, digests(*range(b * size, (b + 1) * size))), "r", b)
    return store


def test_filters_let_all_of_their_own_and_few_others_pass():
    mine, others = digests(*range(3000)), digests(*range(5000, 25000))
    bits = bloom_filter(mine)
    assert all(any_passes([h], bits) for h in mine) and not any_passes([], bits)
    assert sum(any_passes([h], bits) for h in others) <= 2
    assert not any_passes(["a"], bloom_filter([])) and any_passes(["é"], bloom_filter(["é"]))


def test_a_batch_opens_only_folders_that_may_hold_its_hashes(spark, tmp_path):
    store = filled(spark, f"{tmp_path}/store")
    version = store.version()
    everything = sum(len([n for n in list_names(spark, f"{store.path}/data/entry={e.name}") if n.startswith("prefix=")]) for e in version.entries)
    assert everything > 600
    look = lambda hashes: store.folders(column(spark, hashes), list(version.entries), version.digits)
    assert look(digests(*range(10**6, 10**6 + 2000))) == {}
    some = look(digests(5, 310, 999999))
    assert some == {version.entries[0].name: [digests(5)[0][:2]], version.entries[1].name: [digests(310)[0][:2]]}
    keys = write_once(column(spark, digests(*range(290, 320), *range(10**6, 10**6 + 50))), "keys")
    found = store.candidates(keys.data)
    assert len(found.inputFiles()) <= 30 < everything / 10
    assert {r.review_hash for r in unknown_keys(keys, found).collect()} == set(digests(*range(10**6, 10**6 + 50)))


def test_known_and_new_of_a_store(spark, tmp_path):
    rows = [(i, digests(i % 40)[0]) for i in range(200)]
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    assert known_hashes(df, store).count() == 0 and new_hashes(df, store).count() == 40
    store.insert(column(spark, digests(*range(30, 90))), "r", 0)
    assert {r.ingest_seq for r in known_hashes(df, store).collect()} == {i for i in range(200) if i % 40 >= 30}
    assert {r.ingest_seq for r in new_hashes(df, store).collect()} == set(range(30))


def test_merged_entries_list_the_same(spark, tmp_path):
    store = filled(spark, f"{tmp_path}/store", digits=1)
    store.insert(column(spark, digests(1, 2, 5000)), "other", 0)
    before, old = store.listing().collect(), store.version()
    rows = {r.review_hash: r for r in reversed(before)}
    merged = store.compact()
    assert merged == store.version() and len(merged.entries) == 3 and len(old.entries) == 5
    # The newest batch of each run stays replaceable.
    assert {(e.run_id, e.batch_id) for e in merged.entries} == {(None, None), ("r", 3), ("other", 0)}
    after = store.listing().collect()
    assert after == before and store.count() == len(before)
    # An older version still reads as it was, until it is removed.
    assert store.read(old).count() == 1203
    store.vacuum(keep=1)
    assert len(list_names(spark, f"{store.path}/data")) == 3 and store.listing().collect() == before
    store.insert(column(spark, digests(7000)), "other", 0)
    assert {r.review_hash for r in store.read().collect()} == set(rows) - set(digests(5000)) | set(digests(7000))
    assert store.compact() == store.version()


def test_twice_stored_hashes_keep_their_oldest_row_when_merged(spark, tmp_path):
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    for b, numbers in enumerate(([1, 2], [2, 3], [9])):
        store.insert(column(spark, digests(*numbers)), "r", b)
    store.compact()
    assert {(r.review_hash, r.batch_id) for r in store.read().collect()} == set(zip(digests(1, 2, 3, 9), (0, 0, 1, 2)))
    assert store.count() == 4


@pytest.mark.parametrize("step", range(4))
@pytest.mark.parametrize("work", ["insert_absent", "compact"])
def test_a_crash_leaves_the_old_or_the_new_version(spark, tmp_path, monkeypatch, step, work):
    """Stop before the data, the filters, the new version, and after all: readers see whole versions."""
    store = filled(spark, f"{tmp_path}/store", batches=3, size=20, digits=1)
    before = set(digests(*range(60)))
    new = column(spark, digests(*range(50, 80)))
    do = (lambda: store.insert_absent(new, "r", 9)) if work == "insert_absent" else store.compact

    class Stop(Exception):
        pass

    def stop(*args, **kwargs):
        raise Stop

    real_commit, after = DedupeStore._commit, set(before)
    with monkeypatch.context() as m:
        if step == 0:
            m.setattr(DedupeStore, "_write", stop)
        elif step == 1:
            m.setattr(store_module, "bloom_filter", None)
        elif step == 2:
            m.setattr(DedupeStore, "_commit", stop)
        else:
            m.setattr(DedupeStore, "_commit", lambda self, v: (real_commit(self, v), stop()))
            after |= set(digests(*range(60, 80))) if work == "insert_absent" else set()
        with pytest.raises(Exception):
            do()
    assert {r.review_hash for r in store.read().collect()} == after and store.count() == len(after)
    do()
    whole = before | (set(digests(*range(60, 80))) if work == "insert_absent" else set())
    assert sorted(r.review_hash for r in store.read().collect()) == sorted(whole)


def test_two_runs_at_once_store_each_hash_once(spark, tmp_path, monkeypatch):
    """Between the look-up and the new version of one run, another run stores half of its hashes."""
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    other = DedupeStore(spark, f"{tmp_path}/store")
    real, raced = DedupeStore._write, []

    def write(self, rows, digits):
        entry = real(self, rows, digits)
        if self is store and not raced:
            raced.append(1)
            assert other.insert_absent(column(spark, digests(*range(25, 75))), "two", 0) == 50
        return entry

    monkeypatch.setattr(DedupeStore, "_write", write)
    assert store.insert_absent(column(spark, digests(*range(50))), "one", 0, store.version()) == 25
    rows = store.read().collect()
    assert sorted(r.review_hash for r in rows) == sorted(digests(*range(75))) and store.count() == 75
    assert {r.run_id for r in rows if r.review_hash in digests(*range(25))} == {"one"}
    # What the refused attempt had written is gone.
    assert len(list_names(spark, f"{store.path}/data")) == 2
    # A batch that is repeated is not known to itself.
    assert store.insert_absent(column(spark, digests(*range(50))), "one", 0) == 25


def test_merging_gives_way_to_a_reset(spark, tmp_path, monkeypatch):
    store = filled(spark, f"{tmp_path}/store", batches=3, size=10, digits=1)
    real = DedupeStore._write

    def write(self, rows, digits):
        entry = real(self, rows, digits)
        DedupeStore(spark, store.path).reset()
        return entry

    monkeypatch.setattr(DedupeStore, "_write", write)
    with pytest.raises(StoreConflict):
        store.compact()
    assert store.count() == 0 and store.read().count() == 0


def test_small_files_are_created_once(spark, tmp_path):
    path = f"{tmp_path}/folder/name"
    assert create_file(spark, path, "é one") and not create_file(spark, path, "two")
    assert read_file(spark, path) == "é one" and list_names(spark, f"{tmp_path}/folder") == ["name"]
    assert list_names(spark, f"{tmp_path}/none") == []


def test_known_and_new(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 == 0 else f"h{i % 20}") for i in range(300)]
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    stored = spark.createDataFrame([("hot",), ("h1",), ("other",)], "review_hash string")
    want_known = {i for i, h in rows if h in ("hot", "h1")}
    firsts = {}
    for i, h in rows:
        firsts.setdefault(h, i)
    want_new = {(h, i) for h, i in firsts.items() if h not in ("hot", "h1")}
    for limit in (1000, 0):
        monkeypatch.setattr(store_module, "BROADCAST_ROWS", limit)
        assert {r.ingest_seq for r in known_hashes(df, stored).collect()} == want_known
        assert {tuple(r) for r in new_hashes(df, stored).select("review_hash", "ingest_seq").collect()} == want_new


def test_repeated_stored_hash_counts_once(spark):
    keys = write_once(spark.createDataFrame([("a",), ("b",)], "review_hash string"), "keys")
    stored = spark.createDataFrame([("a",), ("a",)], "review_hash string")
    assert known_keys(keys, stored).count() == 1


def test_second_run_finds_only_duplicates(spark, tmp_path):
    raw = reviews(spark, SF_SMALL)
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    first = preprocess_increment(raw, store, None, "one", 0)
    counts = first.stats.first()
    hashes = {r.review_hash for r in first.clean.collect()}
    assert counts.clean_records == len(hashes) == first.clean.count()
    assert counts.duplicate_records > 0
    store.insert(first.hashes, "one", 0)

    again = preprocess_increment(raw, store, None, "two", 0).stats.first()
    assert again.clean_records == 0
    assert again.duplicate_records == again.valid_before_deduplication > 0

    retried = preprocess_increment(raw, store, None, "one", 0)
    assert {r.review_hash for r in retried.clean.collect()} == hashes


def test_first_copy_is_kept_and_scratch_is_released(spark, tmp_path):
    raw = reviews(spark, SF_SMALL)
    store = DedupeStore(spark, f"{tmp_path}/store").create()
    increment = preprocess_increment(raw, store, None, "one", 0)
    by_hash = {r.review_hash: r.ingest_seq for r in increment.clean.collect()}
    from reviewsieve.operators.validation import preprocess_reviews

    firsts = (
        preprocess_reviews(raw, None).groupBy("review_hash").agg(F.min("ingest_seq").alias("first"))
    )
    assert by_hash == {r.review_hash: r["first"] for r in firsts.collect()}
    paths = [t.path for t in increment.tables]
    assert all(path_exists(spark, p) for p in paths)
    increment.release()
    assert not any(path_exists(spark, p) for p in paths)
