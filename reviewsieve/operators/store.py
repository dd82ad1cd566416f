"""Persistent store of review hashes, versioned, with filters that tell which of its files a batch needs.

Each insert writes its hashes as one entry: Parquet files in folders by the first digits of the hash, and for
each folder a Bloom filter of its hashes. What an entry holds never changes. A version is a small file that lists
the entries in force; a reader takes one version, a writer adds the next one and is refused if another writer
was faster. So readers see whole inserts only, a repeated batch replaces its entry, and of two runs at
once the slower one looks its hashes up again among the entries it had not seen.

A batch is looked up by prefix: its hashes meet the filters of their own folders only, and only folders whose
filter lets one of them pass are read. `compact` merges the entries of earlier batches into one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.functions.bloom import any_passes, bloom_filter
from reviewsieve.operators.dedupe import attach_groups
from reviewsieve.session import BROADCAST_ROWS, WrittenTable, create_file, list_names, path_exists, read_file, remove_path, write_once

STORE_SCHEMA = T.StructType(
    [
        T.StructField("review_hash", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_FILE_SCHEMA = T.StructType([*STORE_SCHEMA.fields, T.StructField("prefix", T.StringType())])
_FILTER_SCHEMA = "entry string, prefix string, bits binary"

# Leading hexadecimal digits of a hash that name its folder: 16 ** DIGITS folders. Choose them so that a folder
# stays within some million hashes.
DIGITS = 1
RETRIES = 20
KEPT_VERSIONS = 10


class StoreConflict(RuntimeError):
    """Another writer has added a version first."""


@dataclass(frozen=True)
class Entry:
    """What one insert has written; merged entries have no batch of their own."""

    name: str
    run_id: str | None
    batch_id: int | None
    hashes: int


@dataclass(frozen=True)
class Version:
    """The entries in force at one moment."""

    number: int
    digits: int
    entries: tuple[Entry, ...]

    def to_json(self) -> str:
        return json.dumps({"digits": self.digits, "entries": [vars(e) for e in self.entries]})

    @staticmethod
    def from_json(number: int, text: str) -> Version:
        found = json.loads(text)
        return Version(number, found["digits"], tuple(Entry(**e) for e in found["entries"]))


@dataclass(frozen=True)
class DedupeStore:
    """A store at `path`, on a file system whose rename does not replace files.

    Two writers are told apart by the name of the next version, which only one of them can create. `digits` counts
    when the store is created; an existing store keeps its own.
    """

    spark: SparkSession
    path: str
    digits: int = DIGITS

    # --- versions ---

    def _numbers(self) -> list[int]:
        return sorted(int(name) for name in list_names(self.spark, f"{self.path}/versions") if name.isdigit())

    def version(self) -> Version:
        """The newest version; an absent store has none of its entries."""
        numbers = self._numbers()
        if not numbers:
            return Version(-1, self.digits, ())
        return Version.from_json(numbers[-1], read_file(self.spark, f"{self.path}/versions/{numbers[-1]}"))

    def _commit(self, version: Version) -> None:
        """Make the version the newest one, unless its number is taken."""
        if not create_file(self.spark, f"{self.path}/versions/{version.number}", version.to_json()):
            raise StoreConflict(f"Version {version.number} of {self.path} exists.")

    def _update(self, change) -> Version:
        """Commit what `change` makes of the newest version, anew as long as other writers are faster."""
        for _ in range(RETRIES):
            now = self.version()
            entries = change(now)
            following = Version(now.number + 1, now.digits, tuple(entries))
            try:
                self._commit(following)
                return following
            except StoreConflict:
                continue
        raise StoreConflict(f"{RETRIES} other writers were faster at {self.path}.")

    def create(self) -> DedupeStore:
        """Create the store unless it exists."""
        if self.version().number < 0:
            try:
                self._commit(Version(0, self.digits, ()))
            except StoreConflict:
                pass  # created by another run meanwhile
        return self

    def reset(self) -> DedupeStore:
        """Remove all hashes; earlier versions stay readable until `vacuum`."""
        self._update(lambda now: ())
        return self

    # --- reading ---

    def _rows(self, entries, prefixes: dict[str, list[str]] | None = None) -> DataFrame:
        """Rows of the entries, or of some folders of each."""
        names = [e.name for e in entries]
        if prefixes is not None:
            paths = [f"{self.path}/data/entry={n}/prefix={p}" for n in names for p in prefixes.get(n, ())]
        else:
            paths = [f"{self.path}/data/entry={n}" for n in names]
        if not paths:
            return self.spark.createDataFrame([], STORE_SCHEMA)
        return self.spark.read.schema(_FILE_SCHEMA).option("basePath", f"{self.path}/data").parquet(*paths).select(*STORE_SCHEMA.names)

    def read(self, version: Version | None = None) -> DataFrame:
        """All rows of the newest version, or of a given one."""
        version = version or self.version()
        return self._rows([e for e in version.entries if e.hashes])

    def count(self) -> int:
        """Hashes in the newest version, from its list of entries."""
        return sum(e.hashes for e in self.version().entries)

    def listing(self) -> DataFrame:
        """All hashes, oldest first."""
        return self.read().orderBy("created_at", "review_hash")

    def hashes(self, except_run: str | None = None, except_batch: int | None = None) -> DataFrame:
        """Stored hashes, leaving out one batch that is being written again."""
        return self._rows(self._others(self.version(), except_run, except_batch)).select("review_hash")

    @staticmethod
    def _others(version: Version, run_id: str | None, batch_id: int | None) -> list[Entry]:
        return [e for e in version.entries if e.hashes and (run_id is None or (e.run_id, e.batch_id) != (run_id, batch_id))]

    def folders(self, keys: DataFrame, entries: list[Entry], digits: int) -> dict[str, list[str]]:
        """For each entry, the folders whose filter lets one of the keys pass.

        Keys and filters meet by prefix; what comes back is at most a name for each folder.
        """
        names = [e.name for e in entries]
        filters = self.spark.read.schema(_FILTER_SCHEMA).option("basePath", f"{self.path}/filters").parquet(*[f"{self.path}/filters/entry={n}" for n in names])
        batch = keys.select("review_hash", F.substring("review_hash", 1, digits).alias("prefix"))

        def test(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            hashes = mine["review_hash"].tolist()
            some = [any_passes(hashes, bits) for bits in theirs["bits"]]
            return theirs.loc[some, ["entry", "prefix"]]

        found = batch.groupBy("prefix").cogroup(filters.groupBy("prefix")).applyInPandas(test, "entry string, prefix string").collect()
        folders: dict[str, list[str]] = {}
        for row in found:
            folders.setdefault(row["entry"], []).append(row["prefix"])
        return folders

    def candidates(self, keys: DataFrame, except_run: str | None = None, except_batch: int | None = None, since: Version | None = None) -> DataFrame | None:
        """`review_hash` of the stored rows that may equal one of `keys`, from the folders that may hold them.

        One batch is left out, as it is being written again. With `since`, so is what that version had. None
        if there is nothing to look at.
        """
        version = self.version()
        old = {e.name for e in since.entries} if since else set()
        entries = [e for e in self._others(version, except_run, except_batch) if e.name not in old]
        if not entries:
            return None
        return self._rows(entries, self.folders(keys, entries, version.digits)).select("review_hash")

    # --- writing ---

    def _write(self, rows: DataFrame, digits: int) -> Entry:
        """Write an entry's files, sorted and by prefix, and its filters; it counts once a version lists it."""
        name, seen = uuid.uuid4().hex, Observation()
        placed = rows.select(*STORE_SCHEMA.names, F.substring("review_hash", 1, digits).alias("prefix"))
        # One task for each folder; the folders are as even as the hashes are.
        sorted_rows = placed.repartition("prefix").sortWithinPartitions("prefix", "review_hash")
        sorted_rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("prefix").parquet(f"{self.path}/data/entry={name}")
        if seen.get["rows"]:

            def build(group: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame({"prefix": [group["prefix"].iloc[0]], "bits": [bloom_filter(group["review_hash"].tolist())]})

            filters = placed.select("review_hash", "prefix").groupBy("prefix").applyInPandas(build, "prefix string, bits binary")
            filters.write.parquet(f"{self.path}/filters/entry={name}")
        return Entry(name, None, None, seen.get["rows"])

    def insert(self, hashes: DataFrame, run_id: str, batch_id: int) -> None:
        """Write the hashes of one batch; a repeated call replaces them.

        All of them are stored. `insert_absent` also looks at what other runs have stored meanwhile.
        """
        self._put(self._stamped(hashes, run_id, batch_id), run_id, batch_id)

    def _stamped(self, hashes: DataFrame, run_id: str, batch_id: int) -> DataFrame:
        return hashes.select(
            "review_hash",
            F.current_timestamp().alias("created_at"),
            F.lit(run_id).alias("run_id"),
            F.lit(batch_id).cast("long").alias("batch_id"),
        )

    def _put(self, rows: DataFrame, run_id: str, batch_id: int) -> Version:
        entry = self._write(rows, self.version().digits)
        entry = Entry(entry.name, run_id, batch_id, entry.hashes)
        return self._update(lambda now: [*self._without(now, run_id, batch_id), entry])

    @staticmethod
    def _without(version: Version, run_id: str, batch_id: int) -> list[Entry]:
        return [e for e in version.entries if (e.run_id, e.batch_id) != (run_id, batch_id)]

    def insert_absent(self, hashes: DataFrame, run_id: str, batch_id: int, seen: Version | None = None) -> int:
        """Store those of the unique `hashes` that no other batch has stored, and return how many they are.

        Two runs at once store each hash once: a version is added only if it follows the one that was looked
        at; if not, the entries that came meanwhile are looked up and what they hold is left out. With
        `seen`, a version in which none of the hashes is stored, only what came after it is looked up.
        """
        keys = write_once(hashes.select("review_hash"), "insert-keys")
        try:
            for _ in range(RETRIES):
                now = self.version()
                stored = self.candidates(keys.data, run_id, batch_id, seen)
                if stored is not None:
                    fresh = write_once(unknown_keys(keys, stored), "insert-absent")
                    keys.remove()
                    keys = fresh
                seen = now
                entry = self._write(self._stamped(keys.data, run_id, batch_id), now.digits)
                entry = Entry(entry.name, run_id, batch_id, entry.hashes)
                try:
                    self._commit(Version(now.number + 1, now.digits, (*self._without(now, run_id, batch_id), entry)))
                    return entry.hashes
                except StoreConflict:
                    self._drop([entry.name])
        finally:
            keys.remove()
        raise StoreConflict(f"{RETRIES} other writers were faster at {self.path}.")

    # --- upkeep ---

    def compact(self) -> Version:
        """Merge the entries into one, but for the newest of each run, which may have to be replaced.

        A hash stored twice keeps its oldest row. Readers of earlier versions are not disturbed.
        """
        version = self.version()
        last = {e.run_id: e.name for e in version.entries if e.run_id is not None}
        old = [e for e in version.entries if e.hashes and last.get(e.run_id) != e.name]
        if len(old) < 2:
            return version
        row = F.min(F.struct("created_at", "run_id", "batch_id")).alias("row")
        rows = write_once(self._rows(old).groupBy("review_hash").agg(row).select("review_hash", "row.*"), "merged-entries")
        merged = self._write(rows.data, version.digits)
        rows.remove()
        gone = {e.name for e in old}

        def change(now: Version) -> list[Entry]:
            if not gone <= {e.name for e in now.entries}:
                raise StoreConflict(f"Entries of {self.path} were replaced while they were merged.")
            return [merged, *[e for e in now.entries if e.name not in gone]]

        try:
            return self._update(change)
        except StoreConflict:
            self._drop([merged.name])
            raise

    def vacuum(self, keep: int = KEPT_VERSIONS) -> None:
        """Remove versions but the newest `keep`, and entries that no version lists any more.

        Only while no other run writes: an entry that is being written is in no version yet.
        """
        numbers = self._numbers()
        for number in numbers[:-keep]:
            remove_path(self.spark, f"{self.path}/versions/{number}")
        kept = [Version.from_json(n, read_file(self.spark, f"{self.path}/versions/{n}")) for n in numbers[-keep:]]
        listed = {e.name for version in kept for e in version.entries}
        self._drop([n.removeprefix("entry=") for n in list_names(self.spark, f"{self.path}/data") if n.removeprefix("entry=") not in listed])

    def _drop(self, names: list[str]) -> None:
        for name in names:
            remove_path(self.spark, f"{self.path}/data/entry={name}")
            remove_path(self.spark, f"{self.path}/filters/entry={name}")


def known_keys(keys: WrittenTable, stored: DataFrame, hash_col: str = "review_hash") -> DataFrame:
    """The subset of unique `keys` that `stored` holds.

    The smaller side is the batch. When its counted size allows, it is
    broadcast to the scan of the store, which then needs no shuffle, and so is
    the result, which cannot be larger.
    """
    batch = keys.data.select(F.col(hash_col).alias("review_hash"))
    if keys.rows > BROADCAST_ROWS:
        return batch.join(stored, "review_hash", "left_semi")
    found = stored.join(F.broadcast(batch), "review_hash", "left_semi").distinct()
    return F.broadcast(found)


def unknown_keys(keys: WrittenTable, stored: DataFrame | None) -> DataFrame:
    """The unique `keys` (with all their columns) that `stored` does not hold; all of them without it.

    A small batch is broadcast to the scan of the store, and what is found to the batch, so nothing is
    shuffled; a large one takes a single anti join.
    """
    if stored is None:
        return keys.data
    if keys.rows > BROADCAST_ROWS:
        return keys.data.join(stored, "review_hash", "left_anti")
    return keys.data.join(known_keys(keys, stored), "review_hash", "left_anti")


def _hash_groups(df: DataFrame, hash_col: str, order: str) -> WrittenTable:
    groups = df.groupBy(hash_col).agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies")
    )
    return write_once(groups.withColumnRenamed(hash_col, "review_hash"), "hash-groups")


def _stored(stored: DataFrame | DedupeStore, keys: WrittenTable) -> DataFrame | None:
    """Hashes to compare the keys with: of a store, only those from folders that may hold one of them."""
    return stored.candidates(keys.data) if isinstance(stored, DedupeStore) else stored


def known_hashes(
    df: DataFrame, stored: DataFrame | DedupeStore, hash_col: str = "review_hash", order: str = "ingest_seq"
) -> DataFrame:
    """Rows whose hash is already stored, in a store or in a column of hashes."""
    groups = _hash_groups(df, hash_col, order)
    candidates = _stored(stored, groups)
    if candidates is None:
        return df.limit(0)
    known = known_keys(groups, candidates)
    found = groups.data.join(known, "review_hash").withColumnRenamed("review_hash", "_key")
    rows = df.withColumn("_key", F.col(hash_col))
    return attach_groups(rows, write_once(found, "known-groups"), "inner").select(*df.columns)


def new_hashes(
    df: DataFrame, stored: DataFrame | DedupeStore, hash_col: str = "review_hash", order: str = "ingest_seq"
) -> DataFrame:
    """Hashes that an insert of `df` would add, each with the row it comes from."""
    groups = _hash_groups(df, hash_col, order)
    return unknown_keys(groups, _stored(stored, groups)).select(
        "review_hash", F.col("_first").alias(order)
    )
