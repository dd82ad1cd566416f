"""Near duplicates by SuperMinHash: signatures, bands, verification, union-find.

Each element of a set draws its values in the order of a random permutation of the slots: in
step j it offers j + r (0 <= r < 1) to the j-th slot of its permutation. Ranks within one element
are thus correlated, each slot gets every rank once, and a set is done after step j as soon as all
slots hold less than j + 1. All sets of a batch take each step together in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.llm.common import folded_words, join_unique, mix64, shingle_hashes, utf8
from reviewsieve.llm.components import connected_components, linked_groups
from reviewsieve.session import WrittenTable, write_once

SHINGLE = 5
SIMILARITY = 75  # per cent
SLOTS = 128
BAND = 4  # slots in a band: a pair at the threshold is missed with a probability of 5e-6
ELEMENTS = 150_000  # taken through the steps together
BLOCK = 512  # sets compared with each other in one place
_EMPTY = np.iinfo(np.int64).max


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature (one row of `slots` values) of each set of 64-bit hashes; all sets non-empty.

    A value is 2**32 times the step at which the slot was filled, plus 32 random bits.
    """
    n = len(sets)
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    best = np.full(n * slots, _EMPTY, np.int64)
    places = None
    for step in range(slots):
        z = mix64(x + np.uint64((step + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        pick = (step + (z & np.uint64(0xFFFFFFFF)) % np.uint64(slots - step)).astype(np.int64)
        value = (z >> np.uint64(32)).astype(np.int64) + (step << 32)
        if places is None:
            slot = pick
        else:
            rows = np.arange(len(x))
            slot = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[rows, step]
        np.minimum.at(best, owner * slots + slot, value)
        full = best.reshape(n, slots).max(axis=1) < (step + 1) << 32
        go_on = ~full[owner]
        if not go_on.any():
            break
        x, owner = x[go_on], owner[go_on]
        if places is None:  # the first swap, now that few elements are left
            pick = pick[go_on]
            places = np.tile(np.arange(slots, dtype=np.uint16), (len(x), 1))
            places[np.arange(len(x)), pick] = 0
        else:
            places = places[go_on]
    return best.reshape(n, slots)


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """A 64-bit key for each band of each signature; equal bands at different places differ."""
    n, slots = signature.shape
    parts = signature.astype(np.uint64).reshape(n, slots // band, band)
    key = np.tile(np.arange(1, slots // band + 1, dtype=np.uint64), (n, 1))
    for i in range(band):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def sketch(docs: DataFrame, id_col: str, text_col: str, slots: int = SLOTS, band: int = BAND) -> DataFrame:
    """doc_id, n_shingles, a digest of the set of shingles and the keys of its bands (null for an empty set)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            at = 0
            while at < len(texts):
                start, held, sets = at, 0, []
                while at < len(texts) and held < ELEMENTS:
                    sets.append(shingle_hashes(folded_words(texts[at]), SHINGLE))
                    texts[at] = None
                    held += len(sets[-1])
                    at += 1
                some = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(some, slots), band).tolist()) if some else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, at - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, schema)


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> WrittenTable:
    """Of the pairs (a, b), those whose full sets of shingles are similar enough.

    A text may stand in many pairs, as the centre of a large group; the joins are plain inner
    sort-merge joins, whose heavy keys Spark splits between tasks.
    """
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a")
    kind = pairs.schema["a"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            good = []
            for text_a, text_b in zip(utf8(batch.column(2)), utf8(batch.column(3))):
                if last_set is None or text_a != last:
                    last, last_set = text_a, shingle_hashes(folded_words(text_a), SHINGLE)
                other = shingle_hashes(folded_words(text_b), SHINGLE)
                common = len(np.intersect1d(last_set, other, assume_unique=True))
                good.append(common > 0 and 100 * common >= percent * (len(last_set) + len(other) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return write_once(joined.select("a", "b", "text_a", "text_b").mapInArrow(work, schema).distinct(), "links")


def block_links(nodes: list, parts: list, outer: list[bool], sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links (a, b) between different parts of one block, of pairs with at least one outer node.

    Shingles of all sets are sorted once; each outer set then counts what it shares with every other one.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    sizes = np.array([len(s) for s in sets])
    out = []
    for i in range(len(sets)):
        if outer[i]:
            low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
            counts = high - low
            at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
            common = np.bincount(owner[at], minlength=len(sets))
            for j in np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common)):
                if parts[i] != parts[j]:
                    out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return out


def _rest(members: DataFrame, texts: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links between the components of each bucket (band, node, component), tested in blocks of nodes.

    Nodes outside the largest component of a bucket are outer. Each block of outer nodes meets each block of the
    bucket in one place, where their sets are compared and only links come out: what is moved is a set for each
    block that it meets, never a pair.
    """
    kind = members.schema["node"].dataType
    parts = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"))
    named = members.join(sizes, "band").withColumn("outer", F.col("component") != F.col("main"))
    many = lambda n: F.greatest(F.lit(1), F.ceil(n / block)).cast("int")
    named = named.withColumn("outers", many(F.col("n") - F.col("n_main"))).withColumn("mains", many(F.col("n_main")))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("outer"), F.col("outers")).otherwise(F.col("mains"))).cast("int")
    # Places are (outer block, other block); other blocks are numbered with those of the main component first.
    as_outer = F.transform(F.sequence(F.lit(0), F.col("mains") + own), lambda j: F.struct(own.alias("i"), j.alias("j")))
    as_other = F.transform(F.sequence(own + 1, F.col("outers") - 1), lambda i: F.struct(i.alias("i"), (F.col("mains") + own).alias("j")))
    as_main = F.transform(F.sequence(F.lit(0), F.col("outers") - 1), lambda i: F.struct(i.alias("i"), own.alias("j")))
    places = F.when(~F.col("outer"), as_main).when(own + 1 <= F.col("outers") - 1, F.concat(as_outer, as_other)).otherwise(as_outer)
    placed = named.select("band", "node", "component", "outer", F.explode(places).alias("place")).select("band", "place.i", "place.j", "node", "component", "outer")
    joined = placed.join(texts.select(F.col("doc_id").alias("node"), "text"), "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        place, nodes, components, outer, sets = None, [], [], [], []

        def done() -> pa.RecordBatch:
            links = block_links(nodes, components, outer, sets, percent)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], arrow) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            arrow = batch.schema.field(3).type
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for band, i, j, node, component, is_outer, text in zip(*columns, utf8(batch.column(6))):
                if place != (band, i, j):
                    if nodes:
                        yield done()
                    place, nodes, components, outer, sets = (band, i, j), [], [], [], []
                nodes.append(node)
                components.append(component)
                outer.append(is_outer)
                sets.append(shingle_hashes(folded_words(text), SHINGLE))
        if nodes:
            yield done()

    return joined.select("band", "i", "j", "node", "component", "outer", "text").mapInArrow(work, schema).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = SIMILARITY,
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of their 5-word shingles of at least `percent`.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable over
    links) and kept (doc_id = component_id).

    Null, empty and blank texts have no shingles and are linked with nothing. Equal sets are linked
    at once, whatever their number. Rows of one id are one document, linked if any of its texts is.
    A row with a null id keeps it as its component and is kept; nothing is linked through it. Empty tables give
    no rows; other columns are not read.
    """
    sketches = write_once(sketch(docs, id_col, text_col), "sketches")
    some = sketches.data.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # Copies of one set are one class, named by its smallest id.
    classes = write_once(some.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = some.join(classes.data.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"], "left_semi")
    keys = reps.select(F.explode("bands").alias("band"), F.col("doc_id").alias("node"), F.col("n_shingles").alias("mark"))
    shared = keys.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band")
    members = write_once(keys.join(shared, "band").distinct(), "buckets")
    wanted = members.data.select(F.col("node").alias("doc_id")).distinct()
    texts = write_once(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(wanted, "doc_id", "left_semi"), "texts")
    # Sets whose sizes alone rule out the similarity are not compared.
    sizes = lambda m, n: 100 * F.least(m, n) >= percent * F.greatest(m, n)
    groups = linked_groups(members.data, lambda pairs: _verify(pairs, texts.data, percent), sizes, lambda open_members: _rest(open_members, texts.data, percent))
    # Classes of more than one copy and ids of several classes link through their ids.
    rep_of = join_unique(some.select("doc_id", "set_key"), classes.data, "set_key", "copies", sketches.rows).where("doc_id <> rep").select("doc_id", "rep")
    edges = rep_of.union(groups.data.select("node", "component"))
    final = connected_components(edges)
    return (
        sketches.data.select("doc_id", "n_shingles")
        .join(final.data.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumnRenamed("doc_id", id_col)
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id, with all its columns.

    Of several rows of one id, which are one document, that with the smallest MD5 of its text stays. Rows with a null
    id all stay, as do texts without words unless they share an id.
    """
    groups = write_once(near_duplicates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), percent=percent), "groups")
    gone = write_once(groups.data.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct(), "gone")
    repeated = write_once(groups.data.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(id_col)).agg(F.count("*").alias("n")).where("n > 1").select(id_col), "repeated")
    kept = docs.join(gone.sized_for_join(), id_col, "left_anti")
    if repeated.rows:
        several = kept.join(repeated.sized_for_join(), id_col, "left_semi")
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        one = several.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(whole, F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))).alias("whole"))
        kept = kept.join(repeated.sized_for_join(), id_col, "left_anti").unionByName(one.select("whole.*"))
    groups.remove()
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
