"""Shards of near equal size from a minimax contiguous partition of ordered groups.

Groups of equal texts are atomic. They are ordered by their smallest doc_id, and the
smallest capacity for which a greedy fill of the order needs no more than the given number
of shards is found by binary search. The order is then cut at that capacity.

The groups stay in a table of running sums. The driver knows some of the sums, at first a
coarse grid, and runs the greedy fill on them twice: once as if no other cut existed, once as
if any cut were possible. Where the two disagree, the gaps that they touched are resolved with
one scan that returns a fixed number of further sums, until the capacity is certain. So the
driver holds some thousands of numbers whatever the input.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewsieve.llm.common import join_unique, running_totals
from reviewsieve.session import write_once

SHARDS = 16
COARSE = 4096  # sums asked for first
FINE = 64  # further sums asked for in each gap


class Ends:
    """Ends of the groups on the line from 0 to the total, known in part.

    A known end comes with its ordinal, the number of groups up to it, so it is certain
    whether others lie between two that are known.
    """

    def __init__(self, total: int, groups: int, fetch: Callable[[list[tuple[int, int]], int], list[tuple[int, int]]]):
        self.total, self.fetch = total, fetch
        self.ordinal = {0: 0, total: groups}
        self.known = sorted(self.ordinal)
        if groups > 1:
            self.resolve({(0, total)}, COARSE)

    def resolve(self, gaps: set[tuple[int, int]], pieces: int = FINE) -> None:
        self.ordinal.update(self.fetch(sorted(gaps), pieces))
        self.known = sorted(self.ordinal)

    def below(self, target: int, unsure: set) -> tuple[int, bool]:
        """Largest known end up to `target`, and whether no unknown one can lie between."""
        if target >= self.total:
            return self.total, True
        i = bisect_right(self.known, target) - 1
        low, high = self.known[i], self.known[i + 1]
        # An unknown end in the gap lies above low; at low itself the target is met exactly.
        sure = low == target or self.ordinal[high] - self.ordinal[low] == 1
        if not sure:
            unsure.add((low, high))
        return low, sure

    def above(self, target: int, unsure: set) -> int:
        """Smallest known end from `target` on."""
        if target <= 0:
            return 0
        i = bisect_left(self.known, target)
        high, low = self.known[i], self.known[i - 1]
        if high != target and self.ordinal[high] - self.ordinal[low] != 1:
            unsure.add((low, high))
        return high

    def fits(self, capacity: int, shards: int, hopeful: bool, unsure: set) -> bool:
        """Greedy fill: can shards of this capacity take everything?"""
        at = 0
        for _ in range(shards):
            end, sure = self.below(at + capacity, unsure)
            at = at + capacity if hopeful and not sure else end
            if at >= self.total:
                return True
        return False


def smallest_capacity(ends: Ends, shards: int, largest: int) -> int:
    """Binary search of the smallest capacity that a greedy fill can keep to."""

    def first(low: int, high: int, hopeful: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if ends.fits(middle, shards, hopeful, set()) else (middle + 1, high)
        return low

    low = max(-(-ends.total // shards), largest)
    high = -(-ends.total // shards) + largest
    while True:
        low = first(low, high, True)
        high = first(low, high, False)
        if low == high:
            return low
        unsure: set = set()
        for capacity in (low, (low + high) // 2, high):
            for hopeful in (True, False):
                ends.fits(capacity, shards, hopeful, unsure)
        ends.resolve(unsure)


def cuts(ends: Ends, shards: int, capacity: int) -> list[int]:
    """Ends of the shards: none above the capacity, each as near as may be to an equal share of the rest."""
    while True:
        unsure: set = set()
        least = [ends.total]  # from the last shard backwards: where each must end at least
        for _ in range(shards - 1):
            least.append(ends.above(least[-1] - capacity, unsure))
        least.reverse()
        found, at = [], 0
        for i in range(shards):
            most, _ = ends.below(at + capacity, unsure)
            share = at + (ends.total - at) // (shards - i)
            end, _ = ends.below(min(share, most), unsure)
            if end == at and at < ends.total:
                end = min(most, ends.above(max(at + 1, share), unsure))
            at = max(end, least[i])
            found.append(at)
        found[-1] = ends.total
        if not unsure:
            return found
        ends.resolve(unsure)


def partition_groups(groups: DataFrame, shards: int, order: list[str]) -> tuple[DataFrame, list[int]]:
    """Give each group (`size` of at least 1, `n_rows`) its shard; returns them with `ordinal` too, and the shards' ends."""
    placed, table = running_totals(groups.withColumn("ordinal", F.lit(1).cast("long")), order, ["size", "ordinal"], "groups")
    placed = placed.drop("ordinal").withColumnRenamed("ordinal_end", "ordinal")
    total, count, largest = placed.agg(F.coalesce(F.max("size_end"), F.lit(0)), F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    if not count:
        return placed.withColumn("shard", F.lit(0)), [0] * shards

    def fetch(gaps: list[tuple[int, int]], pieces: int) -> list[tuple[int, int]]:
        starts, stops = (np.array([g[i] for g in gaps], np.int64) for i in (0, 1))

        def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                end = frame["size_end"].to_numpy()
                gap = np.searchsorted(starts, end, "left") - 1  # the last gap that starts below the end
                inside = (gap >= 0) & (end < stops[gap])
                frame, end, gap = frame[inside], end[inside], gap[inside]
                width = (stops - starts)[gap]
                piece = ((end - starts[gap]).astype(float) * pieces / width).astype(np.int64)
                both = frame.groupby([gap, piece], sort=False)
                yield pd.concat([both.min(), both.max()]).rename_axis(["gap", "piece"]).reset_index()

        ends = placed.select("size_end", "ordinal").mapInPandas(pick, "gap long, piece long, size_end long, ordinal long")
        pair = F.struct("size_end", "ordinal")
        rows = ends.groupBy("gap", "piece").agg(F.min(pair).alias("low"), F.max(pair).alias("high")).collect()
        return [tuple(end) for r in rows for end in (r["low"], r["high"])]

    ends = Ends(total, count, fetch)
    found = cuts(ends, shards, smallest_capacity(ends, shards, largest))
    shard = F.lit(shards - 1)
    for i in range(shards - 2, -1, -1):
        shard = F.when(F.col("size_end") <= found[i], F.lit(i)).otherwise(shard)
    return placed.withColumn("shard", shard), found


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of `shards` shards of near equal bytes; rows of equal text stay together.

    Returns the id, size (UTF-8 bytes of the text plus 1), text_crc32, law ("bytes"), shard, slot
    (position in the shard, from 0 without gaps) and grown_shard (null: the law is not `key`).

    A null text counts as an empty one and is grouped with it. Null ids come first in the order;
    repeated rows each get a slot. An empty table gives no rows. Other columns are not read. With
    fewer groups than shards, or a group above an equal share, some shards may stay empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    units = write_once(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "units",
    )
    groups = units.data.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("size"), F.count("*").alias("n_rows"))
    placed, _ = partition_groups(groups, shards, ["first_id", "digest"])
    where = write_once(placed.select("digest", "n_rows", "ordinal", "shard"), "shards").data
    rows = join_unique(units.data, where, "digest", "n_rows", units.rows).drop("digest", "n_rows")
    indexed, _ = running_totals(rows.withColumn("at", F.lit(1).cast("long")), ["ordinal", "doc_id"], ["at"], "slots")
    first = indexed.groupBy("shard").agg(F.min("at_end").alias("first"))
    return indexed.join(F.broadcast(first), "shard").select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("at_end") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
