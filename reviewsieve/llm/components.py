"""Connected components: union-find inside each task, star contraction between tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.session import WrittenTable, write_once

# Edges left after contraction that one task may finish with; the result does not depend on it.
ONE_TASK_EDGES = 500_000


class DisjointSets:
    """Union-find whose sets are named by their smallest member."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self.parent[high] = low
            self.parent.setdefault(low, low)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a partition by one edge from each node to the smallest that it reaches here."""
    sets, schema = DisjointSets(), None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
    if schema is not None:
        pairs = [(x, root) for x in list(sets.parent) if (root := sets.find(x)) != x]
        for i in range(0, len(pairs), 50_000):
            part = pairs[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part], schema.field(k).type) for k in (0, 1)], schema=schema)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (node, component), node above component."""
    lowest = (
        edges.select(F.col("node").alias("u"), F.col("component").alias("v"))
        .union(edges.select("component", "node"))
        .groupBy("u")
        .agg(F.min("v").alias("low"))
        .select("u", F.least("u", "low").alias("low"))
    )
    large = edges.join(lowest, edges.component == lowest.u).select("node", F.col("low").alias("component")).where("node <> component").distinct()
    down = large.groupBy(F.col("node").alias("u")).agg(F.min("component").alias("low"))
    small = large.join(down, large.node == down.u).select(F.col("component").alias("node"), F.col("low").alias("component")).where("node <> component")
    return small.union(down.select("u", "low")).distinct()


def connected_components(edges: DataFrame, one_task_edges: int = ONE_TASK_EDGES) -> WrittenTable:
    """The component of each node that is not the smallest of its component.

    `edges` has two columns of one ordered type. Returns a written table (node, component),
    unique in node, where component is the smallest node reachable. Edges with a null or with
    equal ends are ignored; a node that is absent is its own component.
    """
    kind = edges.schema.fields[0].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("component", kind)])
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("component")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    table = write_once(pairs.mapInArrow(_contract, schema), "forest")
    seen = None
    while table.rows > one_task_edges:
        mark = table.data.agg(F.sum(F.xxhash64("node", "component").cast("decimal(38,0)")), F.count("*")).first()
        if mark == seen:
            return table
        seen = mark
        following = write_once(_stars(table.data), "stars")
        table.remove()
        table = following
    final = write_once(table.data.repartition(1).mapInArrow(_contract, schema), "components")
    table.remove()
    return final


def linked_groups(
    members: DataFrame,
    verify: Callable[[DataFrame], WrittenTable],
    possible: Callable[[Column, Column], Column],
    rest: Callable[[DataFrame], DataFrame],
) -> WrittenTable:
    """Components (node, component) of the nodes that share buckets, over the pairs that are found to be linked.

    `members` has a bucket `band`, a `node` and a `mark` of the node. Each bucket is first tested as a star around its
    most central node, so that a group of n near copies is joined by about n comparisons: of the pairs (a, b) whose
    marks are `possible`, `verify` returns those that are linked. The centre then leaves the bucket, as all its pairs are
    known. Buckets whose other nodes are still in several components go, with `component`, to
    `rest`, which returns the links between those components. So no pair of a bucket that could join two components
    is left untested.
    """
    size = members.groupBy("band").agg(F.count("*").alias("n"))
    central = members.join(size, "band").groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = write_once(members.join(central, "node"), "members")
    rank = F.struct("degree", "node")
    centre = ranked.data.groupBy("band").agg(F.max_by(F.struct("node", "mark"), rank).alias("c"))
    around = write_once(ranked.data.join(centre, "band").where("node <> c.node"), "stars")
    pairs = around.data.where(possible(F.col("mark"), F.col("c.mark"))).select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
    links = verify(write_once(pairs, "pairs").data)
    first = connected_components(links.data)
    labelled = around.data.select("band", "node", "mark").join(first.data, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = write_once(labelled, "labelled")
    mixed = labelled.data.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    more = write_once(rest(labelled.data.join(mixed.select("band"), "band")), "links")
    both = connected_components(links.data.union(more.data))
    for table in (ranked, around, labelled, first, links, more):
        table.remove()
    return both
