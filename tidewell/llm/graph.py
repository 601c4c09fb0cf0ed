"""Connected components of an undirected graph, as alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import checkpointed


#: Graphs of so many edges at most are worked on in one task, which needs no shuffle.
SMALL = 50_000
#: Types whose values Python orders as Spark does.
ORDERED = ("tinyint", "smallint", "int", "bigint", "string")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges of a small graph: trees whose roots are their smallest nodes."""
    above: dict = {}

    def root(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            above.setdefault(u, u)
            above.setdefault(v, v)
            x, y = root(u), root(v)
            above[max(x, y)] = min(x, y)
    if above:
        yield pa.RecordBatch.from_arrays([pa.array(list(above), kind), pa.array([root(x) for x in above], kind)], names=["node", "component"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge the smallest node it can reach.

    Nodes are numbers or texts. A round takes the smallest neighbour of each node by one
    aggregation and joins it back, so no node's neighbours ever meet in one task; rounds
    grow with the logarithm of the longest path. A graph that is counted to be small is
    united in one task; if its nodes are neither whole numbers nor texts, it is kept in
    one partition, where the same steps need no shuffle.
    """
    e, mark, small = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()), None, None
    kind = e.schema["u"].dataType.simpleString()
    ways = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("w")
    while True:
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        small = seen[0] <= SMALL if small is None else small
        if small and kind in ORDERED:
            return e.coalesce(1).mapInArrow(_united, f"node {kind}, component {kind}")
        near = (lambda df: df.coalesce(1)) if small else (lambda df: df)
        e = near(e)
        if tuple(seen) == mark or not seen[0]:
            ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
                                     F.struct(F.col("v").alias("node"), F.col("v").alias("component")))).alias("w")
            return e.select(ends).select("w.*").distinct()
        mark = tuple(seen)
        both = e.select(ways).select("w.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = large.join(least, "u").select(F.greatest("v", "m").alias("x"), F.least("v", "m").alias("m"))
        e = checkpointed(near(small_star.select(F.col("x").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).where("u <> v")).distinct())
