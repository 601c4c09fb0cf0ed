r"""Centroid clustering in whole numbers; nearest centroids by equal-average equal-variance search.

For a vector x and a centroid c of k components, with sums S and with D(v) the root of
`k * sum of squares - S^2` (k times the deviation),

    k * distance^2 >= (S(x) - S(c))^2 + (D(x) - D(c))^2.

Centroids are sorted by their sum, which is their mean but for a factor. A vector first meets
the centroid whose mean is next to its own, then goes outward on both sides. A side ends where
the first term alone is above the best distance so far, since it only grows from there; a
centroid that is rejected by both terms is passed over. Only the others are compared in
full, in 64-bit whole numbers, so distances and ties are exact. The bounds are floats that are
lowered by more than their error, so rounding never rejects a centroid wrongly. All vectors of
a batch take their steps together, as arrays.

As Spark jobs. A round is one pass over the table: a task assigns its vectors and gives, for
each cluster, the number of its vectors, their sum and their distances. So what is shuffled per
task, and what reaches the driver, is `clusters * (dim + 2)` numbers whatever the table, and a
hot cluster costs no more than others. Nothing is written or kept between rounds but the
centroids; a task that is lost is run again.

Defined cases: vectors that are null, of another length, or hold null or non-finite components
give no row; nor do those with a component beyond 2^19, whose distances may not fit a long
(64 components). A row with a null id is no first centroid, but is assigned; rows that share an id count
each. Fewer rows than clusters: as many clusters as rows. An empty table gives an empty result.
A total that does not fit a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col
from tidewell.llm.whole_vectors import floor_mean, starting, usable, whole

CLUSTERS, ROUNDS, DIM = 40, 5, 64
#: Vectors that take their steps together.
TOGETHER = 4096
#: What a bound is lowered by, as a share; the error of its floats is some 1e-15.
_SLACK = 1e-9


@dataclass(frozen=True)
class Clusters:
    """Final centroids, and per centroid the number of its vectors and the sum of their distances."""

    centroids: np.ndarray
    sizes: list[int]
    inertia: list[int]


def _deviation(rows: np.ndarray) -> np.ndarray:
    sums, squares = rows.sum(axis=1), np.einsum("ij,ij->i", rows, rows)
    return np.sqrt(np.maximum(rows.shape[1] * squares.astype(np.float64) - sums.astype(np.float64) ** 2, 0.0))


class MeanOrder:
    """Centroids sorted by mean, and the search among them."""

    def __init__(self, centroids: np.ndarray):
        self.order = np.lexsort((np.arange(len(centroids)), centroids.sum(axis=1)))
        self.rows = centroids[self.order]
        self.sums = self.rows.sum(axis=1).astype(np.float64)
        self.deviations = _deviation(self.rows)
        self.compared = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the number of the nearest centroid (of equals the smallest) and the squared distance."""
        n, k = len(self.rows), x.shape[1]
        sums, deviations = x.sum(axis=1).astype(np.float64), _deviation(x)
        best = np.full(len(x), np.iinfo(np.int64).max, dtype=np.int64)
        number = np.full(len(x), n, dtype=np.int64)
        right = np.searchsorted(self.sums, sums)
        left = right - 1

        def meet(who: np.ndarray, at: np.ndarray) -> None:
            """Compare in full, unless the deviations say otherwise."""
            gap = (sums[who] - self.sums[at]) ** 2 + (deviations[who] - self.deviations[at]) ** 2
            stay = gap * (1 - _SLACK) - k <= k * best[who].astype(np.float64) * (1 + _SLACK)
            who, at = who[stay], at[stay]
            self.compared += len(who)
            apart = x[who] - self.rows[at]
            distance, name = np.einsum("ij,ij->i", apart, apart), self.order[at]
            better = (distance < best[who]) | ((distance == best[who]) & (name < number[who]))
            best[who[better]], number[who[better]] = distance[better], name[better]

        def reach(who: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Those whose side does not end here by the means alone."""
            return who[(sums[who] - self.sums[at[who]]) ** 2 * (1 - _SLACK) - k <= k * best[who].astype(np.float64) * (1 + _SLACK)]

        up, down = np.flatnonzero(right < n), np.flatnonzero(left >= 0)
        while len(up) or len(down):
            if len(up):
                up = reach(up, right)
                meet(up, right[up])
                right[up] += 1
                up = up[right[up] < n]
            if len(down):
                down = reach(down, left)
                meet(down, left[down])
                left[down] -= 1
                down = down[left[down] >= 0]
        return number, best


def _assigned(batches: Iterator[pa.RecordBatch], search: MeanOrder, dim: int, place: int):
    """Stretches of the batches with their whole vectors, cluster and distance."""
    for batch in batches:
        for begin in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(begin, TOGETHER)
            x = whole(part.column(place), dim)
            yield (part, x, *search.nearest(x))


def _totals(rows: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[list[int]], list[int]]:
    """Per centroid: number of its vectors, their sums, the sum of their distances."""
    n, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((n, dim + 2), dtype=object)  # of any size
        for _, x, number, distance in _assigned(batches, MeanOrder(centroids), dim, 0):
            numbers = np.column_stack([np.ones(len(x), dtype=np.int64), x])
            order = np.argsort(number, kind="stable")
            names, begins = np.unique(number[order], return_index=True)
            held[names, :-1] += np.add.reduceat(numbers[order], begins, axis=0).astype(object)
            for name, far in zip(names, np.split(distance[order], begins[1:])):
                held[name, -1] += sum(far.tolist())
        flat = [str(v) for v in held.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat, pa.string())], names=["at", "part"])

    parts = rows.select("vector").mapInArrow(run, "at int, part string")
    summed = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    total = {r["at"]: int(r.total) for r in summed.collect()}  # n * (dim + 2) numbers
    table = [[total[i * (dim + 2) + j] for j in range(dim + 2)] for i in range(n)] if total else [[0] * (dim + 2)] * n
    return [r[0] for r in table], [r[1:-1] for r in table], [r[-1] for r in table]


def _rows(embeddings: DataFrame, id: str, vector: str, dim: int) -> DataFrame:
    return embeddings.where(usable(vector, dim)).select(col(id).alias("id"), col(vector).alias("vector"))


def fit(embeddings: DataFrame, id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
        dim: int = DIM) -> Clusters:
    """Starts from the rows of smallest sha256 of `2:<id>`; a cluster without vectors keeps its centroid."""
    rows = _rows(embeddings, id, vector, dim)
    centroids = starting(rows, clusters, dim, F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256))
    for _ in range(rounds if len(centroids) else 0):
        sizes, sums, _ = _totals(rows, centroids)
        centroids = np.array([[floor_mean(s, n) for s in row] if n else old.tolist() for n, row, old in zip(sizes, sums, centroids)], dtype=np.int64)
    sizes, _, inertia = _totals(rows, centroids) if len(centroids) else ([], [], [])
    return Clusters(centroids, sizes, inertia)


def assign(embeddings: DataFrame, model: Clusters, id: str = "vec_id", vector: str = "embedding", dim: int = DIM) -> DataFrame:
    """(id, cluster, distance) of every usable vector."""
    rows = _rows(embeddings, id, vector, dim)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(model.centroids):
            for part, _, number, distance in _assigned(batches, MeanOrder(model.centroids), dim, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                                                 names=["id", "cluster", "distance"])

    return rows.mapInArrow(run, f"id {kind}, cluster int, distance bigint").withColumnRenamed("id", id)


def digests(assigned: DataFrame, model: Clusters, id: str = "vec_id") -> DataFrame:
    """With the sums of distances and each centroid's hash, which are one row per cluster."""
    most = (1 << 63) - 1
    long = lambda v: v if v <= most else None
    text = lambda c: ",".join(map(str, c)).encode()
    of_cluster = [(i, long(v), hashlib.sha256(text(c)).hexdigest()) for i, (c, v) in enumerate(zip(model.centroids.tolist(), model.inertia))]
    spark = assigned.sparkSession
    known = spark.createDataFrame(of_cluster, "_cluster int, cluster_inertia bigint, centroid_sha256 string")
    joined = assigned.join(F.broadcast(known), F.col("cluster") == F.col("_cluster"))  # as many rows as clusters
    return joined.select(col(id), "cluster", "distance", "cluster_inertia", F.lit(long(sum(model.inertia))).cast("long").alias("inertia"), "centroid_sha256")
