r"""Approximate nearest neighbours: NN-descent builds the graph, greedy search answers.

Building. Vectors are dealt to the cells of their `overlap` nearest k-means centres and
compared within blocks of a cell: the first neighbour lists. Then rounds of joins: the
neighbours of a node (its own and, up to `degree` of them by hash, those that name it)
are brought together with their vectors, compared with one another, and each learns of
the better ones, merged into its list of the `degree` best. Only pairs with a neighbour
that is new since the last round are looked at. Rounds end when less than `settled` of
the list entries change.

Searching. A query is a row of the index. Its beam starts with its own list and the
nodes that name it; each step opens the best `opened` nodes not yet opened of every
query, joins their lists and vectors, and keeps the `beam` best, until all of these are
opened; the beam only gets better, so this ends.

Vectors travel as they are stored, and every cosine, of lists and beam alike, is that of
the original vectors in double precision, so near copies are told apart. Every vector is
indexed; the number of neighbours kept per node is NN-descent's own parameter.
Recall against brute force is measured in the tests and in the README.

Defined cases: ids are whole numbers; vectors that are null, zero, of another length than
most or hold null or non-finite components, and rows with a null id, take no part;
rows that share an id are one node with the vector of smallest bytes; equal scores go to
the smaller id; with fewer candidates than asked for, all are returned if found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import col, staged
from tidewell.llm.embedding_dedup import centres
from tidewell.llm.vectors import dimension, packed, parse, unit, unpacked

#: Rows that one group of a merge or a local join holds, about; fewer if they have many components.
GROUP, COMPONENTS = 40_000, 64
LISTS = "id bigint, near array<bigint>, sims array<double>"


@dataclass(frozen=True)
class Index:
    vectors: DataFrame  # id, x: the components as stored
    graph: DataFrame  # id, near, sims, fresh: best first
    nodes: int
    degree: int
    width: str  # numpy's name of the type of the components in x


def _units(column: pa.Array | pa.ChunkedArray, width: str) -> np.ndarray:
    rows = unpacked(column, width).astype(np.float64)
    return unit(rows) if rows.size else rows


def _lists(ids: np.ndarray, near: np.ndarray, sims: np.ndarray, more: dict[str, np.ndarray] | None = None) -> pa.Table:
    """A row per distinct id; the entries must come sorted by id."""
    begins = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, dtype=np.int64)
    offsets = pa.array(np.concatenate([begins, [len(ids)]]), pa.int32())
    columns = {"near": pa.array(near, pa.int64()), "sims": pa.array(sims, pa.float64()), **{k: pa.array(v) for k, v in (more or {}).items()}}
    return pa.table({"id": pa.array(ids[begins], pa.int64()), **{k: pa.ListArray.from_arrays(offsets, v) for k, v in columns.items()}})


def _entries(t: pa.Table, *names: str) -> list[np.ndarray]:
    """Id and list entries, one element per entry."""
    first = t.column(names[0]).combine_chunks()
    lengths = np.diff(np.asarray(first.offsets))
    return [np.repeat(np.asarray(t.column("id")), lengths), *(np.asarray(t.column(n).combine_chunks().flatten()) for n in names)]


def _best(a: np.ndarray, b: np.ndarray, s: np.ndarray, most: int, known: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct (a, b), the `most` best of each a, sorted by a, then best first; `known` is true if any copy is."""
    known = np.zeros(len(a), dtype=bool) if known is None else known
    order = np.lexsort((~known, b, a))
    a, b, s, known = a[order], b[order], s[order], known[order]
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, dtype=bool)
    a, b, s, known = a[first], b[first], s[first], known[first]
    order = np.lexsort((b, -s, a))
    a, b, s, known = a[order], b[order], s[order], known[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < most
    return [a[keep], b[keep], s[keep], known[keep]]


def _bucket(c: Column, rows: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(max(1, -(-rows // GROUP)))).cast("int").alias("bucket")


def _first_lists(vectors: DataFrame, c: np.ndarray, degree: int, overlap: int, block: int, width: str) -> DataFrame:
    """Best of each vector within the blocks it is dealt to: several rows per id."""

    def near(group: pa.Table) -> pa.Table:
        ids, rows = np.asarray(group.column("id")), _units(group.column("x"), width)
        k = min(degree, len(ids) - 1)
        if k < 1:
            return _lists(*(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.float64)))
        sims = rows @ rows.T
        np.fill_diagonal(sims, -9)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        order = np.argsort(ids, kind="stable")
        best = best[order]
        return _lists(np.repeat(ids[order], k), ids[best].ravel(), np.take_along_axis(sims[order], best, axis=1).ravel())

    dealt = (vectors.select("id", "x").mapInArrow(_with_cells(c, overlap, width), "id bigint, x binary, cells array<int>")
             .select("id", "x", F.explode("cells").alias("cell")))
    sizes = {r.cell: r["count"] for r in dealt.groupBy("cell").count().collect()}  # a row per cell
    cuts = F.array(*[F.lit(max(1, -(-sizes.get(i, 0) // block))) for i in range(len(c))])
    cut = F.pmod(F.xxhash64("id", "cell"), F.element_at(cuts, F.col("cell") + 1))
    return dealt.withColumn("cut", cut).groupBy("cell", "cut").applyInArrow(near, LISTS)


def _with_cells(c: np.ndarray, overlap: int, width: str):
    k = min(overlap, len(c))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.argpartition(-(_units(batch.column(1), width) @ c.T), k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells.tolist(), pa.list_(pa.int32()))],
                                                 names=["id", "x", "cells"])

    return deal


def _merged(lists: DataFrame, rows: int, degree: int) -> DataFrame:
    """`lists`: id, near, sims, old. One row per id with its best; an entry is fresh if no old list had it."""

    def merge(group: pa.Table) -> pa.Table:
        a, b, s = _entries(group, "near", "sims")
        lengths = np.diff(np.asarray(group.column("near").combine_chunks().offsets))
        known = np.repeat(np.asarray(group.column("old")), lengths)
        a, b, s, known = _best(a, b, s, degree, known)
        return _lists(a, b, s, {"fresh": ~known})

    return (lists.withColumn("bucket", _bucket(F.col("id"), rows)).groupBy("bucket")
            .applyInArrow(merge, LISTS + ", fresh array<boolean>"))


def _joined(vectors: DataFrame, graph: DataFrame, nodes: int, degree: int, dim: int, width: str) -> DataFrame:
    """One round: what the neighbours of each node learn of one another."""
    flat = graph.select("id", F.explode(F.arrays_zip("near", "fresh")).alias("e")).select("id", "e.near", "e.fresh")
    named = Window.partitionBy("v").orderBy(F.xxhash64("v", "u"), "u")
    back = (flat.select(F.col("near").alias("v"), F.col("id").alias("u"), "fresh")
            .withColumn("rank", F.row_number().over(named)).where(F.col("rank") <= degree).drop("rank"))
    edges = flat.select(F.col("id").alias("v"), F.col("near").alias("u"), "fresh").union(back)
    worst = graph.select(F.col("id").alias("u"), F.when(F.size("sims") >= degree, F.element_at("sims", -1)).otherwise(F.lit(-9.0)).alias("worst"))
    info = vectors.select(F.col("id").alias("u"), "x").join(worst, "u")
    most = max(4, degree // 3)

    def learn(group: pa.Table) -> pa.Table:
        v, u = np.asarray(group.column("v")), np.asarray(group.column("u"))
        fresh, worst = np.asarray(group.column("fresh")), np.asarray(group.column("worst"))
        rows = _units(group.column("x"), width)
        order = np.lexsort((~fresh, u, v))
        order = order[np.concatenate([[True], (v[order][1:] != v[order][:-1]) | (u[order][1:] != u[order][:-1])])]
        cuts = np.flatnonzero(np.concatenate([[True], v[order][1:] != v[order][:-1], [True]]))
        found = []
        for begin, end in zip(cuts[:-1], cuts[1:]):
            own = order[begin:end]
            if len(own) < 2:
                continue
            x, f = rows[own], fresh[own]
            sims = x @ x.T
            sims[~(f[:, None] | f[None, :])] = -9
            np.fill_diagonal(sims, -9)
            if len(own) > most:
                best = np.argpartition(-sims, most - 1, axis=1)[:, :most]
                values = np.take_along_axis(sims, best, axis=1)
            else:
                best, values = np.broadcast_to(np.arange(len(own)), sims.shape), sims
            i, j = np.nonzero(values > worst[own][:, None])
            found.append((u[own][i], u[own][best[i, j]], values[i, j]))
        if not found:
            return _lists(*(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.float64)))
        return _lists(*_best(*map(np.concatenate, zip(*found)), degree)[:3])

    with_vectors = edges.join(info, "u").withColumn("bucket", _bucket(F.col("v"), nodes * 2 * degree * -(-dim // COMPONENTS)))
    return with_vectors.groupBy("bucket").applyInArrow(learn, LISTS)


def build(embeddings: DataFrame, id: str = "vec_id", vector: str = "embedding", degree: int = 40, rounds: int = 4,
          overlap: int = 8, cell: int = 1000, block: int = 2000, settled: float = 0.05) -> Index | None:
    """None if no vector takes part."""
    raw = embeddings.select(col(id).cast("long").alias("id"), col(vector).alias("vector")).where("id is not null")
    dim = dimension(embeddings, vector)
    width = "<f4" if raw.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ok = parse(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), packed(rows[ok], width)], names=["id", "x"])

    if not dim:
        return None
    vectors = staged(raw.mapInArrow(read, "id bigint, x binary").groupBy("id").agg(F.min("x").alias("x")))
    nodes = vectors.count()
    if not nodes:
        return None
    c = centres(raw, dim, max(1, min(2048, nodes // cell)), 2)
    first = _first_lists(vectors, c, degree, overlap, block, width).withColumn("old", F.lit(False))
    graph = staged(_merged(first, nodes * overlap, degree))
    for _ in range(rounds):
        learnt = _joined(vectors, graph, nodes, degree, dim, width).withColumn("old", F.lit(False))
        kept = graph.select("id", "near", "sims", F.lit(True).alias("old"))
        graph = staged(_merged(kept.unionByName(learnt), nodes * 3, degree))
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda f: f)))).first()[0] or 0
        if changed < settled * nodes * degree:
            break
    return Index(vectors, graph, nodes, degree, width)


def _scored(pairs: DataFrame, left: DataFrame, right: DataFrame, width: str) -> DataFrame:
    """(q, w, sim) of the pairs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sims = np.einsum("ij,ij->i", _units(batch.column(2), width), _units(batch.column(3), width))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], names=["q", "w", "sim"])

    joined = (pairs.join(right.select(F.col("id").alias("w"), F.col("x").alias("y")), "w")
              .join(left.select(F.col("id").alias("q"), "x"), "q"))
    return joined.select("q", "w", "x", "y").mapInArrow(score, "q bigint, w bigint, sim double")


def search(index: Index, queries: DataFrame, k: int = 5, beam: int = 96, opened: int = 24, id: str = "vec_id") -> DataFrame:
    """`queries` holds ids of indexed rows. (query_id, rank, vec_id, score): the k nearest found of each."""
    asked = queries.select(col(id).cast("long").alias("q")).distinct()
    own = index.vectors.join(asked.withColumnRenamed("q", "id"), "id", "left_semi")
    flat = index.graph.select("id", F.explode("near").alias("near"))
    named = Window.partitionBy("id").orderBy(F.xxhash64("id", "near"), "near")
    back = flat.select(F.col("near").alias("id"), F.col("id").alias("near")).withColumn("rank", F.row_number().over(named))
    links = staged(flat.union(back.where(F.col("rank") <= index.degree).drop("rank")).distinct()
                   .groupBy("id").agg(F.collect_list("near").alias("links")))  # at most 2 * degree of each
    best = Window.partitionBy("q").orderBy(F.desc("sim"), "w")
    start = asked.join(links, asked.q == links.id).select("q", F.explode("links").alias("w"))
    scored = _scored(start, own, index.vectors, index.width).withColumn("seen", F.lit(False))
    state = staged(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam))
    while not state.where("not seen").isEmpty():
        rank = F.row_number().over(Window.partitionBy("q").orderBy("seen", F.desc("sim"), "w"))
        marked = state.withColumn("turn", rank)
        now = marked.where((~F.col("seen")) & (F.col("turn") <= opened)).select("q", F.col("w").alias("id"))
        reached = now.join(links, "id").select("q", F.explode("links").alias("w")).where("q <> w").distinct()
        new = reached.join(state.select("q", "w"), ["q", "w"], "left_anti")
        scored = _scored(new, own, index.vectors, index.width).withColumn("seen", F.lit(False))
        kept = marked.select("q", "w", "sim", (F.col("seen") | (F.col("turn") <= opened)).alias("seen"))
        state = staged(kept.union(scored).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam))
    top = state.where(F.col("rank") <= k)
    return top.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("w").alias("vec_id"), F.col("sim").alias("score"))
