r"""Vector compression: each vector becomes one code per part, by codebooks learned in whole numbers.

A vector's components become `floor(256 * x)` and are cut into `PARTS` equal parts. Each part
position has a codebook of `ENTRIES` entries, refined by rounds of nearest entries and
componentwise floors of means.

Rows meet in blocks of `BLOCK` vectors, as tasks read them. For each block and part position
an anchors-hierarchy metric tree is built once (`anchor_trees`) and written to the shared folder; all
rounds read the trees. In a round a task walks its trees: balls owned by one entry add their cached
number and sum to it, only points of mixed leaves are looked at one by one. What a
task gives is the number and the sum for each entry, so what is shuffled per task and what reaches
the driver is `ENTRIES * (dim + PARTS)` numbers whatever the table; no key gathers rows. A lost
executor costs the blocks it held in work, not the trees.

Defined cases: vectors that are null or hold null or non-finite components give no row, nor do those with
a component too large for exact distances (beyond 2^19 at 64 components). One length is taken, the most frequent one that the number
of parts divides (of equals the smallest); vectors of another length give no row. A row with a null id starts
no entry, but is encoded; rows that share an id are encoded each. Fewer rows than entries: as many entries
as rows. An empty table gives an empty result. A total that does not fit a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.anchor_trees import Trees, build, nearest
from tidewell.llm.common import col, staged
from tidewell.llm.whole_vectors import floor_mean, starting, usable, whole

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Vectors whose parts share a tree.
BLOCK = 4096


@dataclass(frozen=True)
class Codebooks:
    """`entries`: part position x entry x component, whole numbers."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class Forest:
    """The blocks with their trees, as a written table: ids, labels, n, trees."""

    blocks: DataFrame
    rows: DataFrame
    dim: int
    parts: int
    names: tuple[str, ...]


def _dimension(embeddings: DataFrame, vector: str, parts: int) -> int:
    lengths = embeddings.select(F.size(col(vector)).alias("n")).where((F.col("n") > 0) & (F.col("n") % parts == 0)).groupBy("n").count()
    first = lengths.orderBy(F.desc("count"), "n").first()
    return first.n if first else 0


def plant(embeddings: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS) -> Forest:
    """Blocks of vectors and a tree for each block and part position."""
    dim = _dimension(embeddings, vector, parts)
    chosen = [col(id).alias("id"), (col(label) if label else F.lit(None).cast("int")).alias("label"), col(vector).alias("vector")]
    rows = embeddings.where(usable(vector, dim) if dim else F.lit(False)).select(*chosen)

    def grown(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels, vectors = (c.chunk(0) for c in table.columns)
        x = whole(vectors, dim).reshape(len(ids), parts, dim // parts).transpose(1, 0, 2)
        trees = build(np.ascontiguousarray(x).reshape(parts * len(ids), -1), [len(ids)] * parts)
        all_of = pa.array([0, len(ids)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(all_of, ids), pa.ListArray.from_arrays(all_of, labels), pa.array([trees.packed()], pa.list_(pa.binary()))],
            names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                batch, n = batch.slice(part.num_rows), n + part.num_rows
                held.append(part)
                if n == BLOCK:
                    yield grown(held)
                    held, n = [], 0
        if n:
            yield grown(held)

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    blocks = rows.mapInArrow(run, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees array<binary>")
    return Forest(staged(blocks), rows, dim, parts, (id, label) if label else (id,))


def _walked(batches: Iterator[pa.RecordBatch], books: np.ndarray):
    """The trees of each block with their nearest entries."""
    for batch in batches:
        for i in range(batch.num_rows):
            trees = Trees.unpacked(batch.column("trees")[i].as_py(), books.shape[2])
            yield batch, i, trees, nearest(trees, books)


def _totals(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """For each entry of all codebooks the number of its parts and their sums."""
    spaces, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((spaces * entries, width + 1), dtype=np.int64)
        for batch, _, trees, (codes, balls, owners, alone) in _walked(batches, books):
            space = np.searchsorted(trees.roots, balls)  # a space's nodes come before its root
            np.add.at(total, space * entries + owners, np.column_stack([trees.high[balls] - trees.low[balls], trees.sums[balls]]))
            at = np.flatnonzero(alone)
            slot = at // (len(codes) // spaces) * entries + codes[at]
            np.add.at(total, slot, np.column_stack([np.ones(len(at), dtype=np.int64), trees.points[at]]))
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "part"])

    summed = forest.blocks.select("trees").mapInArrow(run, "at int, part bigint").groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found = {r["at"]: int(r.total) for r in summed.collect()}  # as many numbers as the codebooks have, and one per entry
    flat = [found.get(i, 0) for i in range(spaces * entries * (width + 1))]
    table = [flat[i:i + width + 1] for i in range(0, len(flat), width + 1)]
    return np.array([r[0] for r in table]), [r[1:] for r in table]


def fit(forest: Forest, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks start as the parts of the rows of smallest id; entries without parts stay."""
    first = starting(forest.rows, entries, forest.dim, F.col("id"))
    books = np.ascontiguousarray(first.reshape(len(first), forest.parts, forest.dim // forest.parts).transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        sizes, sums = _totals(forest, books)
        flat = books.reshape(len(sizes), -1)
        books = np.array([[floor_mean(s, int(n)) for s in row] if n else old.tolist() for n, row, old in zip(sizes, sums, flat)],
                         dtype=np.int64).reshape(books.shape)
    return Codebooks(books)


def encode(forest: Forest, books: Codebooks) -> DataFrame:
    """(id, label, code, error) of every usable vector; code: two hex digits per part, error: squared distances over all parts."""
    entries, parts = books.entries, forest.parts
    digits = np.array([f"{i:02x}" for i in range(max(256, entries.shape[1]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not entries.size:
            return
        for batch, i, trees, (codes, *_) in _walked(batches, entries):
            n = len(codes) // parts
            space = np.arange(len(codes)) // n
            apart = trees.points - entries[space, codes]
            code, far = np.empty(len(codes), dtype=np.int64), np.empty(len(codes), dtype=np.int64)
            code[trees.origin], far[trees.origin] = codes, np.einsum("ij,ij->i", apart, apart)
            text = ["".join(row) for row in digits[code.reshape(parts, n).T].tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(text, pa.string()), pa.array(far.reshape(parts, n).sum(axis=0))],
                names=["id", "label", "code", "error"])

    kinds = [forest.rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    out = forest.blocks.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error bigint")
    return out.withColumnsRenamed(dict(zip(("id", "label"), forest.names))) if len(forest.names) == 2 else out.drop("label").withColumnRenamed("id", forest.names[0])


def decode(encoded: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """Adds `decoded`: the entries that the code names, as numbers of the vectors' own scale."""
    flat = F.lit(books.entries.reshape(-1, books.entries.shape[-1]).tolist() if books.entries.size else []).cast("array<array<bigint>>")
    size = books.entries.shape[1] if books.entries.size else 0
    at = lambda p: F.conv(F.substring(col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int") + p * size
    parts = F.transform(F.sequence(F.lit(0), F.lit(len(books.entries) - 1)), lambda p: F.get(flat, at(p)))
    return encoded.withColumn("decoded", F.transform(F.flatten(parts), lambda x: x / 256.0))


def digests(encoded: DataFrame, books: Codebooks, id: str = "vec_id", label: str = "label") -> DataFrame:
    """With the errors summed over equal labels (nulls together). Labels are summed in part by each
    task, and the join is left to Spark, which splits a label that holds very many rows."""
    once = staged(encoded)
    sums = once.groupBy(col(label).alias("_label")).agg(F.try_sum("error").alias("label_error"))
    joined = once.join(sums, col(label).eqNullSafe(F.col("_label")))
    return joined.select(col(id), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
