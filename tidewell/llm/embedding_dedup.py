r"""Near copies among embeddings: spherical k-means cells, blocked cosines within cells.

1. Spherical k-means: centres start from the vectors of smallest id hash; each of
   `rounds` passes over all vectors adds unit vectors per cell inside the tasks, one row
   per cell and task is summed, and the unit sums are the next centres. There are about
   `cell` vectors per centre, at most `MOST_CELLS` centres (a bounded broadcast).
2. A vector belongs to its nearest centre's cell and is a guest of others near whose
   border it lies. Two vectors at an angle of at most t on two sides of a border: one of
   them is within t / 2 of it, so it is a guest of all cells whose border with its own
   is that near. There is no fixed number of them, and no link is missed, whatever the
   dimension. A finite `z` makes guests fewer where that is not asked for: only those
   within z deviations of where a partner in a random direction lies (u > h / tan(t) at
   distance h of the border, u normal with deviation 1 / sqrt(dim - 1)).
3. Members and guests of a cell are cut into blocks of about `BLOCK` and `GUESTS` rows by
   a hash of the id; each pair of blocks (member-member, member-guest) is one task, so a
   cell that holds a third of all rows is spread over many. Cosines in single precision,
   whose error is bounded, rule out most pairs of a tile; what they leave is decided in double
   precision. A task adds up links per vector and reduces them to one edge per vector; pairs
   are never emitted. As `n_links` is exact, a cell's comparisons grow with the square of its
   members, in blocks. Rows travel without the list of their cells; members carry it as bits.
4. Components of the edges; the smallest id of each is kept.

Cosines are in double precision. Defined cases: a vector that is null, zero, of another
length than most, or holds null or non-finite components links with nothing, nor does
one with a null id (it is kept, its component null); rows that share an id are vectors
of one node, linked to others each on its own, never to one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, staged
from tidewell.llm.graph import components
from tidewell.llm.vectors import dimension, packed, parse, unit, unpacked

MOST_CELLS, BLOCK, GUESTS, TILE = 2048, 2000, 4000, 256
_SCALE = float(1 << 24)


def centres(vectors: DataFrame, dim: int, k: int, rounds: int) -> np.ndarray:
    """k unit vectors; `vectors` has id, vector."""

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ok = parse(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), packed(unit(rows[ok]))], names=["id", "unit"])

    first = (vectors.mapInArrow(usable, f"id {vectors.schema['id'].dataType.simpleString()}, unit binary")
             .orderBy(F.xxhash64("id"), "id", "unit").limit(k).select("unit").collect())
    c = np.array([np.frombuffer(r.unit) for r in first]).reshape(len(first), dim)
    for _ in range(rounds if len(c) > 1 else 0):
        now = c

        def add(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(now.shape, dtype=np.int64)  # whole numbers: the same sums in any order
            for batch in batches:
                rows, ok = parse(batch.column(1), dim)
                rows = unit(rows[ok])
                np.add.at(sums, (rows @ now.T).argmax(axis=1), np.rint(rows * _SCALE).astype(np.int64))
            met = np.flatnonzero(sums.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), packed(sums[met], "<i8")], names=["cell", "sums"])

        def total(parts: pa.Table) -> pa.Table:
            s = unpacked(parts.column("sums"), "<i8").sum(axis=0, keepdims=True)
            return pa.table({"cell": parts.column("cell").slice(0, 1), "sums": packed(s, "<i8")})

        summed = vectors.mapInArrow(add, "cell int, sums binary").groupBy("cell").applyInArrow(total, "cell int, sums binary").collect()
        c = now.copy()
        for r in summed:
            c[r.cell] = np.frombuffer(r.sums, dtype="<i8") / _SCALE
        c = unit(c)
    return c


def reach(threshold: float, dim: int, z: float) -> float:
    """How far from a cell's border a vector may be for its partners beyond it to be compared: the sine of half the angle."""
    angle = math.acos(max(-1.0, min(1.0, threshold)))
    likely = math.tan(angle) * z / math.sqrt(max(1, dim - 1)) if angle < math.pi / 2 and z < math.inf else math.inf
    return min(math.sin(angle / 2), likely) + 1e-9


def cells_of(rows: np.ndarray, c: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell, and a matrix of the cells each row belongs to, home included."""
    sims = rows @ c.T
    home = sims.argmax(axis=1)
    gap = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)) + 1e-13)[home]  # not below the true one
    return home, sims[np.arange(len(rows)), home][:, None] - sims <= near * gap + 1e-12


def close(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of rows of unit length whose cosine is at least `threshold`, a tile of the left ones at a time."""
    low, slack = right.astype(np.float32), 1e-5 + left.shape[1] * 2.0 ** -22  # above the error of single precision
    for begin in range(0, len(left), TILE):
        tile = left[begin:begin + TILE]
        near = tile.astype(np.float32) @ low.T >= np.float32(threshold - slack)
        if near.any():
            x, y = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            a, b = np.nonzero(tile[x] @ right[y].T >= threshold)
            yield (begin + x[a]).astype(np.int32), y[b].astype(np.int32)


def _least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest of the numbers below n that each one reaches by the links (a, b)."""
    label = np.arange(n, dtype=np.int32)
    while True:
        low, least = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def near_copies(embeddings: DataFrame, threshold: float = 0.9, id: str = "vec_id", vector: str = "embedding",
                cell: int = 1000, rounds: int = 4, z: float = math.inf) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    vectors = embeddings.select(col(id).alias("id"), col(vector).alias("vector"))
    dim, n = dimension(embeddings, vector), embeddings.count()
    known = vectors.where("id is not null")
    c = centres(known, dim, max(1, min(MOST_CELLS, n // cell)), rounds) if dim else np.zeros((0, 0))
    if not len(c):
        return vectors.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                              F.lit(True).alias("kept"))
    near, kind = reach(threshold, dim, z), vectors.schema["id"].dataType.simpleString()
    # Vectors travel as they are stored and become doubles of unit length where they are compared.
    width = "<f4" if vectors.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, all_rows = np.zeros((2, len(c)), dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                rows, ok = parse(batch.slice(begin, 4096).column(1), dim)
                home, belongs = cells_of(unit(rows[ok]), c, near)
                members += np.bincount(home, minlength=len(c))
                all_rows += belongs.sum(axis=0)
        met = np.flatnonzero(all_rows)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(members[met]), pa.array((all_rows - members)[met])],
                                         names=["cell", "members", "guests"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                rows, ok = parse(part.column(1), dim)
                rows = rows[ok]
                if not len(rows):
                    continue
                home, belongs = cells_of(unit(rows), c, near)
                ends = np.concatenate([[0], np.cumsum(belongs.sum(axis=1))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(belongs)[1], pa.int32()))
                bits = packed(np.packbits(belongs, axis=1, bitorder="little"), "u1")
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), packed(rows, width), pa.array(home, pa.int32()), lists, bits],
                                                 names=["id", "x", "home", "cells", "bits"])

    # How many members and guests each cell has: as many rows as there are cells.
    counts = known.mapInArrow(tally, "cell int, members bigint, guests bigint").groupBy("cell").agg(
        F.sum("members").alias("members"), F.sum("guests").alias("guests")).collect()
    placed = known.mapInArrow(place, f"id {kind}, x binary, home int, cells array<int>, bits binary")
    blocks = {r.cell: (max(1, -(-r.members // BLOCK)), -(-r.guests // GUESTS)) for r in counts}
    per_cell = F.array(*[F.struct(F.lit(m).alias("members"), F.lit(g).alias("guests"))
                         for m, g in (blocks.get(i, (1, 0)) for i in range(len(c)))])

    rows = placed.select("id", "x", "home", "bits", F.xxhash64("id").alias("h"), F.explode("cells").alias("cell"))
    rows = rows.withColumn("cut", F.element_at(per_cell, F.col("cell") + 1)).withColumn("member", F.col("home") == F.col("cell"))
    own = F.pmod("h", F.when(F.col("member"), F.col("cut.members")).otherwise(F.greatest(F.lit(1), F.col("cut.guests")))).cast("int")
    members, guests = F.sequence(F.lit(0), F.col("cut.members") - 1), F.col("cut.guests")
    # (first block, second block): members i <= j as (i, j), members i with guests j as (i, -1 - j).
    with_members = F.transform(members, lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    with_guests = F.when(guests > 0, F.transform(F.sequence(F.lit(0), guests - 1), lambda j: F.struct(F.col("own").alias("i"), (-1 - j).alias("j"))))
    as_guest = F.transform(members, lambda i: F.struct(i.alias("i"), (-1 - F.col("own")).alias("j")))
    pairs = F.when(F.col("member"), F.concat(with_members, F.coalesce(with_guests, F.array().cast("array<struct<i:int,j:int>>")))).otherwise(as_guest)
    rows = rows.withColumn("own", own).withColumn("bits", F.when(F.col("member"), F.col("bits")))
    dealt = rows.select("id", "x", "home", "bits", "cell", "member", "own", F.explode(pairs).alias("p"))
    dealt = dealt.select("id", "x", "home", "bits", "cell", "member", "own", "p.i", "p.j")

    def compare(group: pa.Table) -> pa.Table:
        i, j, cell = group.column("i")[0].as_py(), group.column("j")[0].as_py(), group.column("cell")[0].as_py()
        member, own = np.asarray(group.column("member")), np.asarray(group.column("own"))
        left = np.flatnonzero(member & (own == i))
        right = left if i == j else np.flatnonzero((member & (own == j)) if j >= 0 else ~member)
        rows = unit(unpacked(group.column("x"), width).astype(np.float64))
        ids = np.asarray(group.column("id").combine_chunks().dictionary_encode().indices)
        home = np.asarray(group.column("home"))
        bits = unpacked(group.column("bits").take(pa.array(left)), "u1") if j < 0 else None
        found = [np.zeros((2, 0), dtype=np.int32)]
        for x, y in close(rows[left], rows[right], threshold):
            a, b = left[x], right[y]
            keep = ids[a] != ids[b]
            if j < 0:  # a pair that each other's cell would see counts in the cell of smaller number
                keep &= ~((home[b] < cell) & (bits[x, home[b] >> 3] >> (home[b] & 7) & 1).astype(bool))
            found.append(np.array([a[keep], b[keep]], dtype=np.int32))
        a, b = np.concatenate(found, axis=1)
        links = np.bincount(a, minlength=len(ids)) + (0 if i == j else np.bincount(b, minlength=len(ids)))
        met = np.flatnonzero(links)
        root = _least_reached(len(ids), a, b)[met]
        names = group.column("id")
        return pa.table({"id": names.take(pa.array(met)), "links": pa.array(links[met], pa.int64()), "root": names.take(pa.array(root))})

    found = staged(dealt.groupBy("cell", "i", "j").applyInArrow(compare, f"id {kind}, links bigint, root {kind}"))
    summed = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found, "id", "root")
    joined = (vectors.select("id").join(summed, "id", "left").join(reached.withColumnRenamed("node", "id"), "id", "left"))
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
