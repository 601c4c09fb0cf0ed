"""Vectors out of Arrow columns, shared by the two embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col


def dimension(embeddings: DataFrame, vector: str) -> int:
    """The most frequent length (of equals the smallest); vectors of another length take no part."""
    lengths = embeddings.select(F.size(col(vector)).alias("n")).where("n > 0").groupBy("n").count()
    first = lengths.orderBy(F.desc("count"), "n").first()
    return first.n if first else 0


def parse(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Doubles, rows x dim, and which rows take part: right length, all components finite, not all zero."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    flat = np.asarray(pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    usable = lengths == dim
    out = np.zeros((len(lengths), dim))
    begins = (np.cumsum(lengths) - lengths)[usable]
    out[usable] = flat[begins[:, None] + np.arange(dim)] if dim else 0
    usable &= np.isfinite(out).all(axis=1) & out.any(axis=1)
    return np.where(usable[:, None], out, 0.0), usable


def unit(rows: np.ndarray) -> np.ndarray:
    """Unit length in double precision; scaled first, so that huge or tiny components do no harm."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True, initial=0), 1e-300)
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows / np.where(lengths > 0, lengths, 1)


def packed(rows: np.ndarray, kind: str = "<f8") -> pa.Array:
    """One binary value per row."""
    return pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str = "<f8") -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1) if values else np.zeros((0, 0), dtype=kind)
