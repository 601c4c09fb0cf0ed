"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import configure, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes that separate words wherever a contract says `[^\x20\x09-\x0D]+`.
SPACES = b" \t\n\x0b\x0c\r"


def col(name: str) -> Column:
    """The column of that very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: Arrow batches of few rows and few bytes, as texts may be long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_WORKSPACE: ContextVar[str | None] = ContextVar("workspace", default=None)


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, beyond_workspace: bool = False) -> DataFrame:
    """Written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{(not beyond_workspace and _WORKSPACE.get()) or _folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables staged within go to a folder that is deleted at the end; what is made of them must be written by then."""
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    before = _WORKSPACE.set(path)
    try:
        yield
    finally:
        _WORKSPACE.reset(before)
        drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """For small iteration state: a checkpoint in the shared folder, removed by Spark when unused."""
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():  # the setting may have come after the context
        context.setCheckpointDir(folder)
    return df.checkpoint()


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(divisor)


def sample_share(per_class: dict, bound: int) -> dict:
    """Share of each class to learn from, so that about `bound` rows of it are used."""
    return {k: min(1.0, bound / n) for k, n in per_class.items() if n}


def hash_share(c: Column) -> Column:
    """A number in [0, 1) that depends on the value alone: the same rows on every run."""
    return F.pmod(F.xxhash64(c), F.lit(1 << 20)) / F.lit(float(1 << 20))


def text_slices(texts: Sequence[str | None], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together hold about `most` characters, one row at least."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= most:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def text_column(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(name).to_pylist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges [start, start + length) one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)
