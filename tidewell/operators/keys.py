"""Surrogate keys: unique, stable, never given twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session deals its shuffles into, a thousand at least."""
    return max(1024, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def highest_key(existing: DataFrame | None, key_col: str) -> Column:
    if existing is None:
        return F.lit(0).cast("bigint")
    return F.coalesce(existing.agg(F.max(key_col)).scalar(), F.lit(0).cast("bigint"))


def assign_keys(
    new_rows: DataFrame, ids: list[str], key_col: str, existing: DataFrame | None = None, buckets: int | None = None
) -> DataFrame:
    """Number rows (unique in `ids`) onwards from the highest existing key.

    Rows are numbered inside hash buckets, and the keys of a bucket are those that
    leave its number as remainder, so no two buckets can meet. One shuffle, no task
    sorts the whole table, and the keys depend only on the data, so a task that is
    run again gives the same ones. Keys have gaps.
    """
    buckets = buckets or bucket_count(new_rows)
    tagged = new_rows.withColumn("_bucket", F.pmod(F.xxhash64(*ids), F.lit(buckets)))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*ids))
    offset = (within - 1).cast("bigint") * buckets + F.col("_bucket") + 1
    return tagged.withColumn(key_col, (highest_key(existing, key_col) + offset).cast("bigint")).select(
        key_col, *[c for c in new_rows.columns])
