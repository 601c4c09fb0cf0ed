"""Keep one row per key, or the first rows of a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order.

    The rank filter lets Spark cut every map task's rows to one per key before
    the shuffle, so a key that holds most of the table sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top(df: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    """Leading rows of the whole table; all rows when no limit is set."""
    return df if limit is None else df.orderBy(*order).limit(limit)
