"""Neighbours and running totals per key, without one task per key.

A window over a whole key would give a hot key to a single task. Rows are cut at
calendar borders instead: windows run per (key, period), and only the first and
last row of each period take part in a second window that carries state across the
borders. A key has at most two such rows per period of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _period(at: str, unit: str) -> Column:
    return F.date_trunc(unit, F.col(at))


def _neighbour(df: DataFrame, key: str, at: str, value: str, out: str, unit: str, forward: bool) -> DataFrame:
    # The columns of the rows travel in a struct, so they may have any names.
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("k"), F.col(at).alias("at"), F.col(value).alias("value"))
    order = F.col("at").asc() if forward else F.col("at").desc()
    inner = Window.partitionBy("k", "period").orderBy(order)
    walked = (
        rows.withColumn("period", _period("at", unit))
        .withColumn("near", F.lag("value").over(inner))
        .withColumn("first", F.row_number().over(inner) == 1)
        .withColumn("last", F.lead(F.lit(True)).over(inner).isNull())
    )
    border = F.col("first") | F.col("last")
    # Among border rows, the one before a period's first row ends an earlier period.
    across = F.lag("value").over(Window.partitionBy("k").orderBy(order))
    borders = walked.filter(border).withColumn("far", across)
    found = F.when(F.col("first"), F.col("far")).otherwise(F.col("near"))
    inside = walked.filter(~border).select("row", F.col("near").alias("found"))
    both = inside.unionByName(borders.select("row", found.alias("found")))
    return both.select(*[F.col("row").getField(c).alias(c) for c in df.columns], F.col("found").alias(out))


def with_previous(df: DataFrame, key: str, at: str, value: str, out: str, unit: str = "month") -> DataFrame:
    """`value` of the row before, per key by `at`; `at` is unique within a key."""
    return _neighbour(df, key, at, value, out, unit, True)


def with_next(df: DataFrame, key: str, at: str, value: str, out: str, unit: str = "month") -> DataFrame:
    """`value` of the row after, per key by `at`; `at` is unique within a key."""
    return _neighbour(df, key, at, value, out, unit, False)


def overlap_pairs(df: DataFrame, key: str, start: str, end: str, unit: str = "month") -> DataFrame:
    """Per key, the number of pairs with `a.start < b.end` and `b.start < a.end`.

    Starts and ends are swept in time order. A start adds one pair for each
    interval open at that moment, so no pair is ever formed. An empty or negative
    interval overlaps just the proper ones that begin before its end and end after
    its start; two such intervals never overlap. They are faults and so few: equal
    ones are counted together and looked up by key.
    """
    proper = df.filter(F.col(start) < F.col(end))
    faulty = (df.filter(F.col(start) >= F.col(end)).groupBy(key, F.col(start).alias("_s"), F.col(end).alias("_e"))
              .agg(F.count("*").alias("_n")).withColumnRenamed(key, "_k"))
    around = proper.join(faulty, (F.col(key) == F.col("_k")) & (F.col(start) < F.col("_e")) & (F.col(end) > F.col("_s")))
    of_faulty = around.groupBy(key).agg(F.sum("_n").alias("pairs"))
    sides = F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("opens"), F.lit(0).alias("closes")),
        F.struct(F.col(end).alias("at"), F.lit(0).alias("opens"), F.lit(1).alias("closes")),
    ))
    moments = (
        proper.select(key, sides.alias("s"))
        .groupBy(key, F.col("s.at").alias("at"))
        .agg(F.sum("s.opens").alias("opens"), F.sum("s.closes").alias("closes"))
        .withColumn("_period", _period("at", unit))
    )
    earlier = Window.partitionBy(key, "_period").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.coalesce(F.sum(F.col("opens") - F.col("closes")).over(earlier), F.lit(0)) - F.col("closes")
    swept = moments.withColumn("_open", open_before)
    among_new = F.expr("opens * (opens - 1) div 2")
    periods = swept.groupBy(key, "_period").agg(
        F.sum("opens").alias("opens"),
        F.sum(F.col("opens") - F.col("closes")).alias("net"),
        F.sum(F.col("opens") * F.col("_open") + among_new).alias("pairs"),
    )
    before = Window.partitionBy(key).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("net").over(before), F.lit(0))
    counted = periods.select(key, (F.col("pairs") + F.col("opens") * carried).alias("pairs"))
    every = df.select(key, F.lit(0).cast("bigint").alias("pairs")).distinct()
    return (
        counted.unionByName(of_faulty).unionByName(every)
        .groupBy(key).agg(F.sum("pairs").cast("bigint").alias("overlapping_pairs"))
    )
