"""Join each row to the versions that were valid at its time.

A join on the key alone lets a row meet all versions of its key. Here time is cut into
bins, a version lies in every bin it reaches into, and rows and versions meet by key and
bin; the interval is tested on what is left. The width of the bins comes from the data:

* Versions are cut at the latest start of any, as nothing changes after it; open ends then
  cost nothing, and rows of any later time share the last bin.
* The common width is the mean length of a version, so all versions together lie in at most
  three bins each on average.
* A key whose versions are much shorter than that has a width of its own, the mean of its
  own versions. These keys are a table of one row each, joined to both sides.

So a row meets about as many versions as are valid at the same time, and some beside them,
however many versions its key has. A join without a hint is left to Spark, which broadcasts
by measured size and splits a hot (key, bin) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key has bins of its own where its versions are so many times shorter than the mean.
SHORTER = 4
#: Bins of one version that are made at once; more are made in runs of so many.
RUN = 4096


def _number(c: Column, kind: T.DataType) -> Column:
    """A moment as a whole number."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return F.floor(c).cast("bigint")


class Bins:
    """Widths for the versions of `side`, a table (k, s, e, ...): key, start and end as whole numbers."""

    def __init__(self, side: DataFrame):
        last = side.agg(F.max("s")).scalar()
        length = F.greatest(F.least("e", last) - F.col("s"), F.lit(0)).cast("double")
        keys = side.groupBy("k").agg(F.min("s").alias("s"), F.max("s").alias("e"), F.sum(length).alias("total"), F.count("*").alias("n"))
        mean = F.greatest(F.floor(F.col("total") / F.col("n")), F.lit(1)).cast("bigint")
        self.begin, self.end, total, n, shortest = keys.agg(F.min("s"), F.max("e"), F.sum("total"), F.sum("n"), F.min(mean)).first()
        self.width = max(1, int(total / n)) if n else 1
        some = n and shortest * SHORTER < self.width
        self.own = keys.select(F.col("k").alias("k_own"), mean.alias("own")).where(F.col("own") * SHORTER < self.width) if some else None

    def of(self, at: Column, own: Column) -> Column:
        """The bin of a moment: counted from the first start, the last one without end."""
        if self.begin is None:
            return F.lit(0).cast("bigint")
        cut = F.least(at, F.lit(self.end))
        return F.floor((cut - self.begin) / F.coalesce(own, F.lit(self.width))).cast("bigint")

    def with_width(self, df: DataFrame) -> DataFrame:
        """Adds `own` for the key `k`; without a hint, as most tables have few such keys or none."""
        if self.own is None:
            return df.withColumn("own", F.lit(None).cast("bigint"))
        return df.join(self.own, F.col("k") == F.col("k_own"), "left").drop("k_own")

    def spread(self, side: DataFrame) -> DataFrame:
        """The versions in their bins, `b`: a row for each."""
        placed = self.with_width(side).withColumns({
            "low": self.of(F.col("s"), F.col("own")), "high": self.of(F.col("e") - 1, F.col("own"))})
        runs = placed.withColumn("run", F.explode(F.sequence("low", "high", F.lit(RUN).cast("bigint"))))
        stop = F.least(F.col("run") + (RUN - 1), F.col("high"))
        return runs.withColumn("b", F.explode(F.sequence("run", stop))).drop("run", "low", "high", "own")


def candidates(rows: DataFrame, versions: DataFrame, key: str, at: str, start: str, end: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with key `k` and bin `b`: rows as (k, t, b, row), versions as (k, s, e, b, version)."""
    kinds = {name: df.schema[name].dataType for df, name in ((rows, at), (versions, start), (versions, end))}
    side = versions.select(F.col(key).alias("k"), _number(F.col(start), kinds[start]).alias("s"), _number(F.col(end), kinds[end]).alias("e"),
                           F.struct(*columns).alias("version")).where("k is not null and s < e")
    bins = Bins(side)
    points = rows.select(F.struct("*").alias("row"), F.col(key).alias("k"), _number(F.col(at), kinds[at]).alias("t"))
    placed = bins.with_width(points).withColumn("b", bins.of(F.col("t"), F.col("own"))).drop("own")
    return placed, bins.spread(side)


def point_in_time_join(
    rows: DataFrame, versions: DataFrame, key: str, at: str, start: str, end: str, columns: list[str],
) -> DataFrame:
    """Left join on `key` and `start <= at < end`: a row for every version that is valid.

    `columns` of the version follow those of the row. Times are timestamps, dates or whole
    numbers. A row with a null key or time stays without a version; a version with a null
    key, start or end, or without length, is never valid; repeated rows and versions count
    as they come; other columns of either side may have any names.
    """
    left, right = candidates(rows, versions, key, at, start, end, columns)
    valid = (F.col("l.k") == F.col("r.k")) & (F.col("l.b") == F.col("r.b")) & (F.col("l.t") >= F.col("r.s")) & (F.col("l.t") < F.col("r.e"))
    joined = left.alias("l").join(right.alias("r"), valid, "left")
    return joined.select(*[F.col("l.row").getField(c).alias(c) for c in rows.columns],
                         *[F.col("r.version").getField(c).alias(c) for c in columns])
