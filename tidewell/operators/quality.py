"""Quality gates: `(check_name, violations)`; a gate passes at zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import overlap_pairs


def _check(name: str, df: DataFrame, violations: Column) -> DataFrame:
    total = F.coalesce(violations, F.lit(0)).cast("bigint")
    return df.agg(total.alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def duplicates(name: str, df: DataFrame, key: str) -> DataFrame:
    return _check(name, duplicate_rows(df, key), F.count("*"))


def _listed(df: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts as a row per check."""
    pairs = [F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("violations")) for n in names]
    return df.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")


def fact_checks(fact: DataFrame, dates: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated bookings, missing keys, unknown dates and impossible measures, in one pass over the fact.

    Faults are counted per booking, so that the same shuffle finds the repeated ones.
    """
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    broken = ((F.col("final_amount") < 0) | (F.col("discount_amount") < 0)
              | ~F.col("rating").between(1, 5) | (F.col("service_duration_minutes") < 0))
    known = dates.select(F.col("date_key").alias("_date_key")).distinct()
    per_booking = fact.join(known, F.col("booking_date_key") == F.col("_date_key"), "left").groupBy("booking_id").agg(
        F.count("*").alias("times"), F.count_if(missing).alias("missing_dimension_keys"),
        F.count_if(F.col("_date_key").isNull()).alias("invalid_date_keys"), F.count_if(broken).alias("invalid_measures"))
    names = ["missing_dimension_keys", "invalid_date_keys", "invalid_measures"]
    counted = per_booking.agg(F.count_if(F.col("times") > 1).alias("duplicate_fact_bookings"), *[F.sum(n).alias(n) for n in names])
    return _listed(counted, ["duplicate_fact_bookings", *names])


def current_version_counts(dim: DataFrame) -> DataFrame:
    """Providers without exactly one current version."""
    return (dim.groupBy("provider_id").agg(F.count_if("is_current").alias("current_version_count"))
            .filter("current_version_count <> 1"))


def version_checks(dim: DataFrame) -> DataFrame:
    """Providers without exactly one current version, and intervals without length, in one pass."""
    empty = F.col("effective_start_at") >= F.col("effective_end_at")
    per_provider = dim.groupBy("provider_id").agg(F.count_if("is_current").alias("current"), F.count_if(empty).alias("empty"))
    counted = per_provider.agg(F.count_if(F.col("current") != 1).alias("current_version_count"), F.sum("empty").alias("invalid_intervals"))
    return _listed(counted, ["current_version_count", "invalid_intervals"])


def overlapping_intervals(dim: DataFrame) -> DataFrame:
    pairs = overlap_pairs(dim, "provider_id", "effective_start_at", "effective_end_at")
    return _check("overlapping_intervals", pairs, F.sum("overlapping_pairs"))


def expected_counts(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Stable-state check: objects whose `row_count` is not the expected one."""
    rows = [(name, n) for name, n in expected.items()]
    wanted = counts.sparkSession.createDataFrame(rows, "object_name string, expected_count bigint")
    joined = wanted.join(counts, "object_name", "left")
    return joined.filter(~F.col("row_count").eqNullSafe(F.col("expected_count"))).select(
        "object_name", "expected_count", "row_count")


def manifest_gaps(manifest: DataFrame, loads: DataFrame) -> DataFrame:
    """Files whose loaded rows differ from the record count their manifest states.

    `manifest` has one row with `files`, an array of (path, physical_records);
    `loads` has one row per source file. Paths match on their trailing part.
    """
    listed = manifest.select(F.explode("files").alias("f")).select(
        F.col("f.path").alias("path"), F.col("f.physical_records").cast("bigint").alias("physical_records"),
        F.element_at(F.split("f.path", "/"), -1).alias("_name"))
    found = loads.withColumn("_name", F.element_at(F.split("source_filename", "/"), -1))
    joined = listed.join(found, "_name", "left").filter(
        F.col("source_filename").isNull() | F.col("source_filename").endswith(F.col("path")))
    return joined.filter(~F.col("row_count").eqNullSafe(F.col("physical_records"))).select(
        "path", "physical_records", "row_count")


def run_gates(bookings: DataFrame, fact: DataFrame, dates: DataFrame, providers: DataFrame) -> DataFrame:
    return stack([
        duplicates("duplicate_latest_bookings", bookings, "booking_id"),
        fact_checks(fact, dates, ["booking_date_key", "customer_key", "provider_key", "service_key"]),
        version_checks(providers),
        overlapping_intervals(providers),
    ])
