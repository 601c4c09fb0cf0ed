"""Calendar and Type 1 dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.calendar import calendar_columns
from tidewell.operators.keys import assign_keys

# The default calendar, 1,096 days.
CALENDAR_START = "2025-01-01"
CALENDAR_END = "2028-01-01"

CUSTOMER_ATTRIBUTES = ["customer_name", "customer_segment", "home_city", "signup_date", "is_active"]
SERVICE_ATTRIBUTES = [
    "service_name", "service_category", "standard_price",
    "expected_duration_minutes", "skill_level_required", "is_active",
]
CUSTOMER_REQUIRED = ["customer_id", "customer_name", "customer_segment", "home_city", "is_active"]
SERVICE_REQUIRED = ["service_id", "service_name", "service_category", "standard_price",
                    "expected_duration_minutes", "skill_level_required", "is_active"]
PROVIDER_REQUIRED = ["provider_id", "provider_name", "primary_city", "operating_zone", "provider_tier",
                     "experience_level", "active_status", "primary_service_category", "effective_at"]


def _calendar(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    return days.select(*calendar_columns(F.col("full_date")))


def calendar_spanning(df: DataFrame, at: str) -> DataFrame:
    """Calendar rows from the earliest to the latest day of a column."""
    return _calendar(df.agg(F.min(F.to_date(at)).alias("first_day"), F.max(F.to_date(at)).alias("last_day")))


def calendar_of_years(df: DataFrame, at: str) -> DataFrame:
    """Calendar rows of all years that a column of days reaches into."""
    first, last = F.min(F.to_date(at)), F.max(F.to_date(at))
    return _calendar(df.agg(F.trunc(first, "year").alias("first_day"),
                            F.last_day(F.add_months(F.trunc(last, "year"), 11)).alias("last_day")))


def build_dim_date(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END, existing: DataFrame | None = None
) -> DataFrame:
    """Calendar rows of the range; with `existing`, that table plus the missing days."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day"))
    calendar = _calendar(bounds)
    if existing is None:
        return calendar
    return existing.unionByName(calendar.join(existing, "date_key", "left_anti"))


def scd1_merge(
    target: DataFrame | None, source: DataFrame, natural: str, attributes: list[str], key_col: str,
    now: Column | None = None,
) -> DataFrame:
    """Overwrite attributes of known rows, add unknown ones; keys never move."""
    moment = F.current_timestamp() if now is None else now
    incoming = source.select(natural, *attributes)
    if target is None:
        fresh = assign_keys(incoming, [natural], key_col)
        return fresh.withColumn("created_at", moment).withColumn("updated_at", moment)

    # One join for both. A null in the source overwrites too, so the side that is there decides, not the value.
    old = target.select(F.col(natural).alias("old_id"), F.struct(*target.columns).alias("old"))
    new = incoming.select(F.col(natural).alias("new_id"), F.struct(*incoming.columns).alias("new"))
    joined = old.join(new, F.col("old_id") == F.col("new_id"), "full_outer").withColumn("id", F.coalesce("old_id", "new_id"))
    # Keys are set aside for all rows of the batch; those of known rows are not used and leave gaps.
    keyed = assign_keys(joined, ["id"], "fresh_key", existing=target.select(F.col(key_col).alias("fresh_key")))
    known, hit = F.col("old").isNotNull(), F.col("new").isNotNull()
    return keyed.select(
        F.when(known, F.col("old").getField(key_col)).otherwise(F.col("fresh_key")).alias(key_col), F.col("id").alias(natural),
        *[F.when(hit, F.col("new").getField(n)).otherwise(F.col("old").getField(n)).alias(n) for n in attributes],
        F.when(known, F.col("old.created_at")).otherwise(moment).alias("created_at"),
        F.when(hit, moment).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )


def merge_customers(target: DataFrame | None, source: DataFrame, now: Column | None = None) -> DataFrame:
    return scd1_merge(target, source, "customer_id", CUSTOMER_ATTRIBUTES, "customer_key", now)


def merge_services(target: DataFrame | None, source: DataFrame, now: Column | None = None) -> DataFrame:
    return scd1_merge(target, source, "service_id", SERVICE_ATTRIBUTES, "service_key", now)
