"""Raw records to typed, valid rows; booking snapshots to their latest state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import values as V
from tidewell.operators.latest import first_by
from tidewell.sources.records import (
    BOOKING_FIELDS,
    BOOKING_STATUSES,
    CUSTOMER_FIELDS,
    PROVIDER_FIELDS,
    PROVIDER_STATUSES,
    PROVIDER_TIERS,
    SERVICE_FIELDS,
    open_payload,
)

TRACKED_ATTRIBUTES = [
    "primary_city", "operating_zone", "provider_tier", "experience_level",
    "active_status", "primary_service_category",
]
PROVIDER_ATTRIBUTES = ["provider_name", *TRACKED_ATTRIBUTES]


def parse_bookings(raw: DataFrame) -> DataFrame:
    c = F.col
    return open_payload(raw, BOOKING_FIELDS).select(
        "booking_id", "customer_id", "provider_id", "service_id",
        V.title_trim(c("booking_city")).alias("booking_city"),
        *[V.to_time(c(n)).alias(n) for n in
          ("booking_created_at", "scheduled_at", "service_started_at", "service_completed_at")],
        V.upper_trim(c("booking_status")).alias("booking_status"),
        *[V.to_money(c(n)).alias(n) for n in
          ("gross_amount", "discount_amount", "tax_amount", "final_amount")],
        V.upper_trim(c("payment_method")).alias("payment_method"),
        V.to_whole(c("rating")).alias("rating"),
        V.blank_to_null(c("review_text")).alias("review_text"),
        V.to_time(c("record_updated_at")).alias("record_updated_at"),
        "source_filename", "source_row_number", "ingested_at",
    )


def booking_faults() -> Column:
    """Names of the rules a typed booking breaks; empty when it is valid."""
    c = F.col
    rules = {
        "booking_id missing": c("booking_id").isNull(),
        "customer_id missing": c("customer_id").isNull(),
        "provider_id missing": c("provider_id").isNull(),
        "service_id missing": c("service_id").isNull(),
        "booking_created_at unreadable": c("booking_created_at").isNull(),
        "booking_status unknown": ~F.coalesce(c("booking_status").isin(BOOKING_STATUSES), F.lit(False)),
        "final_amount unreadable or negative": F.coalesce(c("final_amount"), F.lit(-1)) < 0,
    }
    # Not `array_compact`, whose lambda Spark interprets, with all rules in it.
    return F.array_remove(F.array(*[F.when(broken, F.lit(name)).otherwise(F.lit("")) for name, broken in rules.items()]), F.lit(""))


def valid_bookings(typed: DataFrame) -> DataFrame:
    c = F.col
    return typed.filter(
        c("booking_id").isNotNull()
        & c("customer_id").isNotNull()
        & c("provider_id").isNotNull()
        & c("service_id").isNotNull()
        & c("booking_created_at").isNotNull()
        & c("booking_status").isin(BOOKING_STATUSES)
        & (c("final_amount") >= 0)
    )


def latest_bookings(valid: DataFrame) -> DataFrame:
    """Newest snapshot per booking; an unreadable update time never wins."""
    order = [F.col(n).desc_nulls_last() for n in
             ("record_updated_at", "ingested_at", "source_row_number", "source_filename")]
    return first_by(valid, ["booking_id"], order)


def clean_bookings(raw: DataFrame) -> DataFrame:
    """Filter first: an invalid newer snapshot must not hide a valid older one."""
    return latest_bookings(valid_bookings(parse_bookings(raw)))


def hashed_provider(df: DataFrame) -> DataFrame:
    return df.withColumn("attribute_hash", V.attribute_hash([F.col(n) for n in TRACKED_ATTRIBUTES]))


def parse_providers(raw: DataFrame) -> DataFrame:
    c = F.col
    typed = open_payload(raw, PROVIDER_FIELDS).select(
        "provider_id", "provider_name",
        V.title_trim(c("primary_city")).alias("primary_city"),
        V.title_trim(c("operating_zone")).alias("operating_zone"),
        V.upper_trim(c("provider_tier")).alias("provider_tier"),
        V.upper_trim(c("experience_level")).alias("experience_level"),
        V.upper_trim(c("active_status")).alias("active_status"),
        "primary_service_category",
        V.to_time(c("effective_at")).alias("effective_at"),
        V.to_time(c("record_updated_at")).alias("record_updated_at"),
        "source_filename", "source_row_number", "ingested_at",
    )
    return hashed_provider(typed)


def valid_providers(typed: DataFrame) -> DataFrame:
    return typed.filter(
        F.col("provider_id").isNotNull()
        & F.col("effective_at").isNotNull()
        & F.col("provider_tier").isin(PROVIDER_TIERS)
        & F.col("active_status").isin(PROVIDER_STATUSES)
    )


def applicable_changes(typed: DataFrame) -> DataFrame:
    """The weaker rule of the live path: tier and status are not checked."""
    return typed.filter(F.col("provider_id").isNotNull() & F.col("effective_at").isNotNull())


def clean_providers(raw: DataFrame) -> DataFrame:
    """One row per valid provider event; no deduplication."""
    return valid_providers(parse_providers(raw))


def _newest_record(key: str, df: DataFrame) -> DataFrame:
    order = [F.col(n).desc_nulls_last() for n in ("ingested_at", "source_row_number", "source_filename")]
    return first_by(df, [key], order)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Most recently ingested record per customer."""
    c = F.col
    typed = open_payload(raw, CUSTOMER_FIELDS).select(
        "customer_id", "customer_name",
        F.upper(c("customer_segment")).alias("customer_segment"),
        V.title_case(c("home_city")).alias("home_city"),
        V.to_day(c("signup_date")).alias("signup_date"),
        V.to_flag(c("is_active")).alias("is_active"),
        "source_filename", "source_row_number", "ingested_at",
    )
    return _newest_record("customer_id", typed).drop("source_filename", "source_row_number", "ingested_at")


def clean_services(raw: DataFrame) -> DataFrame:
    """Most recently ingested record per service."""
    c = F.col
    typed = open_payload(raw, SERVICE_FIELDS).select(
        "service_id", "service_name", "service_category",
        V.to_money(c("standard_price")).alias("standard_price"),
        V.to_whole(c("expected_duration_minutes")).alias("expected_duration_minutes"),
        F.upper(c("skill_level_required")).alias("skill_level_required"),
        V.to_flag(c("is_active")).alias("is_active"),
        "source_filename", "source_row_number", "ingested_at",
    )
    return _newest_record("service_id", typed).drop("source_filename", "source_row_number", "ingested_at")


def marked_missing(df: DataFrame, required: list[str]) -> DataFrame:
    """Adds `missing_columns`, the required columns that a row lacks."""
    return df.withColumn("missing_columns", F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in required])))


def split_not_null(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column, and the others with the columns they lack."""
    marked = marked_missing(df, required)
    return (
        marked.filter(F.size("missing_columns") == 0).drop("missing_columns"),
        marked.filter(F.size("missing_columns") > 0),
    )


def with_defaults(df: DataFrame, stamps: list[str], now: Column | None = None) -> DataFrame:
    """Fill audit columns that are absent or null with the run's time."""
    moment = F.current_timestamp() if now is None else now
    for name in stamps:
        df = df.withColumn(name, F.coalesce(F.col(name), moment) if name in df.columns else moment)
    return df
