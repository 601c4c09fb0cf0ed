"""Field lists of the four source records and the raw envelope around them.

All fields are read as text in one parse; `operators.clean` gives them types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names of the source records.
BOOKING_FIELDS = [
    "booking_id", "customer_id", "provider_id", "service_id", "booking_city",
    "booking_created_at", "scheduled_at", "service_started_at",
    "service_completed_at", "booking_status", "gross_amount", "discount_amount",
    "tax_amount", "final_amount", "payment_method", "rating", "review_text",
    "record_updated_at",
]
PROVIDER_FIELDS = [
    "provider_id", "provider_name", "primary_city", "operating_zone",
    "provider_tier", "experience_level", "active_status",
    "primary_service_category", "effective_at", "record_updated_at",
]
CUSTOMER_FIELDS = [
    "customer_id", "customer_name", "customer_segment", "home_city",
    "signup_date", "is_active",
]
SERVICE_FIELDS = [
    "service_id", "service_name", "service_category", "standard_price",
    "expected_duration_minutes", "skill_level_required", "is_active",
]

# Accepted states.
BOOKING_STATUSES = ["BOOKED", "ASSIGNED", "IN_PROGRESS", "COMPLETED", "CANCELLED"]
PROVIDER_TIERS = ["STANDARD", "PREMIUM"]
PROVIDER_STATUSES = ["ACTIVE", "INACTIVE"]

RAW_SCHEMA = "payload string, source_filename string, source_row_number bigint, ingested_at timestamp"
RAW_COLUMNS = ["payload", "source_filename", "source_row_number", "ingested_at"]


def is_malformed(payload: Column) -> Column:
    """Whether a line is anything but exactly one JSON value.

    Spark's parser stops after the first value and would let `{"a": 1} rubbish`
    pass, so the line is parsed inside a wrapper whose end must be reached. The end
    is named by the line's own hash, which no line can hold, and the wrapper must
    have just its two keys and one element, so a line cannot close it by itself.
    """
    end = F.sha2(payload.cast("binary"), 256)
    wrapped = F.try_parse_json(F.concat(F.lit('{"line": ['), payload, F.lit('], "'), end, F.lit('": 1}')))

    def is_one_value(v: Column) -> Column:
        keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
        return ((F.size(keys) == 2) & F.array_contains(keys, end)
                & (F.size(F.try_variant_get(v, "$.line", "array<variant>")) == 1))

    # Bound to a lambda variable, the parse runs once for all three look-ups.
    one_value = F.get(F.transform(F.array(wrapped), is_one_value), F.lit(0))
    return ~F.coalesce(one_value, F.lit(False))


def open_payload(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Parse each payload once into text columns, beside the envelope columns.

    A missing field and a JSON null both come out as SQL null. The generator form
    is one parse per record; a struct parse would be repeated wherever Spark
    inlines one of its fields into a later filter or projection.
    """
    return raw.select(
        F.json_tuple("payload", *fields).alias(*fields), "source_filename", "source_row_number", "ingested_at"
    )
