"""The booking marketplace as a metric model.

Names, synonyms and formulas are fixed values: users' questions refer to them.
"""

from __future__ import annotations

from tidewell.plans.semantic import Dimension, Entity, Metric, Model, Relationship

BOOKINGS, DATES, CUSTOMERS = "bookings", "dates", "customers"
PROVIDERS, SERVICES, REVIEWS = "providers", "services", "reviews"

ENTITIES = (
    Entity(BOOKINGS, "booking_id", ("appointments", "jobs", "orders")),
    Entity(DATES, "date_key"),
    Entity(CUSTOMERS, "customer_key"),
    Entity(PROVIDERS, "provider_key"),
    Entity(SERVICES, "service_key", ("offerings",)),
    Entity(REVIEWS, "booking_id"),
)

RELATIONSHIPS = (
    Relationship("bookings_to_dates", BOOKINGS, "booking_date_key", DATES),
    Relationship("bookings_to_customers", BOOKINGS, "customer_key", CUSTOMERS),
    Relationship("bookings_to_providers", BOOKINGS, "provider_key", PROVIDERS),
    Relationship("bookings_to_services", BOOKINGS, "service_key", SERVICES),
    Relationship("reviews_to_bookings", REVIEWS, "booking_id", BOOKINGS, optional_one=True),
)

ROW_FACTS = {
    BOOKINGS: {
        "gross_amount": "gross_amount",
        "discount_amount": "discount_amount",
        "final_amount": "final_amount",
        "rating": "rating",
        "service_duration_minutes": "service_duration_minutes",
        "completed_flag": "completed_booking_count",
        "cancelled_flag": "cancelled_booking_count",
    },
}

DIMENSIONS = (
    Dimension("booking_id", BOOKINGS, "booking_id"),
    Dimension("booking_city", BOOKINGS, "booking_city", ("city", "market")),
    Dimension("booking_status", BOOKINGS, "booking_status", ("status", "job status")),
    Dimension("payment_method", BOOKINGS, "payment_method", ("payment type",)),
    Dimension("booking_date", DATES, "full_date", ("date", "booking date")),
    Dimension("day_name", DATES, "day_name", ("weekday",)),
    Dimension("month_name", DATES, "month_name", ("month",)),
    Dimension("quarter", DATES, "quarter"),
    Dimension("year", DATES, "year"),
    Dimension("is_weekend", DATES, "is_weekend", ("weekend",)),
    Dimension("customer_segment", CUSTOMERS, "customer_segment", ("segment", "customer type")),
    Dimension("customer_home_city", CUSTOMERS, "home_city", ("home city",)),
    Dimension("provider_id", PROVIDERS, "provider_id", ("professional id", "partner id")),
    Dimension("provider_name", PROVIDERS, "provider_name", ("professional", "partner")),
    Dimension("provider_city", PROVIDERS, "primary_city", ("primary city",)),
    Dimension("operating_zone", PROVIDERS, "operating_zone", ("zone",)),
    Dimension("provider_tier", PROVIDERS, "provider_tier", ("tier", "provider level")),
    Dimension("experience_level", PROVIDERS, "experience_level", ("experience",)),
    Dimension("active_status", PROVIDERS, "active_status", ("provider status",)),
    Dimension("service_name", SERVICES, "service_name", ("service",)),
    Dimension("service_category", SERVICES, "service_category", ("category", "service type")),
    Dimension("skill_level_required", SERVICES, "skill_level_required", ("skill level",)),
    Dimension("sentiment", REVIEWS, "sentiment_label", ("customer mood",)),
    Dimension("complaint_theme", REVIEWS, "complaint_category", ("complaint", "issue", "review category")),
)

METRICS = (
    Metric("total_bookings", BOOKINGS, "count(booking_id)", "count"),
    Metric("completed_bookings", BOOKINGS, "sum(completed_flag)", "count"),
    Metric("cancelled_bookings", BOOKINGS, "sum(cancelled_flag)", "count"),
    Metric("completion_rate", BOOKINGS, "sum(completed_flag) / nullif(count(booking_id), 0)", "rate"),
    Metric("cancellation_rate", BOOKINGS, "sum(cancelled_flag) / nullif(count(booking_id), 0)", "rate"),
    Metric("gross_revenue", BOOKINGS, "sum(gross_amount)", "money", ("gross sales", "GMV")),
    Metric("net_revenue", BOOKINGS, "sum(final_amount)", "money", ("revenue", "sales", "earnings")),
    # Sum over count keeps twelve decimals, where avg of a money column keeps six.
    Metric("average_booking_value", BOOKINGS,
           "cast(sum(final_amount) as decimal(28,2)) / nullif(count(final_amount), 0)", "money",
           ("ABV", "average order value")),
    Metric("average_rating", BOOKINGS, "avg(rating)", "average"),
    Metric("average_service_duration", BOOKINGS, "avg(service_duration_minutes)", "average"),
    Metric("enriched_review_count", REVIEWS, "count(booking_id)", "count"),
    Metric("negative_review_count", REVIEWS, "count_if(sentiment_label = 'negative')", "count"),
)

MARKETPLACE = Model(ENTITIES, RELATIONSHIPS, DIMENSIONS, METRICS, ROW_FACTS)
