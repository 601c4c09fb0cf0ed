"""Operating reports: counts per layer, health, coverage and known patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import values as V
from tidewell.operators.ordered import with_previous
from tidewell.operators.quality import stack
from tidewell.sources.json_lines import REJECTED


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and how many rows it has."""
    return stack([df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("object_name"), "row_count")
                  for name, df in tables.items()]).orderBy("object_name")


def distinct_payload_field(raw: DataFrame, field: str) -> DataFrame:
    value = F.get_json_object("payload", f"$.{field}")
    return raw.agg(F.count_distinct(value).alias("distinct_values"))


def layer_reconciliation(raw_bookings: DataFrame, bookings: DataFrame, fact: DataFrame, reviews: DataFrame) -> DataFrame:
    physical = raw_bookings.agg(
        F.count("*").alias("rows"), F.count_distinct(F.get_json_object("payload", "$.booking_id")).alias("ids"))
    pairs = F.explode(F.array(
        F.struct(F.lit("RAW_BOOKING_ROWS").alias("measure"), F.col("rows").alias("value")),
        F.struct(F.lit("RAW_DISTINCT_BOOKINGS").alias("measure"), F.col("ids").alias("value")),
    ))
    counted = {"LATEST_BOOKINGS": bookings, "FACT_BOOKINGS": fact, "ENRICHED_REVIEWS": reviews}
    return stack([
        physical.select(pairs.alias("p")).select("p.*"),
        *[df.agg(F.count("*").alias("value")).select(F.lit(name).alias("measure"), "value")
          for name, df in counted.items()],
    ])


def load_history(marked: DataFrame, hours: int | None = None) -> DataFrame:
    """Rows loaded and rejected per source file of a raw table, newest load first."""
    loads = marked.select("source_filename", "ingested_at", (F.col("load_status") == REJECTED).alias("bad"))
    if hours is not None:
        loads = loads.filter(F.col("ingested_at") >= F.current_timestamp() - F.make_dt_interval(hours=F.lit(hours)))
    report = loads.groupBy("source_filename").agg(
        F.count_if(~F.col("bad")).alias("row_count"),
        F.count_if("bad").alias("error_count"),
        F.max("ingested_at").alias("last_load_time"),
    )
    return report.withColumn("status", _load_status()).orderBy(F.desc("last_load_time"), "source_filename")


def ledger_history(ledger: DataFrame, hours: int | None = None) -> DataFrame:
    """The same report from the load ledger, which has one small row per file: no raw row is read."""
    loads = ledger if hours is None else ledger.filter(F.col("loaded_at") >= F.current_timestamp() - F.make_dt_interval(hours=F.lit(hours)))
    report = loads.groupBy("source_filename").agg(
        F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count"), F.max("loaded_at").alias("last_load_time"))
    return report.withColumn("status", _load_status()).orderBy(F.desc("last_load_time"), "source_filename")


def _load_status() -> Column:
    return (F.when(F.col("error_count") == 0, "LOADED").when(F.col("row_count") == 0, "LOAD_FAILED")
            .otherwise("PARTIALLY_LOADED"))


def _health(fact: DataFrame):
    total = F.count("*")
    return {
        "total": total,
        "completed": F.sum("completed_booking_count"),
        "cancelled": F.sum("cancelled_booking_count"),
        "revenue": F.round(F.sum("final_amount"), 2),
        "rating": F.round(F.avg("rating"), 2),
        "completion": V.rate(F.sum("completed_booking_count"), total),
        "cancellation": V.rate(F.sum("cancelled_booking_count"), total),
    }


def overall_health(fact: DataFrame) -> DataFrame:
    m = _health(fact)
    return fact.agg(
        m["total"].alias("total_fact_rows"), m["completed"].alias("completed_bookings"),
        m["cancelled"].alias("cancelled_bookings"), m["completion"].alias("completion_rate"),
        m["cancellation"].alias("cancellation_rate"), m["revenue"].alias("net_revenue"),
        m["rating"].alias("average_rating"),
    )


def baseline_snapshot(fact: DataFrame) -> DataFrame:
    m = _health(fact)
    return fact.agg(m["total"].alias("fact_bookings"), m["revenue"].alias("net_revenue"),
                    m["cancellation"].alias("cancellation_rate"))


def enrichment_coverage(bookings: DataFrame, reviews: DataFrame) -> DataFrame:
    insight = reviews.select(F.col("booking_id").alias("_review_id"))
    joined = bookings.select("booking_id", "review_text").join(
        insight, F.col("booking_id") == F.col("_review_id"), "left")
    candidates, enriched = F.count_if(F.col("review_text").isNotNull()), F.count("_review_id")
    return joined.agg(candidates.alias("review_candidates"), enriched.alias("enriched_reviews"),
                      V.rate(enriched, candidates).alias("enrichment_coverage"))


def review_label_counts(reviews: DataFrame) -> DataFrame:
    return (reviews.groupBy("sentiment_label", "complaint_category").agg(F.count("*").alias("review_count"))
            .orderBy(F.desc("review_count"), "sentiment_label", "complaint_category"))


def newest_kpis(kpi: DataFrame, limit: int = 20) -> DataFrame:
    return kpi.orderBy(F.desc("booking_date"), F.desc("total_revenue"), "booking_city", "service_category").limit(limit)


def kpis_since(kpi: DataFrame, day: str) -> DataFrame:
    return kpi.filter(F.col("booking_date") >= F.lit(day).cast("date")).select(
        "booking_date", "booking_city", "service_category", "total_bookings", "cancellation_rate",
        "total_revenue", "average_rating", "enriched_review_count", "negative_review_count",
    ).orderBy(F.desc("booking_date"), F.desc("total_revenue"), "booking_city", "service_category")


def version_history(providers: DataFrame, provider_ids: list[str]) -> DataFrame:
    return providers.filter(F.col("provider_id").isin(provider_ids)).select(
        "provider_id", "provider_tier", "primary_city", "operating_zone", "active_status",
        "effective_start_at", "effective_end_at", "is_current",
    ).orderBy("provider_id", "effective_start_at")


def cancellation_by_city(fact: DataFrame) -> DataFrame:
    total = F.count("*")
    return fact.groupBy("booking_city").agg(
        V.rate(F.sum("cancelled_booking_count"), total).alias("cancellation_rate"), total.alias("total_bookings"),
    ).orderBy(F.desc("cancellation_rate"), "booking_city")


def _with_category(fact: DataFrame, services: DataFrame) -> DataFrame:
    return fact.join(services.select("service_key", "service_category"), "service_key")


def revenue_and_rating_by_category(fact: DataFrame, services: DataFrame) -> DataFrame:
    return _with_category(fact, services).groupBy("service_category").agg(
        F.round(F.sum("final_amount"), 2).alias("net_revenue"), F.round(F.avg("rating"), 2).alias("average_rating"),
    ).orderBy(F.desc("net_revenue"))


def category_share(fact: DataFrame, services: DataFrame) -> DataFrame:
    """Bookings and revenue per category with the share of all bookings."""
    by_category = _with_category(fact, services).groupBy("service_category").agg(
        F.count("*").alias("total_bookings"), F.round(F.sum("final_amount"), 2).alias("net_revenue"))
    whole = by_category.agg(F.sum("total_bookings")).scalar()
    return by_category.withColumn("booking_share", V.rate(F.col("total_bookings"), whole))


def cancellation_by_city_and_category(fact: DataFrame, services: DataFrame) -> DataFrame:
    total = F.count("*")
    return _with_category(fact, services).groupBy("booking_city", "service_category").agg(
        total.alias("total_bookings"), V.rate(F.sum("cancelled_booking_count"), total).alias("cancellation_rate"))


def low_ratings_by_city_and_category(fact: DataFrame, services: DataFrame) -> DataFrame:
    """Average rating, and the share of rated bookings with three stars or fewer."""
    rated = F.count("rating")
    return _with_category(fact, services).groupBy("booking_city", "service_category").agg(
        F.round(F.avg("rating"), 2).alias("average_rating"),
        V.rate(F.count_if(F.col("rating") <= 3), rated).alias("low_rating_share"))


def tier_advantage(fact: DataFrame, providers: DataFrame) -> DataFrame:
    total = F.count("*")
    return fact.join(providers.select("provider_key", "provider_tier"), "provider_key").groupBy("provider_tier").agg(
        total.alias("total_bookings"), V.rate(F.sum("completed_booking_count"), total).alias("completion_rate"),
        F.round(F.avg("rating"), 2).alias("average_rating"))


def weekend_demand(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Bookings per calendar day on weekends and on other days."""
    booked = fact.groupBy("booking_date_key").agg(F.count("*").alias("n"))
    days = dates.join(booked, F.col("date_key") == F.col("booking_date_key"), "left")
    total = F.coalesce(F.sum("n"), F.lit(0))
    return days.groupBy("is_weekend").agg(
        F.count("*").alias("calendar_days"), total.alias("total_bookings"),
        F.round(total / F.count("*"), 2).alias("bookings_per_day"))


def negative_themes(reviews: DataFrame) -> DataFrame:
    return (reviews.filter("sentiment_label = 'negative'").groupBy("complaint_category")
            .agg(F.count("*").alias("review_count")).orderBy(F.desc("review_count"), "complaint_category"))


def version_change_kinds(providers: DataFrame) -> DataFrame:
    """What each new version changed against the one before it."""
    watched = ["provider_tier", "operating_zone", "primary_city", "active_status"]
    packed = providers.withColumn("_now", F.struct(*watched)).select("provider_id", "effective_start_at", "_now")
    walked = with_previous(packed, "provider_id", "effective_start_at", "_now", "_before")
    changed = walked.filter(F.col("_before").isNotNull())
    kinds = F.array_compact(F.array(*[
        F.when(F.col(f"_now.{n}") != F.col(f"_before.{n}"), F.lit(n)) for n in watched]))
    return changed.select(F.explode(kinds).alias("changed_attribute")).groupBy("changed_attribute").agg(
        F.count("*").alias("versions"))
