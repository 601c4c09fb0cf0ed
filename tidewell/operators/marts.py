"""Booking fact and the daily service KPI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import values as V
from tidewell.operators.asof import point_in_time_join

FACT_REQUIRED = ["booking_id", "booking_date_key"]
#: Columns of the bookings that the fact takes over or works out its measures from.
CARRIED = ["booking_id", "booking_city", "booking_status", "payment_method", "booking_created_at", "scheduled_at",
           "service_started_at", "service_completed_at", "gross_amount", "discount_amount", "tax_amount", "final_amount",
           "rating", "record_updated_at", "source_filename"]
KPI_KEYS = ["booking_date_key", "booking_date", "booking_city", "service_category"]


def _looked_up(rows: DataFrame, customers: DataFrame, services: DataFrame, providers: DataFrame) -> DataFrame:
    """Rows of different bookings with their keys. Each key comes by rows that hold the booking's id and what the key
    depends on alone, and meets the whole rows by that id."""
    by = lambda *names: rows.select("booking_id", *names)
    customer = by("customer_id").join(customers.select("customer_id", "customer_key"), "customer_id").drop("customer_id")
    service = by("service_id").join(services.select("service_id", "service_key"), "service_id").drop("service_id")
    version = _versioned(by("provider_id", "booking_created_at"), providers).where("effective_start_at is not null")
    for key in (customer, service, version.drop("provider_id", "booking_created_at")):
        rows = rows.join(key, "booking_id", "left")
    return rows


def _joined(rows: DataFrame, customers: DataFrame, services: DataFrame, providers: DataFrame, natural: bool = True) -> DataFrame:
    """Any rows with their keys: the whole rows are dealt out by each."""
    keyed = (
        rows.join(customers.select("customer_id", "customer_key"), "customer_id", "left")
        .join(services.select("service_id", "service_key"), "service_id", "left")
    )
    return _versioned(keyed, providers) if natural else _versioned(keyed.drop("customer_id", "service_id"), providers, ())


def _versioned(rows: DataFrame, providers: DataFrame, beside: tuple[str, ...] = ("effective_start_at",)) -> DataFrame:
    return point_in_time_join(rows, providers, "provider_id", "booking_created_at",
                              "effective_start_at", "effective_end_at", ["provider_key", *beside])


def build_fact_booking(
    bookings: DataFrame, customers: DataFrame, services: DataFrame, providers: DataFrame, natural: bool = False, stored: bool = False
) -> DataFrame:
    """One row per latest booking; unresolved dimension keys stay null.

    With `natural`, what the keys stand for comes along: customer_id, service_id, provider_id
    and version_start_at, null where the key is.

    With `stored`, `bookings` is a stored table, cheap to read several times. Then keys are looked up without the whole
    rows, which are dealt out once, or not at all if the table is bucketed by booking id. Rows of bookings that
    come more than once, or have no id, are looked for first and joined as a whole.

    The joins to the Type 1 dimensions carry no hint: Spark broadcasts a dimension
    whose measured size is below its threshold and splits skewed keys otherwise.
    """
    c = F.col
    # What the fact does not hold, as the review texts, stays behind before the joins deal the rows out.
    rows, dimensions = bookings.select("customer_id", "provider_id", "service_id", *CARRIED), (customers, services, providers)
    if stored:
        again = rows.groupBy(c("booking_id").alias("again")).agg(F.count("*").alias("n")).where("n > 1 or again is null").drop("n")
        part = lambda how: rows.join(again, c("booking_id").eqNullSafe(c("again")), how)
        resolved = _looked_up(rows, *dimensions) if again.isEmpty() else _looked_up(part("left_anti"), *dimensions).unionByName(
            _joined(part("left_semi"), *dimensions))
    else:
        resolved = _joined(rows, *dimensions, natural)
    found = {"customer_id": "customer_key", "service_id": "service_key", "provider_id": "provider_key"} if natural else {}
    return resolved.select(
        "booking_id",
        V.date_key(c("booking_created_at")).alias("booking_date_key"),
        "customer_key", "provider_key", "service_key",
        "booking_city", "booking_status", "payment_method",
        "booking_created_at", "scheduled_at", "service_started_at", "service_completed_at",
        "gross_amount", "discount_amount", "tax_amount", "final_amount",
        V.minutes_between(c("service_started_at"), c("service_completed_at")).alias("service_duration_minutes"),
        "rating",
        V.flag(c("booking_status") == "COMPLETED").alias("completed_booking_count"),
        V.flag(c("booking_status") == "CANCELLED").alias("cancelled_booking_count"),
        "record_updated_at", "source_filename",
        *[F.when(F.col(key).isNotNull(), F.col(name)).alias(name) for name, key in found.items()],
        *([F.col("effective_start_at").alias("version_start_at")] if natural else []),
    )


def _contributions(fact: DataFrame, dates: DataFrame, services: DataFrame, reviews: DataFrame) -> DataFrame:
    """What each booking adds to its group. Bookings without a calendar day or service drop out."""
    c = F.col
    insight = reviews.select(F.col("booking_id").alias("_review_id"), "sentiment_label")
    joined = (
        fact.select("booking_id", "booking_date_key", "booking_city", "service_key", "final_amount", "rating",
                    "completed_booking_count", "cancelled_booking_count")
        .join(insight, c("booking_id") == c("_review_id"), "left")
        .join(dates.select(c("date_key").alias("booking_date_key"), c("full_date").alias("booking_date")),
              "booking_date_key")
        .join(services.select("service_key", "service_category"), "service_key")
    )
    counts = {
        "total_bookings": F.lit(1), "completed_bookings": c("completed_booking_count"), "cancelled_bookings": c("cancelled_booking_count"),
        "rating_sum": F.coalesce(c("rating"), F.lit(0)), "rating_count": c("rating").isNotNull().cast("int"),
        "amount_count": c("final_amount").isNotNull().cast("int"), "enriched_review_count": c("_review_id").isNotNull().cast("int"),
        "negative_review_count": F.coalesce(c("sentiment_label") == "negative", F.lit(False)).cast("int"),
    }
    return joined.select(*KPI_KEYS, F.coalesce("final_amount", F.lit(0)).cast("decimal(28,2)").alias("amount_sum"),
                         *[v.cast("bigint").alias(n) for n, v in counts.items()])


#: The measures of a group that add up, in a table and under subtraction.
KPI_SUMS = ["amount_sum", "total_bookings", "completed_bookings", "cancelled_bookings", "rating_sum", "rating_count", "amount_count",
            "enriched_review_count", "negative_review_count"]


def _summed(rows: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.groupBy(*KPI_KEYS).agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in KPI_SUMS])


def kpi_sums(fact: DataFrame, dates: DataFrame, services: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sums per date, city and service category. Partial aggregation runs before the shuffle, so a busy group is cheap."""
    return _summed(_contributions(fact, dates, services, reviews))


def apply_deltas(sums: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """The sums after bookings changed: `gone` and `new` are sums of the changed rows as they were and as they are.

    A group that no booking is left in goes. No booking that did not change is read.
    """
    minus = gone.select(*KPI_KEYS, *[(-F.col(n)).alias(n) for n in KPI_SUMS])
    return _summed(sums.select(*KPI_KEYS, *KPI_SUMS).unionByName(minus).unionByName(new)).where("total_bookings <> 0")


def kpi_of(sums: DataFrame) -> DataFrame:
    """The measures out of the sums."""
    c = F.col
    return sums.select(
        *KPI_KEYS, "total_bookings", "completed_bookings", "cancelled_bookings",
        V.rate(c("completed_bookings"), c("total_bookings")).alias("completion_rate"),
        V.rate(c("cancelled_bookings"), c("total_bookings")).alias("cancellation_rate"),
        F.when(c("amount_count") > 0, F.round("amount_sum", 2)).alias("total_revenue"),
        F.when(c("rating_count") > 0, F.round(c("rating_sum") / c("rating_count"), 2)).alias("average_rating"),
        "enriched_review_count", "negative_review_count",
    )


def daily_service_kpi(fact: DataFrame, dates: DataFrame, services: DataFrame, reviews: DataFrame) -> DataFrame:
    """Measures per date, city and service category; bookings without a review stay."""
    return kpi_of(kpi_sums(fact, dates, services, reviews))


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that are only in one of two states of a table, `change` -1 for those that went and 1 for those that came.

    Nothing is dealt out if both states are bucketed by one of their columns. Spark sees that in a union by the
    columns of the first table, and knows them apart from stored ones only under names of their own.
    """
    names = [f"c{i}" for i, _ in enumerate(before.columns)]
    own = dict(zip(before.columns, names))
    state = lambda df, sign: df.withColumnsRenamed(own).withColumn("change", F.lit(sign))
    net = state(before, -1).unionByName(state(after, 1)).groupBy(*names).agg(F.sum("change").alias("net")).where("net <> 0")
    repeated = net.withColumn("change", F.explode(F.array_repeat(F.signum("net").cast("int"), F.abs("net").cast("int")))).drop("net")
    return repeated.toDF(*before.columns, "change")
