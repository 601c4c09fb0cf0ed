"""Booking records out of an order/line-item star schema.

Line items play booking snapshots, suppliers play providers and parts play
services. Everything is a projection, join or grouping over the given tables, so
the records grow with them. Source times carry no zone and are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions import values as V
from tidewell.operators import dims
from tidewell.operators.clean import hashed_provider
from tidewell.session import configure, spread

INGESTED_AT = "2002-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _group(name: str, number: Column) -> Column:
    return F.concat(F.lit(f"{name} "), number.cast("string"))


def _id(name: str) -> Column:
    return F.col(name).cast("string")


def _month(at: Column) -> Column:
    return F.substring(F.to_date(at).cast("string"), 1, 7)


def _cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by their title-cased name, worked out before they are joined."""
    return table(spark, sf_dir, "nation").select("n_nationkey", V.title_trim(F.col("n_name")).alias("city"))


#: Groups within which documents and bookings are paired off in order.
PAIRED = 256


def reviewed_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(review_of, doc_id): every document is the review of a booking all of whose snapshots are completed.

    Ids of equal remainder are paired off in their order, so no task numbers the whole
    table. Documents beyond the number of such bookings would stay without one.
    """
    number = lambda remainder, id: F.row_number().over(Window.partitionBy(remainder).orderBy(id))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.every(F.col("l_returnflag") == "A").alias("completed")).where("completed")
    bookings = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_of"), (F.col("l_orderkey") % PAIRED).alias("r"))
    documents = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % PAIRED).alias("r"))
    return bookings.withColumn("n", number("r", "review_of")).join(
        documents.withColumn("n", number("r", "doc_id")), ["r", "n"]).select("review_of", "doc_id")


#: Bytes of document texts, or of their ids, up to which they are handed to all tasks; bookings stay where they are then.
HANDED_OUT = 64 << 20


class _Reviews:
    """Documents as reviews. Spark judges them by the size of the line items, so their own size is measured here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        documents = table(spark, sf_dir, "documents").select("doc_id", "text")
        size, rows = documents.agg(F.sum(F.octet_length("text") + 32), F.count("*")).first()
        handed = lambda df, size: F.broadcast(df) if size <= HANDED_OUT else df
        self.large = (size or 0) > HANDED_OUT
        reviewed = reviewed_bookings(spark, sf_dir)
        #: The bookings that have a review; there are no more of them than documents.
        self.ids = handed(reviewed.select(_id("review_of")), 64 * rows)
        texts = documents.join(handed(reviewed, 64 * rows), "doc_id").select(
            _id("review_of"), V.blank_to_null(F.col("text")).alias("text"))
        self.texts = handed(texts, size or 0)

    def added(self, bookings: DataFrame) -> DataFrame:
        joined = bookings.join(self.texts, F.col("booking_id") == F.col("review_of"), "left")
        return joined.select(*[F.col("text").alias(n) if n == "review_text" else F.col(n) for n in bookings.columns])


def with_review_texts(spark: SparkSession, sf_dir: str, bookings: DataFrame) -> DataFrame:
    """Bookings with the text of their document as `review_text`. They are dealt out by their id, as ranked ones are already."""
    return _Reviews(spark, sf_dir).added(bookings)


def _booking_id() -> Column:
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")


def booking_snapshots(spark: SparkSession, sf_dir: str, reviews: bool = True) -> DataFrame:
    """Typed snapshots, several per booking, with the envelope columns.

    Without `reviews` the review text is null and the documents are not read.
    """
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    if not reviews:
        return _snapshots(spark, sf_dir, lines)
    found = _Reviews(spark, sf_dir)
    if not found.large:
        return found.added(_snapshots(spark, sf_dir, lines))
    # Texts too large for all tasks go to the snapshots that have one. The lines are told apart before they
    # are dealt out to their orders, so that the many others are not dealt out once more, and none twice.
    part = lambda how: _snapshots(spark, sf_dir, lines.join(found.ids, _booking_id() == F.col("review_of"), how))
    return part("left_anti").unionByName(found.added(part("left_semi")))


def _snapshots(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    c = F.col
    nations = _cities(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    completed = c("l_returnflag") == "A"
    ordered = c("o_orderdate").cast("timestamp")
    shipped = c("l_shipdate").cast("timestamp")
    status = (
        F.when(c("l_returnflag") == "R", "CANCELLED")
        .when(completed, "COMPLETED")
        .when(c("l_linestatus") == "F", "IN_PROGRESS")
        .otherwise("BOOKED")
    )
    started = F.when(completed, shipped + F.expr("interval 9 hours"))
    gross = c("l_extendedprice").cast("decimal(12,2)")
    discount = F.round(gross * c("l_discount").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    tax = F.round((gross - discount) * F.lit("0.18").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    final = (gross - discount + tax).cast("decimal(12,2)")

    # Orders meet their customers first, so that the far more lines are dealt out once.
    placed = orders.join(customers.join(nations, c("c_nationkey") == c("n_nationkey")), c("o_custkey") == c("c_custkey"))
    joined = lines.join(placed, c("l_orderkey") == c("o_orderkey"))
    return joined.select(
        _booking_id().alias("booking_id"),
        _id("o_custkey").alias("customer_id"),
        _id("l_suppkey").alias("provider_id"),
        _id("l_partkey").alias("service_id"),
        c("city").alias("booking_city"),
        ordered.alias("booking_created_at"),
        (ordered + F.expr("interval 2 days")).alias("scheduled_at"),
        started.alias("service_started_at"),
        (started + F.make_dt_interval(mins=F.lit(15) + c("l_quantity").cast("int"))).alias("service_completed_at"),
        status.alias("booking_status"),
        gross.alias("gross_amount"),
        discount.alias("discount_amount"),
        tax.alias("tax_amount"),
        final.alias("final_amount"),
        c("o_orderpriority").alias("payment_method"),
        F.when(completed, F.lit(1) + c("l_quantity").cast("int") % 5).alias("rating"),
        F.lit(None).cast("string").alias("review_text"),
        shipped.alias("record_updated_at"),
        F.concat(F.lit("bookings/"), _month(shipped), F.lit(".json.gz")).alias("source_filename"),
        (gross * 100).cast("bigint").alias("source_row_number"),
        F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at"),
        c("l_quantity").cast("int").alias("_quantity"),
    )


def typed_bookings(spark: SparkSession, sf_dir: str, reviews: bool = True) -> DataFrame:
    return booking_snapshots(spark, sf_dir, reviews).drop("_quantity")


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(name)


def _envelope(df: DataFrame, fields: list[Column | str]) -> DataFrame:
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(payload.alias("payload"), "source_filename", "source_row_number", "ingested_at")


_BOOKING_TIMES = ("booking_created_at", "scheduled_at", "service_started_at", "service_completed_at", "record_updated_at")


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as JSON records in the raw envelope."""
    typed = typed_bookings(spark, sf_dir)
    fields = [_iso(n) if n in _BOOKING_TIMES else F.col(n)
              for n in typed.columns if n not in ("source_filename", "source_row_number", "ingested_at")]
    return _envelope(typed, fields)


def faulty_raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records, with one fault per chosen quantity (whole table kept)."""
    typed = booking_snapshots(spark, sf_dir)
    q, c = F.col("_quantity"), F.col
    planted = {
        "customer_id": F.when(q == 1, F.lit(None).cast("string")).otherwise(c("customer_id")),
        "booking_created_at": F.when(q == 2, F.lit("not a date")).otherwise(_iso("booking_created_at")),
        "booking_status": F.when(q == 3, F.concat(F.lit(" "), F.lower("booking_status"), F.lit("  ")))
        .when(q == 4, F.lit("PAUSED")).otherwise(c("booking_status")),
        "final_amount": F.when(q == 5, F.lit("-0.01")).when(q == 6, F.lit("abc")).when(q == 7, F.lit("0"))
        .otherwise(c("final_amount").cast("string")),
        "record_updated_at": F.when(q == 8, F.lit("never")).otherwise(_iso("record_updated_at")),
        "review_text": F.when(q == 9, F.lit("   ")).otherwise(c("review_text")),
        "rating": F.when(q == 10, F.lit("4.5")).otherwise(c("rating").cast("string")),
        "booking_city": F.when(q == 11, F.concat(F.lit(" "), F.lower("booking_city"), F.lit(" "))).otherwise(c("booking_city")),
    }
    fields = []
    for name in typed.columns:
        if name in ("source_filename", "source_row_number", "ingested_at", "_quantity"):
            continue
        if name in planted:
            fields.append(planted[name].alias(name))
        else:
            fields.append(_iso(name) if name in _BOOKING_TIMES else c(name))
    return _envelope(typed, fields)


def provider_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per supplier and quarter, typed and hashed."""
    c = F.col
    quarters = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.date_trunc("quarter", F.col("l_shipdate").cast("timestamp")).alias("effective_at"))
        .agg(
            F.count("*").alias("lines"),
            F.count_if(c("l_returnflag") == "R").alias("returned"),
            F.count_if(c("l_linestatus") == "O").alias("open"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = _cities(spark, sf_dir)
    events = (
        quarters.join(suppliers, c("l_suppkey") == c("s_suppkey"))
        .join(nations, c("s_nationkey") == c("n_nationkey"))
        .select(
            _id("l_suppkey").alias("provider_id"),
            c("s_name").alias("provider_name"),
            c("city").alias("primary_city"),
            _group("Zone", c("returned") % 5).alias("operating_zone"),
            F.when(c("lines") >= 22, "PREMIUM").otherwise("STANDARD").alias("provider_tier"),
            _group("LEVEL", c("l_suppkey") % 3).alias("experience_level"),
            F.when(c("open") % 10 == 0, "INACTIVE").otherwise("ACTIVE").alias("active_status"),
            _group("Category", c("l_suppkey") % 5).alias("primary_service_category"),
            "effective_at",
            c("effective_at").alias("record_updated_at"),
            F.concat(F.lit("providers/"), _month(c("effective_at")), F.lit(".json.gz")).alias("source_filename"),
            c("l_suppkey").alias("source_row_number"),
            F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at"),
        )
    )
    return hashed_provider(events)


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = provider_events(spark, sf_dir).drop("attribute_hash")
    fields = [_iso(n) if n in ("effective_at", "record_updated_at") else F.col(n)
              for n in events.columns if n not in ("source_filename", "source_row_number", "ingested_at")]
    return _envelope(events, fields)


def faulty_raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider events with a fault wherever the zone or month calls for one."""
    events = provider_events(spark, sf_dir).drop("attribute_hash")
    c = F.col
    second = F.month("effective_at") == 4
    planted = {
        "provider_id": F.when(second & (c("operating_zone") == "Zone 0"), F.lit(None).cast("string")).otherwise(c("provider_id")),
        "effective_at": F.when(second & (c("operating_zone") == "Zone 1"), F.lit("soon")).otherwise(_iso("effective_at")),
        "provider_tier": F.when(second & (c("operating_zone") == "Zone 2"), F.lit("GOLD")).otherwise(F.lower("provider_tier")),
        "active_status": F.when(second & (c("operating_zone") == "Zone 3"), F.lit("paused"))
        .otherwise(F.concat(F.lit(" "), c("active_status"))),
    }
    fields = []
    for name in events.columns:
        if name in ("source_filename", "source_row_number", "ingested_at"):
            continue
        if name in planted:
            fields.append(planted[name].alias(name))
        else:
            fields.append(_iso(name) if name == "record_updated_at" else c(name))
    return _envelope(events, fields)


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    nations = _cities(spark, sf_dir)
    return spread(table(spark, sf_dir, "customer"), "c_custkey").join(nations, c("c_nationkey") == c("n_nationkey")).select(
        _id("c_custkey").alias("customer_id"),
        c("c_name").alias("customer_name"),
        F.upper("c_mktsegment").alias("customer_segment"),
        c("city").alias("home_city"),
        F.date_add(F.lit("1994-01-01").cast("date"), (c("c_custkey") % 365).cast("int")).alias("signup_date"),
        (c("c_acctbal") >= 0).alias("is_active"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads per customer: an older one with the reverse activity flag."""
    records = customer_records(spark, sf_dir)
    loads = records.withColumn("load", F.explode(F.array(F.lit(0), F.lit(1))))
    stamped = loads.select(
        "customer_id", "customer_name", F.lower("customer_segment").alias("customer_segment"),
        "home_city", "signup_date",
        F.when(F.col("load") == 1, F.col("is_active")).otherwise(~F.col("is_active")).alias("is_active"),
        F.lit("reference/customers.json.gz").alias("source_filename"),
        (F.col("customer_id").cast("bigint") + 1).alias("source_row_number"),
        (F.lit(INGESTED_AT).cast("timestamp") + F.make_dt_interval(days=F.col("load"))).alias("ingested_at"),
    )
    return _envelope(stamped, ["customer_id", "customer_name", "customer_segment", "home_city", "signup_date", "is_active"])


def service_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return spread(table(spark, sf_dir, "part"), "p_partkey").select(
        _id("p_partkey").alias("service_id"),
        c("p_name").alias("service_name"),
        c("p_type").alias("service_category"),
        c("p_retailprice").cast("decimal(12,2)").alias("standard_price"),
        (F.lit(15) + c("p_size")).cast("int").alias("expected_duration_minutes"),
        F.upper("p_brand").alias("skill_level_required"),
        F.lit(True).alias("is_active"),
    )


def raw_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads per service: the older one has the price off by one."""
    loads = service_records(spark, sf_dir).withColumn("load", F.explode(F.array(F.lit(0), F.lit(1))))
    stamped = loads.select(
        "service_id", "service_name", "service_category",
        F.when(F.col("load") == 1, F.col("standard_price")).otherwise(F.col("standard_price") + 1).alias("standard_price"),
        "expected_duration_minutes",
        F.lower("skill_level_required").alias("skill_level_required"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.lit("reference/services.json.gz").alias("source_filename"),
        (F.col("service_id").cast("bigint") + 1).alias("source_row_number"),
        (F.lit(INGESTED_AT).cast("timestamp") + F.make_dt_interval(days=F.col("load"))).alias("ingested_at"),
    )
    return _envelope(stamped, ["service_id", "service_name", "service_category", "standard_price",
                               "expected_duration_minutes", "skill_level_required", "is_active"])


def write_json_lines(raw: DataFrame, path: str) -> None:
    """Payloads as gzip JSON Lines files."""
    raw.select(F.col("payload").alias("value")).write.option("compression", "gzip").text(path)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years that orders reach into, day by day."""
    return dims.calendar_of_years(table(spark, sf_dir, "orders").filter("o_orderdate is not null"), "o_orderdate")
