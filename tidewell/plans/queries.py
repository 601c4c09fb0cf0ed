"""Registered queries: every operator, run over the given tables as a whole.

Each takes a session and a table folder. Results use plain types (whole numbers as
bigint, money as double, times as text) so that any SQL engine can state the same.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import values as V
from tidewell.functions.lexicon import Lexicon
from tidewell.operators import asof, clean, dims, marts, ordered, quality, refresh, reviews, scd2, scoring
from tidewell.plans import questions, reports
from tidewell.plans.semantic import semantic_query
from tidewell.plans.model import MARKETPLACE
from tidewell.plans.stored import DOCUMENT_LEXICON, read, silver_bookings, stored_star, write
from tidewell.session import shared_dir, spread
from tidewell.sources import star
from tidewell.sources.json_lines import RejectedLoad, ledger, load_rows, mark_malformed, read_manifest, unseen_files
from tidewell.streaming import ingest, upkeep

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUT_OFF = datetime.date(1998, 9, 1)
#: Words of the documents and the words of the service lexicon put in their place.
STANDS_FOR = {"la": "late", "de": "rude", "der": "price", "und": "message", "an": "faulty", "is": "excellent", "of": "terrible", "in": "helpful"}
SAMPLE_PROVIDERS = ["1", "2", "16", "23", "28"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, for tables that a query keeps while it runs."""
    return f"{shared_dir(spark)}/tidewell-{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame) -> DataFrame:
    """Written and read again, as a maintained table is that several steps use."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stamp(text: str):
    return F.lit(text).cast("timestamp")


# ---- sources -------------------------------------------------------------


# Around a name: a JSON value, and lines that would close a wrapper pasted around them.
FORGED = [('{"a": "', '"}'), ('{"a": "', '"}], "x": [2'), ('["', '"]], "end": 1} {"z": [2'), ('"', '"], "line": [2'), ('"', '", 2')]


def mixed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event payloads, which are JSON, beside document texts, which are not."""
    events = spread(star.table(spark, sf_dir, "events"), "event_id").select(
        F.col("props").alias("payload"),
        F.concat(F.lit("events/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".json.gz")).alias("source_filename"),
        F.col("event_id").alias("source_row_number"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("ingested_at"))
    documents = spread(star.table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("text").alias("payload"),
        F.concat(F.lit("documents/"), "source", F.lit(".json.gz")).alias("source_filename"),
        F.col("doc_id").alias("source_row_number"),
        stamp("2024-02-01 00:00:00").alias("ingested_at"))
    return events.unionByName(documents)


def forged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines around region names, of which the first form alone is one JSON value."""
    forms = F.array(*[F.concat(F.lit(a), F.col("r_name"), F.lit(b)) for a, b in FORGED])
    return star.table(spark, sf_dir, "region").select(
        F.posexplode(forms).alias("n", "payload"), "r_regionkey").select(
        "payload", F.lit("forged/regions.json.gz").alias("source_filename"),
        (F.col("r_regionkey") * len(FORGED) + F.col("n") + 1).cast("bigint").alias("source_row_number"),
        stamp("2024-03-01 00:00:00").alias("ingested_at"))


@query
def load_history(spark, sf_dir):
    return plain(reports.load_history(mark_malformed(mixed_raw(spark, sf_dir).unionByName(forged_raw(spark, sf_dir)))))


@query
def new_file_rows(spark, sf_dir):
    offered = star.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("batch_"), F.date_format("l_shipdate", "yyyyMM")).alias("source_filename"))
    loaded = star.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("batch_"), F.date_format("o_orderdate", "yyyyMM")).alias("source_filename"))
    return unseen_files(offered, loaded).groupBy("source_filename").agg(F.count("*").alias("row_count"))


@query
def ledger_history(spark, sf_dir):
    """The load history from the ledger that a load of the same lines keeps; no raw row is read for it."""
    table = f"{scratch(spark)}/raw"
    load_rows(mixed_raw(spark, sf_dir).unionByName(forged_raw(spark, sf_dir)), table, "first", on_error="continue")
    return plain(reports.ledger_history(ledger(spark, table)))


@query
def new_file_rows_by_ledger(spark, sf_dir):
    """Lines of files that no load of the orders has brought, found by the names in the ledger."""
    table = f"{scratch(spark)}/raw"
    named = lambda day: F.concat(F.lit("batch_"), F.date_format(day, "yyyyMM")).alias("source_filename")
    loaded = star.table(spark, sf_dir, "orders").select(
        F.to_json(F.struct("o_orderkey")).alias("payload"), named("o_orderdate"), F.col("o_orderkey").alias("source_row_number"),
        stamp("2024-02-01 00:00:00").alias("ingested_at"))
    for half in (0, 1):
        load_rows(loaded.where(F.col("source_row_number") % 2 == half), table, f"half-{half}")
    offered = star.table(spark, sf_dir, "lineitem").select(named("l_shipdate"))
    return unseen_files(offered, ledger(spark, table)).groupBy("source_filename").agg(F.count("*").alias("row_count"))


@query
def manifest_check(spark, sf_dir):
    """A load against a manifest file that states a line too much for each file of documents, and names one that never came."""
    root = scratch(spark)
    lines = mixed_raw(spark, sf_dir)
    load_rows(lines, f"{root}/raw", "first", on_error="continue")
    stated = F.count("*") + F.startswith("source_filename", F.lit("documents/")).cast("int")
    files = lines.where("source_filename is not null").groupBy("source_filename").agg(stated.alias("physical_records")).select(
        F.struct(F.col("source_filename").alias("path"), "physical_records").alias("f"))
    never = star.table(spark, sf_dir, "region").agg(F.struct(F.lit("never/came.json.gz").alias("path"), F.count("*").alias("physical_records")).alias("f"))
    manifest = files.unionByName(never).agg(F.sort_array(F.collect_list("f")).alias("files"))
    manifest.select(F.to_json(F.struct("files"), {"pretty": "true"})).coalesce(1).write.text(f"{root}/manifest")
    loads = ledger(spark, f"{root}/raw").select("source_filename", (F.col("row_count") + F.col("error_count")).alias("row_count"))
    return quality.manifest_gaps(read_manifest(spark, f"{root}/manifest"), loads)


@query
def load_runs(spark, sf_dir):
    """Status of loads made here: what each wrote, counted while it was written, and the one that is refused."""
    from tidewell.streaming import audit

    root = scratch(spark)
    raws = {"customers": star.raw_customers(spark, sf_dir), "services": star.raw_services(spark, sf_dir),
            "providers": star.raw_providers(spark, sf_dir), "mixed": mixed_raw(spark, sf_dir), "refused": mixed_raw(spark, sf_dir)}
    for name, raw in raws.items():
        how = "continue" if name == "mixed" else "abort"
        try:
            audit.audited(spark, f"{root}/audit", name, lambda: load_rows(raw, f"{root}/{name}", "first", how))  # noqa: B023
        except RejectedLoad:
            pass
    runs = audit.last_outcomes(audit.read_runs(spark, f"{root}/audit"))
    return runs.select("name", "state", "input_rows", F.get_json_object("detail", "$.rejected").cast("bigint").alias("rejected"),
                       F.col("error_message").contains("malformed").alias("malformed"))


@query
def raw_table_counts(spark, sf_dir):
    return reports.row_counts({
        "RAW_BOOKING_EVENTS": stored_star(spark, sf_dir)["raw"],
        "RAW_PROVIDER_EVENTS": star.raw_providers(spark, sf_dir),
        "RAW_CUSTOMERS": star.raw_customers(spark, sf_dir),
        "RAW_SERVICES": star.raw_services(spark, sf_dir),
    })


# ---- casts, validation, latest state -------------------------------------

_BOOKING_VIEW = [
    "booking_id", "customer_id", "provider_id", "service_id", "booking_city", "booking_created_at", "scheduled_at",
    "service_started_at", "service_completed_at", "booking_status", "gross_amount", "discount_amount", "tax_amount",
    "final_amount", "payment_method", "rating", "record_updated_at", "source_filename", "source_row_number",
]


def _booking_view(df: DataFrame) -> DataFrame:
    return plain(df.select(*_BOOKING_VIEW, V.sha256(F.col("review_text")).alias("review_hash")))


@query
def parsed_bookings(spark, sf_dir):
    return _booking_view(clean.parse_bookings(stored_star(spark, sf_dir)["raw"]))


@query
def booking_faults(spark, sf_dir):
    parsed = clean.parse_bookings(star.faulty_raw_bookings(spark, sf_dir))
    return plain(parsed.select(
        "booking_id", "source_row_number", "booking_status", "booking_city", "rating", "final_amount",
        F.col("review_text").isNotNull().alias("has_review"), "record_updated_at",
        F.array_join(clean.booking_faults(), ", ").alias("faults")))


@query
def valid_booking_counts(spark, sf_dir):
    valid = clean.valid_bookings(clean.parse_bookings(star.faulty_raw_bookings(spark, sf_dir)))
    return valid.groupBy("booking_status").agg(F.count("*").alias("valid_rows"))


@query
def latest_valid_bookings(spark, sf_dir):
    return _booking_view(clean.clean_bookings(star.faulty_raw_bookings(spark, sf_dir)))


@query
def latest_bookings(spark, sf_dir):
    return _booking_view(silver_bookings(spark, sf_dir))


@query
def newest_by_aggregation(spark, sf_dir):
    """The latest state by the aggregation that the bookings stream keeps, in two steps: what one half of the
    snapshots leaves meets what the other half does, and both lie by booking then."""
    snapshots = clean.valid_bookings(star.typed_bookings(spark, sf_dir, reviews=False))
    half = F.pmod(F.xxhash64("source_row_number"), F.lit(2))
    newest = lambda rows: upkeep.newest_snapshots(rows).select("booking_id", "newest.*").select(*snapshots.columns)
    first, second = (newest(snapshots.where(half == n)) for n in (0, 1))
    return _booking_view(star.with_review_texts(spark, sf_dir, newest(first.unionByName(second))))


@query
def refreshed_latest_bookings(spark, sf_dir):
    snapshots = clean.valid_bookings(star.typed_bookings(spark, sf_dir, reviews=False))
    border = stamp("1998-06-01 00:00:00")
    current = clean.latest_bookings(snapshots.filter(F.col("record_updated_at") < border))
    arrived = snapshots.filter(F.col("record_updated_at") >= border)
    return _booking_view(star.with_review_texts(spark, sf_dir, refresh.refresh_latest(current, arrived)))


_PROVIDER_VIEW = ["provider_id", "provider_name", "primary_city", "operating_zone", "provider_tier",
                  "experience_level", "active_status", "primary_service_category", "effective_at", "attribute_hash"]


@query
def provider_changes(spark, sf_dir):
    return plain(clean.clean_providers(star.raw_providers(spark, sf_dir)).select(*_PROVIDER_VIEW))


@query
def provider_changes_maintained(spark, sf_dir):
    """The events table as its stream keeps it: two loads, and a run without new rows."""
    lake = upkeep.Layout(scratch(spark))
    raw = star.faulty_raw_providers(spark, sf_dir)
    early = F.col("source_filename") < "providers/1996"
    for name, rows in (("early", raw.where(early)), ("late", raw.where(~early))):
        load_rows(rows, lake.raw("providers"), name)
        ingest.run_available(upkeep.provider_events_step(spark, lake))
    ingest.run_available(upkeep.provider_events_step(spark, lake))
    return plain(upkeep.provider_events(spark, lake).select(*_PROVIDER_VIEW))


@query
def valid_provider_events(spark, sf_dir):
    return plain(clean.clean_providers(star.faulty_raw_providers(spark, sf_dir)).select(*_PROVIDER_VIEW))


@query
def applicable_provider_events(spark, sf_dir):
    """The live path's weaker filter: unknown tiers and states pass."""
    applicable = clean.applicable_changes(clean.parse_providers(star.faulty_raw_providers(spark, sf_dir)))
    return applicable.groupBy("provider_tier", "active_status").agg(F.count("*").alias("events"))


@query
def missing_required_columns(spark, sf_dir):
    parsed = clean.parse_bookings(star.faulty_raw_bookings(spark, sf_dir))
    _, lacking = clean.split_not_null(parsed, ["customer_id", "booking_created_at", "final_amount", "record_updated_at"])
    return lacking.groupBy(F.array_join("missing_columns", ",").alias("missing_columns")).agg(F.count("*").alias("rows"))


@query
def distinct_json_values(spark, sf_dir):
    raw = mixed_raw(spark, sf_dir)
    return reports.distinct_payload_field(raw, "k")


@query
def distinct_raw_bookings(spark, sf_dir):
    return reports.distinct_payload_field(stored_star(spark, sf_dir)["raw"], "booking_id")


@query
def json_value_counts(spark, sf_dir):
    value = F.get_json_object("payload", "$.k").cast("bigint")
    return mixed_raw(spark, sf_dir).groupBy(value.alias("k")).agg(F.count("*").alias("rows"))


# ---- dimensions ----------------------------------------------------------


@query
def calendar(spark, sf_dir):
    return plain(dims.calendar_spanning(star.table(spark, sf_dir, "orders"), "o_orderdate"))


@query
def calendar_extended(spark, sf_dir):
    """The days of 1996 that orders reach into are there already; the missing ones of a longer range join them."""
    known = star.calendar(spark, sf_dir).filter("year = 1996")
    return plain(dims.build_dim_date(spark, "1996-06-01", "1998-12-31", known))


_FIRST, _SECOND = "2002-01-03 00:00:00", "2002-01-04 00:00:00"


@query
def customer_dimension(spark, sf_dir):
    """A first load of active customers, then a second load of all of them."""
    source = clean.clean_customers(star.raw_customers(spark, sf_dir))
    early = source.filter("is_active").withColumn("customer_segment", F.lit("NEW"))
    first = dims.merge_customers(None, early, stamp(_FIRST))
    merged = dims.merge_customers(first, source, stamp(_SECOND))
    return plain(merged.drop("customer_key"))


@query
def service_dimension(spark, sf_dir):
    source = clean.clean_services(star.raw_services(spark, sf_dir))
    early = source.filter("standard_price < 1000").withColumn("standard_price", F.col("standard_price") + 5)
    first = dims.merge_services(None, early, stamp(_FIRST))
    merged = dims.merge_services(first, source, stamp(_SECOND))
    return plain(merged.drop("service_key"))


@query
def surrogate_keys(spark, sf_dir):
    """Key statistics after two loads: as many keys as rows, none given twice."""
    customers = clean.clean_customers(star.raw_customers(spark, sf_dir))
    first = dims.merge_customers(None, customers.filter("is_active"))
    both = dims.merge_customers(first, customers)
    moved = first.select("customer_id", F.col("customer_key").alias("first_key")).join(both, "customer_id").filter(
        "first_key <> customer_key")
    return quality.stack([
        df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("distinct_keys"),
               F.count_if(F.col(key) <= 0).alias("invalid_keys"))
        .select(F.lit(name).alias("object_name"), "rows", "distinct_keys", "invalid_keys")
        for name, df, key in [
            ("customers", both, "customer_key"),
            ("moved_customers", moved, "customer_key"),
            ("services", dims.merge_services(None, clean.clean_services(star.raw_services(spark, sf_dir))), "service_key"),
            ("provider_versions", scd2.scd2_history(star.provider_events(spark, sf_dir)), "provider_key"),
        ]
    ])


# ---- provider history ----------------------------------------------------

_VERSION_VIEW = ["provider_id", "primary_city", "operating_zone", "provider_tier", "experience_level",
                 "active_status", "effective_start_at", "effective_end_at", "is_current", "attribute_hash"]


@query
def provider_seed(spark, sf_dir):
    """Seed the providers of level 2 from their 1997 states, then everybody who is missing."""
    events = star.provider_events(spark, sf_dir)
    experts = events.filter((F.col("experience_level") == "LEVEL 2") & (F.year("effective_at") == 1997))
    return plain(scd2.scd2_seed(events, scd2.scd2_seed(experts)).select(*_VERSION_VIEW))


@query
def latest_provider_changes(spark, sf_dir):
    return plain(scd2.latest_changes(star.provider_events(spark, sf_dir)).select(*_PROVIDER_VIEW))


def _late_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events before 1998, and a batch in which the last events of zone 0 arrive six years late."""
    events = star.provider_events(spark, sf_dir)
    border = stamp("1998-01-01 00:00:00")
    batch = scd2.latest_changes(events.filter(F.col("effective_at") >= border))
    late = F.when(F.col("operating_zone") == "Zone 0", F.col("effective_at") - F.expr("interval 6 years"))
    newcomer = F.when(F.col("operating_zone") == "Zone 1", F.concat(F.lit("new-"), "provider_id"))
    batch = batch.withColumn("effective_at", F.coalesce(late, "effective_at")).withColumn(
        "provider_id", F.coalesce(newcomer, "provider_id"))
    return events.filter(F.col("effective_at") < border), batch


@query
def provider_batch_applied(spark, sf_dir):
    """Close and insert steps on an existing history, with late and new providers."""
    before, batch = _late_batch(spark, sf_dir)
    return plain(scd2.scd2_apply(kept(scd2.scd2_history(before)), batch).select(*_VERSION_VIEW))


@query
def provider_history(spark, sf_dir):
    return plain(scd2.scd2_history(star.provider_events(spark, sf_dir)).select(*_VERSION_VIEW))


@query
def provider_history_applied(spark, sf_dir):
    """The same history, from a seed and one batch with every later event."""
    events = star.provider_events(spark, sf_dir)
    return plain(scd2.scd2_apply_all(scd2.scd2_seed(events), events).select(*_VERSION_VIEW))


@query
def provider_sample_history(spark, sf_dir):
    return plain(reports.version_history(stored_star(spark, sf_dir)["providers"], SAMPLE_PROVIDERS))


# ---- joins and marts -----------------------------------------------------


@query
def point_in_time_versions(spark, sf_dir):
    """Every snapshot with the version valid when its booking was created."""
    snapshots = star.typed_bookings(spark, sf_dir, reviews=False).select(
        "booking_id", "source_row_number", "provider_id", "booking_created_at")
    versions = stored_star(spark, sf_dir)["providers"]
    matched = asof.point_in_time_join(
        snapshots, versions, "provider_id", "booking_created_at", "effective_start_at", "effective_end_at",
        ["provider_tier", "operating_zone", "effective_start_at"])
    return plain(matched)


@query
def point_in_time_misses(spark, sf_dir):
    """The same join against versions that each begin half a year late, so many rows find nothing."""
    snapshots = star.typed_bookings(spark, sf_dir, reviews=False).select(
        "booking_id", "source_row_number", "provider_id", "booking_created_at")
    versions = stored_star(spark, sf_dir)["providers"].withColumn(
        "effective_start_at", F.col("effective_start_at") + F.expr("interval 180 days"))
    matched = asof.point_in_time_join(
        snapshots, versions, "provider_id", "booking_created_at", "effective_start_at", "effective_end_at",
        ["effective_start_at"])
    return plain(matched)


@query
def point_in_time_overlapping(spark, sf_dir):
    """Versions that reach a month into the next one: a row may be valid under several."""
    snapshots = star.typed_bookings(spark, sf_dir, reviews=False).select(
        "booking_id", "source_row_number", "provider_id", "booking_created_at")
    versions = stored_star(spark, sf_dir)["providers"].select(
        "provider_id", "provider_tier", "effective_start_at",
        F.when(F.col("is_current"), F.col("effective_end_at")).otherwise(F.col("effective_end_at") + F.expr("interval 30 days")).alias("until"))
    return plain(asof.point_in_time_join(snapshots, versions, "provider_id", "booking_created_at", "effective_start_at", "until",
                                         ["provider_tier", "effective_start_at"]))


@query
def fact_booking(spark, sf_dir):
    """The fact from source tables, its keys shown as what they refer to."""
    customers = dims.merge_customers(None, clean.clean_customers(star.raw_customers(spark, sf_dir)))
    services = dims.merge_services(None, clean.clean_services(star.raw_services(spark, sf_dir)))
    versions = stored_star(spark, sf_dir)["providers"]
    path = scratch(spark)
    write(silver_bookings(spark, sf_dir, reviews=False), path, "booking_id")
    fact = marts.build_fact_booking(read(spark, path, "booking_id"), customers, services, versions, natural=True, stored=True)
    return plain(fact.drop("customer_key", "service_key", "provider_key"))


_KPI_VIEW = [*marts.KPI_KEYS, "total_bookings", "completed_bookings", "cancelled_bookings", "completion_rate",
             "cancellation_rate", "total_revenue", "average_rating", "enriched_review_count", "negative_review_count"]


@query
def daily_service_kpi(spark, sf_dir):
    """Source tables to KPI in one plan: latest state, services, review scores, measures."""
    latest = silver_bookings(spark, sf_dir)
    services = star.service_records(spark, sf_dir).withColumn("service_key", F.col("service_id").cast("bigint"))
    fact = (
        latest.withColumn("service_key", F.col("service_id").cast("bigint"))
        .withColumn("booking_date_key", V.date_key(F.col("booking_created_at")))
        .withColumn("completed_booking_count", V.flag(F.col("booking_status") == "COMPLETED"))
        .withColumn("cancelled_booking_count", V.flag(F.col("booking_status") == "CANCELLED"))
    )
    insight = reviews.backfill_reviews(None, latest, scoring.lexicon_scorer(DOCUMENT_LEXICON), "LEXICON", limit=None)
    dates = star.calendar(spark, sf_dir)
    return plain(marts.daily_service_kpi(fact, dates, services, insight).select(*_KPI_VIEW))


@query
def stored_kpi(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return plain(marts.daily_service_kpi(s["bookings"], s["dates"], s["services"], s["reviews"]).select(*_KPI_VIEW))


@query
def refreshed_kpi(spark, sf_dir):
    """KPI of the bookings up to a day, brought up to date for the dates after it."""
    s = stored_star(spark, sf_dir)
    early = s["bookings"].filter("record_updated_at < timestamp '1998-06-01 00:00:00'")
    before = marts.daily_service_kpi(early, s["dates"], s["services"], s["reviews"])
    arrived = s["bookings"].filter("record_updated_at >= timestamp '1998-06-01 00:00:00'")
    touched = refresh.touched_dates(early, arrived)
    return plain(refresh.refresh_kpi(before, touched, s["bookings"], s["dates"], s["services"], s["reviews"])
                 .select(*_KPI_VIEW))


@query
def kpi_by_deltas(spark, sf_dir):
    """KPI of an earlier and partly wrong fact, brought up to date by the rows that differ alone."""
    s = stored_star(spark, sf_dir)
    wrong = F.when(F.col("payment_method") == "5-LOW", F.col("final_amount") + 1).otherwise(F.col("final_amount")).cast("decimal(12,2)")
    before = s["bookings"].where("record_updated_at < timestamp '1998-06-01 00:00:00' or booking_status = 'CANCELLED'").withColumn(
        "final_amount", wrong).withColumn("booking_city", F.when(F.col("rating") == 1, F.lit("Nowhere")).otherwise(F.col("booking_city")))
    dimensions = (s["dates"], s["services"], s["reviews"])
    changes = marts.row_changes(before, s["bookings"])
    gone, came = (marts.kpi_sums(changes.where(F.col("change") == sign).drop("change"), *dimensions) for sign in (-1, 1))
    return plain(marts.kpi_of(marts.apply_deltas(marts.kpi_sums(before, *dimensions), gone, came)).select(*_KPI_VIEW))


@query
def newest_kpis(spark, sf_dir):
    return plain(reports.newest_kpis(stored_star(spark, sf_dir)["kpi"]).select(*_KPI_VIEW))


@query
def kpis_since_day(spark, sf_dir):
    return plain(reports.kpis_since(stored_star(spark, sf_dir)["kpi"], CUT_OFF.isoformat()))


@query
def overlapping_interval_pairs(spark, sf_dir):
    """Overlapping pairs per supplier among intervals of `quantity` days from shipping."""
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("starts"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(days=F.col("l_quantity").cast("int"))).alias("ends"))
    return ordered.overlap_pairs(lines, "l_suppkey", "starts", "ends")


# ---- review scoring ------------------------------------------------------


def _documents(spark, sf_dir) -> DataFrame:
    return spread(star.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review_text")), "doc_id")


@query
def scored_documents(spark, sf_dir):
    scored = scoring.lexicon_scorer(DOCUMENT_LEXICON)(_documents(spark, sf_dir))
    return scored.select("doc_id", scoring.sentiment_label().alias("sentiment_label"),
                         scoring.theme_label().alias("complaint_category"))


@query
def service_scored_documents(spark, sf_dir):
    """The service lexicon itself, with all its themes."""
    scored = scoring.lexicon_scorer()(_documents(spark, sf_dir))
    return scored.select("doc_id", scoring.sentiment_label().alias("sentiment_label"),
                         scoring.theme_label().alias("complaint_category"))


@query
def theme_word_documents(spark, sf_dir):
    """Words of the service lexicon stand in for the most frequent short words of the documents, so that all themes occur."""
    spoken = F.lower("text")
    for word, other in STANDS_FOR.items():
        spoken = F.regexp_replace(spoken, rf"(?<![a-z]){word}(?![a-z])", other)
    rows = spread(star.table(spark, sf_dir, "documents").select("doc_id", spoken.alias("review_text")), "doc_id")
    return scoring.lexicon_scorer()(rows).groupBy(
        scoring.sentiment_label().alias("sentiment_label"), scoring.theme_label().alias("complaint_category")).agg(
        F.count("*").alias("documents"), F.sum("doc_id").alias("id_sum"))


# Everyday words with weights, so that every label and ties between themes occur.
_WEIGHED = Lexicon(
    positive={"the": 2, "la": 2, "der": 3, "and": 1, "un": 1}, negative={"of": 1, "de": 2, "in": 2, "le": 3, "that": 1},
    themes={"Punctuality": ["to", "die"], "Pricing": ["is", "el", "und"], "Communication": ["it", "en"]})


@query
def weighed_documents(spark, sf_dir):
    """Weighted sums decide: positive and negative sides, mixed where neither prevails."""
    scored = scoring.lexicon_scorer(_WEIGHED)(_documents(spark, sf_dir))
    return scored.select("doc_id", scoring.sentiment_label().alias("sentiment_label"),
                         scoring.theme_label().alias("complaint_category"))


@query
def scored_with_gaps(spark, sf_dir):
    """All documents beside rows without text, which keep null labels and stay visible."""
    documents = spread(star.table(spark, sf_dir, "documents"), "doc_id").select("lang", F.col("text").alias("review_text"))
    gaps = star.table(spark, sf_dir, "nation").select(F.col("n_name").alias("lang"), F.lit(None).cast("string").alias("review_text"))
    scored = scoring.lexicon_scorer(DOCUMENT_LEXICON)(documents.unionByName(gaps))
    return scored.groupBy("lang", scoring.sentiment_label().alias("sentiment_label")).agg(F.count("*").alias("rows"))


def _is_insult(text: str) -> tuple[str | None, str | None]:
    words = {w for w in re.split("[^a-z]+", text.lower()) if w}
    if not words:
        raise ValueError("no words")
    return ("negative" if words & set(DOCUMENT_LEXICON.negative) else "neutral"), "Other"


@query
def function_scored_documents(spark, sf_dir):
    """A user's function as scorer; it fails on texts without a word."""
    scored = scoring.function_scorer(_is_insult)(_documents(spark, sf_dir))
    return scored.groupBy(scoring.sentiment_label().alias("sentiment_label"),
                          scoring.theme_label().alias("complaint_category")).agg(F.count("*").alias("rows"))


def _labelled(spark, sf_dir) -> DataFrame:
    labels = star.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return _documents(spark, sf_dir).join(labels, "doc_id").withColumn(
        "expected", F.when(F.col("toxic") == 1, "negative").otherwise("neutral"))


@query
def score_agreement(spark, sf_dir):
    scored = scoring.lexicon_scorer(DOCUMENT_LEXICON)(_labelled(spark, sf_dir)).withColumn(
        "predicted", scoring.sentiment_label())
    return reviews.score_agreement(scored, "expected", "predicted")


@query
def model_score_agreement(spark, sf_dir):
    """A classifier trained on half of the labelled documents, scored on the other half."""
    labelled = _labelled(spark, sf_dir).withColumn("held_out", F.crc32(F.col("review_text").cast("binary")) % 2 == 1)
    scorer = scoring.train_scorer(labelled.filter("not held_out"), "expected")
    scored = scorer(labelled.filter("held_out")).withColumn("predicted", scoring.sentiment_label())
    return reviews.score_agreement(scored, "expected", "predicted")


@query
def newest_review_candidates(spark, sf_dir):
    return reviews.backfill_candidates(silver_bookings(spark, sf_dir), 100).select("booking_id", "review_hash")


@query
def arriving_review_candidates(spark, sf_dir):
    return reviews.arriving_candidates(star.typed_bookings(spark, sf_dir)).select("booking_id", "review_hash")


@query
def changed_reviews(spark, sf_dir):
    """Reviewed snapshots whose text the latest state has not scored."""
    stored = stored_star(spark, sf_dir)["reviews"]
    arriving = reviews.arriving_candidates(star.typed_bookings(spark, sf_dir))
    return reviews.changed_reviews(arriving, stored).select("booking_id", "review_hash")


def _insight_view(df: DataFrame) -> DataFrame:
    return plain(df.select("booking_id", "review_hash", "sentiment_label", "complaint_category", "review_summary",
                           "model_source", "processed_at"))


@query
def review_insight_backfill(spark, sf_dir):
    """Backfill over insights of which the odd half holds an older text."""
    latest = silver_bookings(spark, sf_dir)
    scorer = scoring.lexicon_scorer(DOCUMENT_LEXICON)
    known = reviews.backfill_reviews(None, latest.filter("final_amount < 40000"), scorer, "EARLIER", None, stamp(_FIRST))
    stale = known.withColumn("review_hash", F.when(F.col("sentiment_label") == "negative", V.sha256(F.lit("old")))
                             .otherwise(F.col("review_hash")))
    return _insight_view(reviews.backfill_reviews(stale, latest, scorer, "BACKFILL", None, stamp(_SECOND)))


@query
def review_insight_live(spark, sf_dir):
    """Live enrichment on top of the backfill: reviews of any status join it."""
    scorer = scoring.lexicon_scorer(DOCUMENT_LEXICON)
    known = reviews.backfill_reviews(None, silver_bookings(spark, sf_dir), scorer, "BACKFILL", None, stamp(_FIRST))
    return _insight_view(reviews.enrich_new_reviews(
        known, star.typed_bookings(spark, sf_dir), scorer, "LIVE", stamp(_SECOND)))


# ---- reports and gates ---------------------------------------------------


@query
def dimension_counts(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.row_counts({"DIM_DATE": s["dates"], "DIM_CUSTOMER": s["customers"],
                               "DIM_SERVICE": s["services"], "DIM_PROVIDER": s["providers"]})


@query
def layer_reconciliation(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.layer_reconciliation(s["raw"], s["latest"], s["bookings"], s["reviews"])


@query
def review_label_counts(spark, sf_dir):
    return reports.review_label_counts(stored_star(spark, sf_dir)["reviews"])


@query
def overall_health(spark, sf_dir):
    return plain(reports.overall_health(stored_star(spark, sf_dir)["bookings"]))


@query
def baseline_snapshot(spark, sf_dir):
    return plain(reports.baseline_snapshot(stored_star(spark, sf_dir)["bookings"]))


@query
def enrichment_coverage(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.enrichment_coverage(s["latest"], s["reviews"])


@query
def run_history(spark, sf_dir):
    """The audit report over runs played by events: last day, newest first."""
    from tidewell.streaming.audit import recent_runs

    events = star.table(spark, sf_dir, "events")
    runs = events.select(
        F.concat("event_type", F.lit("-"), "event_id").alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").cast("timestamp").alias("started_at"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(mins=F.col("value").cast("int"))).alias("completed_at"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"))
    as_of = runs.agg(F.max("started_at")).scalar()
    return recent_runs(runs, 24, as_of).select("name", "state", "error_message",
                                              F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
                                              F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss").alias("completed_at"))


@query
def last_outcomes(spark, sf_dir):
    """The newest run of each kind, over the same stand-ins."""
    from tidewell.streaming.audit import last_outcomes as newest

    events = star.table(spark, sf_dir, "events")
    runs = events.select(
        F.col("event_type").alias("name"), F.col("props").alias("error_message"), F.col("event_id").alias("input_rows"),
        F.lit(None).cast("string").alias("detail"),
        F.when(F.col("value") > 50, "FAILED").otherwise("SUCCEEDED").alias("state"),
        (F.col("ts").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, event_id / 1000000.0)")).alias("started_at"),
        F.col("ts").cast("timestamp").alias("completed_at"))
    return newest(runs).select("name", "state", "input_rows", "error_message")


@query
def unexpected_counts(spark, sf_dir):
    """Dimensions whose row count is not that of their source; the calendar is expected to be empty."""
    counts = dimension_counts(spark, sf_dir)
    expected = {"DIM_CUSTOMER": star.table(spark, sf_dir, "customer").count(), "DIM_SERVICE": 0, "DIM_NOWHERE": 5}
    return quality.expected_counts(counts, expected)


@query
def quality_gates(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return quality.run_gates(s["latest"], s["bookings"], s["dates"], s["providers"])


@query
def gates_on_broken_tables(spark, sf_dir):
    """Every gate on tables broken on purpose, so that each has violations to count."""
    s = stored_star(spark, sf_dir)
    snapshots = star.typed_bookings(spark, sf_dir, reviews=False)
    minus = lambda c, where: F.when(where, -F.col(c)).otherwise(F.col(c))
    without = lambda c, city: F.when(F.col("booking_city") != city, F.col(c))
    fact = s["bookings"].withColumns({
        "rating": F.col("rating") + 1,
        "service_key": without("service_key", "Nation_1"), "customer_key": without("customer_key", "Nation_3"),
        "provider_key": without("provider_key", "Nation_4"), "booking_date_key": without("booking_date_key", "Nation_5"),
        "discount_amount": minus("discount_amount", F.col("payment_method") == "5-LOW"),
        "final_amount": minus("final_amount", F.col("booking_status") == "CANCELLED"),
        "service_duration_minutes": minus("service_duration_minutes", F.col("payment_method") == "2-HIGH")})
    fact = fact.unionByName(fact.filter("booking_city = 'Nation_2'"))
    dates = s["dates"].filter("year < 1998")
    moved = F.when(F.col("operating_zone") == "Zone 2", F.col("effective_end_at") + F.expr("interval 1 year"))
    emptied = F.when(F.col("operating_zone") == "Zone 3", F.col("effective_start_at"))
    ended = s["providers"].filter("not is_current")
    providers = ended.withColumn("effective_end_at", F.coalesce(emptied, moved, "effective_end_at")).unionByName(
        s["providers"].filter("is_current and operating_zone <> 'Zone 0'"))
    return quality.run_gates(snapshots, fact, dates, providers)


@query
def duplicate_bookings(spark, sf_dir):
    return quality.duplicate_rows(star.typed_bookings(spark, sf_dir, reviews=False), "booking_id")


@query
def current_version_exceptions(spark, sf_dir):
    versions = stored_star(spark, sf_dir)["providers"]
    return quality.current_version_counts(versions.filter("not (is_current and operating_zone = 'Zone 0')"))


@query
def cancellation_by_city(spark, sf_dir):
    return reports.cancellation_by_city(stored_star(spark, sf_dir)["bookings"])


@query
def revenue_and_rating_by_category(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return plain(reports.revenue_and_rating_by_category(s["bookings"], s["services"]))


@query
def category_share(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return plain(reports.category_share(s["bookings"], s["services"]))


@query
def cancellation_by_city_and_category(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.cancellation_by_city_and_category(s["bookings"], s["services"])


@query
def low_ratings_by_city_and_category(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.low_ratings_by_city_and_category(s["bookings"], s["services"])


@query
def tier_advantage(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.tier_advantage(s["bookings"], s["providers"])


@query
def weekend_demand(spark, sf_dir):
    s = stored_star(spark, sf_dir)
    return reports.weekend_demand(s["bookings"], s["dates"])


@query
def negative_themes(spark, sf_dir):
    return reports.negative_themes(stored_star(spark, sf_dir)["reviews"])


@query
def version_change_kinds(spark, sf_dir):
    return reports.version_change_kinds(stored_star(spark, sf_dir)["providers"])


# ---- metrics and questions -----------------------------------------------

ALL_METRICS = [m.name for m in MARKETPLACE.metrics]


def _metrics(spark, sf_dir, metrics, dimensions=(), filters=(), order_by=()) -> DataFrame:
    return plain(semantic_query(stored_star(spark, sf_dir), MARKETPLACE, metrics, dimensions, filters, order_by, True))


@query
def metrics_overall(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS)


@query
def metrics_by_city_and_category(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["booking_city", "service_category"])


@query
def metrics_by_status_and_payment(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["status", "payment type"])


@query
def metrics_by_calendar(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["year", "quarter", "month_name", "day_name", "is_weekend"])


@query
def metrics_by_date(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["booking_date"])


@query
def metrics_by_customer(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["customer_segment", "customer_home_city"])


@query
def metrics_by_provider(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["provider_id", "provider_name", "provider_city"])


@query
def metrics_by_provider_state(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["zone", "tier", "experience_level", "active_status"])


@query
def metrics_by_service(spark, sf_dir):
    return _metrics(spark, sf_dir, ALL_METRICS, ["service_name", "skill_level_required"])


@query
def metrics_by_review(spark, sf_dir):
    """Booking metrics by a review dimension: at most one review per booking."""
    return _metrics(spark, sf_dir, ALL_METRICS, ["sentiment", "complaint_theme"])


@query
def metrics_by_booking(spark, sf_dir):
    return _metrics(spark, sf_dir, ["net_revenue", "average_rating", "enriched_review_count"], ["booking_id"])


@query
def metrics_by_synonym(spark, sf_dir):
    return _metrics(spark, sf_dir, ["GMV", "earnings", "average order value"], ["market", "customer type"],
                    [("job status", "in", ["COMPLETED", "BOOKED"]), ("date", ">=", CUT_OFF)])


@query
def city_volume_and_cancellation(spark, sf_dir):
    return questions.city_volume_and_cancellation(stored_star(spark, sf_dir))


@query
def verified_cancellation_rate_by_city(spark, sf_dir):
    return questions.verified_cancellation_rate_by_city(stored_star(spark, sf_dir))


@query
def verified_revenue_by_category(spark, sf_dir):
    return plain(questions.verified_revenue_by_category(stored_star(spark, sf_dir)))


@query
def revenue_by_city(spark, sf_dir):
    return plain(questions.revenue_by(stored_star(spark, sf_dir), "booking_city"))


@query
def revenue_by_category(spark, sf_dir):
    """From source tables: latest bookings and services only."""
    services = star.service_records(spark, sf_dir).select("service_id", "service_category")
    latest = silver_bookings(spark, sf_dir, reviews=False).join(services, "service_id")
    return plain(latest.groupBy("service_category").agg(F.sum("final_amount").alias("net_revenue"))
                 .orderBy(F.desc("net_revenue")))


@query
def cancellation_trend(spark, sf_dir):
    return questions.cancellation_trend(stored_star(spark, sf_dir))


@query
def tier_and_experience(spark, sf_dir):
    return questions.tier_and_experience(stored_star(spark, sf_dir))


@query
def segments_by_category(spark, sf_dir):
    return questions.segments_by_category(stored_star(spark, sf_dir))


@query
def negative_complaint_themes(spark, sf_dir):
    return questions.negative_complaint_themes(stored_star(spark, sf_dir))


@query
def actual_and_expected_duration(spark, sf_dir):
    return questions.actual_and_expected_duration(stored_star(spark, sf_dir))


@query
def needs_attention(spark, sf_dir):
    return questions.needs_attention(stored_star(spark, sf_dir))


@query
def city_summary(spark, sf_dir):
    return plain(questions.city_summary(stored_star(spark, sf_dir)))


@query
def before_and_after_day(spark, sf_dir):
    return plain(questions.before_and_after(stored_star(spark, sf_dir), CUT_OFF))


@query
def tier_changers(spark, sf_dir):
    return plain(questions.tier_changers(stored_star(spark, sf_dir)))


@query
def completed_only(spark, sf_dir):
    return plain(questions.completed_only(stored_star(spark, sf_dir)))
