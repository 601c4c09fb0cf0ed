"""Keeping the tables current, batch by batch.

Each step is a micro-batch over a raw table, or a refresh that finds out what changed by
comparing table states. Bookings, insights, fact and KPI are cut by booking date and
only touched dates are written again.

* Latest bookings: a streaming aggregation keeps, per booking, its newest valid snapshot and
  the dates it has had, so a micro-batch looks up its own bookings in Spark's state store and
  knows the dates to open; no key of the table is scanned.
* Valid provider events: a stateless stream appends them through Spark's own file sink.
* Fact: rows that differ between two states are written beside it as changes.
* KPI: kept as sums per (day, city, category). A refresh subtracts the changed bookings as they
  were and adds them as they are; bookings that did not change are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.values import date_key
from tidewell.operators import clean, dims, marts, refresh, reviews, scd2
from tidewell.operators.scoring import Scorer
from tidewell.sources.json_lines import raw_table
from tidewell.sources.records import RAW_SCHEMA
from tidewell.streaming import ingest
from tidewell.streaming.audit import audited
from tidewell.streaming.publish import (
    State, batch_folders, changed_parts, current, int_values, path_exists, publish, publish_parts, read_parts, read_state,
    state_kept, write_once,
)

DATE = "booking_date_key"


@dataclass(frozen=True)
class Layout:
    """Where everything lives under one root."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def staged(self, name: str) -> str:
        return f"{self.root}/staged/{name}"

    def changes(self, name: str) -> str:
        return f"{self.root}/changes/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"


def _dated(bookings: DataFrame) -> DataFrame:
    return bookings.withColumn(DATE, F.coalesce(date_key(F.col("booking_created_at")), F.lit(0)))


def _touched(table: DataFrame, arrived: DataFrame) -> list[int]:
    """Dates where the arrived bookings are now stored, and where they belong."""
    old = table.select("booking_id", DATE).join(arrived.select("booking_id"), "booking_id", "left_semi")
    return int_values(old.select(DATE).unionByName(arrived.select(DATE)), DATE)


# ---- latest bookings -----------------------------------------------------


def newest_snapshots(valid: DataFrame) -> DataFrame:
    """(booking_id, newest, dates) of a stream of valid snapshots: the row that `latest_bookings`
    would keep, and every date key the booking has been under.

    An aggregation, so each task first cuts its snapshots to one per booking; what a stream
    keeps for a booking is its newest snapshot. Null times never win, as nulls come first.
    """
    dated = _dated(valid)
    order = ["record_updated_at", "ingested_at", "source_row_number", "source_filename"]
    rest = [c for c in dated.columns if c not in ("booking_id", *order)]
    return dated.groupBy("booking_id").agg(F.max(F.struct(*order, *rest)).alias("newest"), F.collect_set(DATE).alias("dates"))


def bookings_step(spark: SparkSession, layout: Layout) -> ingest.DataStreamWriter:
    """Raw booking changes into the latest-state table."""
    root, name = layout.table("bookings_clean"), "bookings_clean"

    def handle(changed: DataFrame, batch_id: int) -> None:
        writer = ingest.writer_id(spark, layout.checkpoint(name), name)
        held = changed.persist()
        try:
            columns = _dated(clean.parse_bookings(spark.createDataFrame([], RAW_SCHEMA))).columns
            arrived = held.select("booking_id", "newest.*").select(*columns)
            state = read_state(spark, root)
            if state is None:
                publish_parts(arrived, root, DATE, None, writer, batch_id, base=0)
            else:
                touched = int_values(held.select(F.explode("dates").alias(DATE)), DATE)
                stored = read_parts(spark, root, state, [str(t) for t in touched])
                kept = stored.join(arrived.select("booking_id"), "booking_id", "left_anti").select(*columns)
                publish_parts(kept.unionByName(arrived), root, DATE, touched, writer, batch_id, base=state.number)
        finally:
            held.unpersist()

    valid = clean.valid_bookings(clean.parse_bookings(ingest.raw_changes(spark, layout.raw("bookings"))))
    return ingest.batches(newest_snapshots(valid), name, layout.checkpoint(name), handle).outputMode("update")


# ---- provider events -----------------------------------------------------


def provider_events_step(spark: SparkSession, layout: Layout) -> ingest.DataStreamWriter:
    """Valid provider events, typed and hashed, appended to a table by Spark's file sink, each once."""
    name = "provider_changes_clean"
    events = clean.clean_providers(ingest.raw_changes(spark, layout.raw("providers")))
    return (events.writeStream.queryName(name).format("parquet").outputMode("append").option("path", layout.table(name))
            .option("checkpointLocation", layout.checkpoint(name)))


def provider_events(spark: SparkSession, layout: Layout) -> DataFrame:
    """The events table; what an unfinished batch of the sink has written is not in it."""
    empty = clean.clean_providers(spark.createDataFrame([], RAW_SCHEMA))
    root = layout.table("provider_changes_clean")
    return spark.read.schema(empty.schema).parquet(root) if path_exists(spark, root) else empty


# ---- provider dimension --------------------------------------------------


#: Current versions lie in so many parts, by a hash of the provider.
CURRENT_PARTS = 64


def _parted(versions: DataFrame, number: int) -> DataFrame:
    """Adds `part`: current versions by provider, closed ones by the state that closed them, which no later state writes again."""
    bucket = F.pmod(F.xxhash64("provider_id"), F.lit(CURRENT_PARTS)).cast("string")
    return versions.withColumn("part", F.when(F.col("is_current"), F.concat(F.lit("current-"), bucket)).otherwise(_closed_part(number)))


def _closed_part(number: int) -> str:
    return f"closed-{number:012d}"


def _provider_batches(spark: SparkSession, layout: Layout, handle: ingest.Handler) -> ingest.DataStreamWriter:
    source = ingest.raw_changes(spark, layout.raw("providers"))
    return ingest.batches(source, "provider_changes", layout.checkpoint("provider_changes"), handle)


def _quarantined(spark: SparkSession, layout: Layout, typed: DataFrame, writer: str, batch_id: int) -> DataFrame:
    """The rows of a batch that have every required column. The batch is parsed and written once, cut by
    whether they do; good rows and the quarantine are both read from there."""
    marked = clean.marked_missing(typed, dims.PROVIDER_REQUIRED)
    name = f"{writer.partition(':')[2]}-{batch_id:012d}"
    complete = F.when(F.size("missing_columns") == 0, "yes").otherwise("no")
    write_once(marked.withColumn("complete", complete), layout.staged("provider_changes"), name, ("complete",))
    path = f"{layout.staged('provider_changes')}/batch={name}/complete="
    read = lambda verdict: spark.read.schema(marked.schema).parquet(f"{path}{verdict}") if path_exists(spark, f"{path}{verdict}") else (
        spark.createDataFrame([], marked.schema))
    write_once(read("no"), layout.quarantine("provider_changes"), name)
    return read("yes").drop("missing_columns")


def provider_seed_step(spark: SparkSession, layout: Layout) -> ingest.DataStreamWriter:
    """First run of the provider stream: the events table, and what waits, seed the dimension.

    The seed and the later changes share one checkpoint, so no event falls between
    them and none of the baseline comes again as a change. An event that both hold counts
    once: a seed takes the earliest state of a provider.
    """
    root = layout.table("dim_provider")

    def handle(raw: DataFrame, batch_id: int) -> None:
        waiting = clean.clean_providers(raw).unionByName(provider_events(spark, layout)).distinct()
        writer = ingest.writer_id(spark, layout.checkpoint("provider_changes"), "provider_changes")
        good = _quarantined(spark, layout, waiting, writer, batch_id)
        old, known = read_state(spark, root), current(spark, root)
        seeded = scd2.scd2_seed(good, known.select(*scd2.VERSION_COLUMNS) if known is not None else None)
        number = old.number if old else 0
        publish_parts(_parted(seeded, number + 1), root, "part", None, writer, batch_id, base=number)

    return _provider_batches(spark, layout, handle)


def provider_changes_step(spark: SparkSession, layout: Layout, every_change: bool = False) -> ingest.DataStreamWriter:
    """Later runs: close and open versions. `every_change` applies all changes of a
    provider in a batch in order, not just the newest.

    Of the dimension only the parts with current versions of the batch's providers are read and
    written; versions that the batch closes are added as a part of their own.
    """
    root = layout.table("dim_provider")
    apply = scd2.scd2_apply_all if every_change else scd2.scd2_apply

    def handle(raw: DataFrame, batch_id: int) -> None:
        typed = clean.applicable_changes(clean.parse_providers(raw))
        writer = ingest.writer_id(spark, layout.checkpoint("provider_changes"), "provider_changes")
        good = _quarantined(spark, layout, typed, writer, batch_id)
        old, known = read_state(spark, root), current(spark, root).select(*scd2.VERSION_COLUMNS)
        reached = _parted(good.withColumn("is_current", F.lit(True)), 0).select("part").distinct()
        touched = sorted(r.part for r in reached.collect())  # CURRENT_PARTS names at most
        stored = read_parts(spark, root, old, touched).select(*scd2.VERSION_COLUMNS)
        publish_parts(_parted(apply(stored, good, existing=known), old.number + 1), root, "part", [*touched, _closed_part(old.number + 1)],
                      writer, batch_id, base=old.number)

    return _provider_batches(spark, layout, handle)


# ---- review insights -----------------------------------------------------


def _store_insights(spark: SparkSession, layout: Layout, dated: DataFrame, scorer: Scorer, model_source: str,
                    writer: str | None = None, batch_id: int | None = None) -> None:
    """Score what is new in `dated` candidates and upsert it by date."""
    root = layout.table("fact_review_insight")
    state = read_state(spark, root)
    existing = current(spark, root, state.number) if state else None
    changed = reviews.changed_reviews(dated, existing)
    scored = reviews.score_reviews(changed, scorer, model_source).join(dated.select("booking_id", DATE), "booking_id")
    if existing is None:
        publish_parts(scored, root, DATE, None, writer, batch_id, base=0)
        return
    fresh = scored.persist()
    try:
        touched = _touched(existing, fresh)
        stored = read_parts(spark, root, state, [str(t) for t in touched])
        merged = reviews.upsert_reviews(stored, fresh, [*reviews.INSIGHT_COLUMNS, DATE])
        publish_parts(merged, root, DATE, touched, writer, batch_id, base=state.number)
    finally:
        fresh.unpersist()


def _review_batches(spark: SparkSession, layout: Layout, handle: ingest.Handler) -> ingest.DataStreamWriter:
    source = ingest.raw_changes(spark, layout.raw("bookings"))
    return ingest.batches(source, "new_reviews", layout.checkpoint("new_reviews"), handle)


def review_baseline_step(spark: SparkSession, layout: Layout) -> ingest.DataStreamWriter:
    """First run of the review stream: what waits is left to the backfill."""
    return _review_batches(spark, layout, lambda raw, batch_id: None)


def backfill_step(spark: SparkSession, layout: Layout, scorer: Scorer, model_source: str,
                  limit: int | None = None) -> None:
    latest = current(spark, layout.table("bookings_clean"))
    candidates = reviews.backfill_candidates(latest, limit).join(latest.select("booking_id", DATE), "booking_id")
    _store_insights(spark, layout, candidates, scorer, model_source)


def new_reviews_step(spark: SparkSession, layout: Layout, scorer: Scorer, model_source: str) -> ingest.DataStreamWriter:
    """Later runs: score reviews that arrive, whatever the booking's status."""

    def handle(raw: DataFrame, batch_id: int) -> None:
        snapshots = clean.parse_bookings(raw)
        candidates = reviews.arriving_candidates(snapshots, keep=["booking_created_at"])
        _store_insights(spark, layout, _dated(candidates).drop("booking_created_at"), scorer, model_source,
                        ingest.writer_id(spark, layout.checkpoint("new_reviews"), "new_reviews"), batch_id)

    return _review_batches(spark, layout, handle)


# ---- dimensions, fact, KPI -----------------------------------------------


def refresh_type1(spark: SparkSession, layout: Layout) -> None:
    """Merge the raw records into the Type 1 dimensions; without a new load nothing is written."""
    for raw, table, parse, merge, required in (
        ("customers", "dim_customer", clean.clean_customers, dims.merge_customers, dims.CUSTOMER_REQUIRED),
        ("services", "dim_service", clean.clean_services, dims.merge_services, dims.SERVICE_REQUIRED),
    ):
        if path_exists(spark, layout.raw(raw)):
            loads, old = {"loads": len(batch_folders(spark, layout.raw(raw)))}, read_state(spark, layout.table(table))
            if old is not None and old.built_from == loads:
                continue
            good, bad = clean.split_not_null(parse(raw_table(spark, layout.raw(raw))), required)
            bad.write.mode("overwrite").parquet(layout.quarantine(raw))
            publish(merge(current(spark, layout.table(table)), good), layout.table(table), built_from=loads,
                    base=old.number if old else 0)


def refresh_calendar(spark: SparkSession, layout: Layout, start: str = dims.CALENDAR_START,
                     end: str = dims.CALENDAR_END) -> None:
    root = layout.table("dim_date")
    state = read_state(spark, root)
    known = current(spark, root, state.number) if state else None
    if known is None or not dims.build_dim_date(spark, start, end).join(known, "date_key", "left_anti").isEmpty():
        publish(dims.build_dim_date(spark, start, end, known).coalesce(1), root, base=state.number if state else 0)


def refresh_fact(spark: SparkSession, layout: Layout) -> bool:
    """Rebuild the fact for dates whose bookings, or whose keys, have changed."""
    sources = ("bookings_clean", "dim_customer", "dim_service", "dim_provider")
    states = {n: read_state(spark, layout.table(n)) for n in sources}
    numbers = {n: s.number for n, s in states.items()}
    root = layout.table("fact_booking")
    old = read_state(spark, root)
    if old is not None and old.built_from == numbers:
        return False

    now = {n: current(spark, layout.table(n)) for n in sources}
    latest = now["bookings_clean"]
    touched = None
    # Without the states it was built from, the fact is rebuilt whole.
    if old is not None and all(state_kept(spark, layout.table(n), old.built_from[n]) for n in sources):
        was = old.built_from
        before = read_state(spark, layout.table("bookings_clean"), was["bookings_clean"])
        dates = {int(v) for v in changed_parts(before, states["bookings_clean"])}
        for name, natural in (("dim_customer", "customer_id"), ("dim_service", "service_id")):
            if was[name] != numbers[name]:
                known = current(spark, layout.table(name), was[name]).select(natural)
                added = now[name].select(natural).join(known, natural, "left_anti")
                dates.update(int_values(latest.join(added, natural, "left_semi"), DATE))
        if was["dim_provider"] != numbers["dim_provider"]:
            previous = current(spark, layout.table("dim_provider"), was["dim_provider"])
            dates.update(int_values(refresh.rekeyed_bookings(latest, previous, now["dim_provider"]), DATE))
        touched = sorted(dates)
        latest = read_parts(spark, layout.table("bookings_clean"), states["bookings_clean"], [str(t) for t in touched])
    fact = marts.build_fact_booking(latest, now["dim_customer"], now["dim_service"], now["dim_provider"])
    if touched is not None:
        # Written before the state that they lead to is published; a run that is lost in between writes them anew.
        before = read_parts(spark, root, old, [str(t) for t in touched])
        changes = marts.row_changes(before, fact.select(*before.columns))
        changes.write.mode("overwrite").parquet(f"{layout.changes('fact_booking')}/state={old.number + 1}")
    return publish_parts(fact, root, DATE, touched, built_from=numbers, base=old.number if old else 0)


def fact_changes(spark: SparkSession, layout: Layout, since: int, until: int) -> DataFrame | None:
    """Rows that the fact lost (`change` -1) and gained (1) between two of its states; None if not all are known."""
    paths = [f"{layout.changes('fact_booking')}/state={n}" for n in range(since + 1, until + 1)]
    if not all(path_exists(spark, f"{p}/_SUCCESS") for p in paths):
        return None
    fact = current(spark, layout.table("fact_booking"))
    schema = fact.withColumn("change", F.lit(0)).schema
    changes = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    # A row that went and came back within these states is no change.
    net = changes.groupBy(*fact.columns).agg(F.sum("change").alias("net")).where("net <> 0")
    return net.select(*fact.columns, F.col("net").cast("int").alias("change"))


def refresh_daily_kpi(spark: SparkSession, layout: Layout) -> bool:
    """Bring the KPI up to date by the bookings and review insights that have changed."""
    sources = ("fact_booking", "fact_review_insight", "dim_service", "dim_date")
    states = {n: read_state(spark, layout.table(n)) for n in sources}
    numbers = {n: s.number for n, s in states.items()}
    root, sums_root = layout.table("daily_service_kpi"), layout.table("daily_service_sums")
    old, sums = read_state(spark, root), read_state(spark, sums_root)
    if old is not None and old.built_from == numbers:
        return False

    now = {n: current(spark, layout.table(n)) for n in sources}
    dimensions = (now["dim_date"], now["dim_service"])
    touched, changes = None, None
    if sums is not None and sums.built_from != numbers and all(sums.built_from[n] == numbers[n] for n in ("dim_service", "dim_date")) and state_kept(
            spark, layout.table("fact_review_insight"), sums.built_from["fact_review_insight"]):
        changes = fact_changes(spark, layout, sums.built_from["fact_booking"], numbers["fact_booking"])
    if sums is not None and sums.built_from == numbers:  # the sums are there, only what is told from them is not
        new = current(spark, sums_root)
    elif changes is None:
        new = marts.kpi_sums(now["fact_booking"], *dimensions, now["fact_review_insight"])
        publish_parts(new, sums_root, DATE, None, built_from=numbers, base=sums.number if sums else 0)
        new = current(spark, sums_root)
    else:
        insight = now["fact_review_insight"]
        insight_before = current(spark, layout.table("fact_review_insight"), sums.built_from["fact_review_insight"])
        rescored = _rescored(spark, layout, sums.built_from["fact_review_insight"], states["fact_review_insight"])
        changed = changes.persist()
        try:
            # Bookings whose insight alone changed, as they are. Their dates are those their insights lie under, or any.
            same = now["fact_booking"].join(rescored, "booking_id", "left_semi").join(
                changed.select("booking_id"), "booking_id", "left_anti").select(*now["fact_booking"].columns)
            sides = {sign: changed.where(F.col("change") * sign > 0).drop("change").unionByName(same) for sign in (-1, 1)}
            gone = marts.kpi_sums(sides[-1], *dimensions, insight_before)
            came = marts.kpi_sums(sides[1], *dimensions, insight)
            touched = int_values(gone.select(DATE).unionByName(came.select(DATE)), DATE)
            stored = read_parts(spark, sums_root, sums, [str(t) for t in touched])
            publish_parts(marts.apply_deltas(stored, gone, came), sums_root, DATE, touched, built_from=numbers, base=sums.number)
        finally:
            changed.unpersist()
        new = read_parts(spark, sums_root, read_state(spark, sums_root), [str(t) for t in touched])
        if old is None or {n: v for n, v in old.built_from.items()} != sums.built_from:
            new, touched = current(spark, sums_root), None  # a run was lost between both tables
    return publish_parts(marts.kpi_of(new), root, DATE, touched, built_from=numbers, base=old.number if old else 0)


def _rescored(spark: SparkSession, layout: Layout, before: int, after: State) -> DataFrame:
    """Bookings whose sentiment differs between two states of the insights; only changed partitions are read."""
    root = layout.table("fact_review_insight")
    was = read_state(spark, root, before)
    parts = changed_parts(was, after)
    rows = lambda state: read_parts(spark, root, state, parts).select("booking_id", "sentiment_label")
    return marts.row_changes(rows(was), rows(after)).select("booking_id").distinct()


def refresh_all(spark: SparkSession, layout: Layout, scorer: Scorer, model_source: str) -> None:
    """Everything that depends on the raw tables, in dependency order."""
    steps = {
        "bookings_clean": lambda: ingest.run_available(bookings_step(spark, layout)),
        "type1_dimensions": lambda: refresh_type1(spark, layout),
        "provider_changes_clean": lambda: ingest.run_available(provider_events_step(spark, layout)),
        "provider_changes": lambda: ingest.run_available(provider_changes_step(spark, layout)),
        "new_reviews": lambda: ingest.run_available(new_reviews_step(spark, layout, scorer, model_source)),
        "fact_booking": lambda: refresh_fact(spark, layout),
        "daily_service_kpi": lambda: refresh_daily_kpi(spark, layout),
    }
    for name, run in steps.items():
        audited(spark, layout.audit, name, run)


def star_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The published star under the names of the metric model."""
    names = {"bookings": "fact_booking", "dates": "dim_date", "customers": "dim_customer",
             "providers": "dim_provider", "services": "dim_service", "reviews": "fact_review_insight"}
    return {entity: current(spark, layout.table(table)) for entity, table in names.items()}
