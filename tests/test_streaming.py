from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import booking, customer, provider, service, write_lines
from tidewell.operators import clean
from tidewell.operators.quality import run_gates
from tidewell.operators.scoring import lexicon_scorer
from tidewell.sources import json_lines, star
from tidewell.streaming import audit, ingest, publish, upkeep
from tidewell.streaming.upkeep import Layout


def load(spark, layout, landing, name):
    writer = ingest.ingest_stream(spark, f"{landing}/{name}", layout.raw(name), layout.checkpoint(f"ingest_{name}"),
                                  f"ingest_{name}")
    return ingest.run_available(writer)


def test_files_load_once_and_malformed_lines_are_set_aside(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    table = layout.raw("bookings")
    lines = [booking(booking_id="B1"), "{bad", booking(booking_id="B2"), '{"a": 1} rubbish']
    write_lines(landing / "bookings/a.json.gz", lines)
    (landing / "bookings/skip.txt").write_text("not taken")
    load(spark, layout, landing, "bookings")
    good, bad = json_lines.raw_table(spark, table), json_lines.rejected_rows(spark, table)
    assert sorted(r.source_row_number for r in good.collect()) == [1, 3]
    assert sorted(r.source_row_number for r in bad.collect()) == [2, 4]

    load(spark, layout, landing, "bookings")
    assert good.count() == json_lines.raw_table(spark, table).count() == 2

    write_lines(landing / "bookings/copy.json.gz", lines)
    load(spark, layout, landing, "bookings")
    assert json_lines.raw_table(spark, table).count() == 4


def test_a_rebuilt_checkpoint_loads_just_the_unseen_files(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    write_lines(landing / "bookings/a.json.gz", [booking(booking_id="B1"), booking(booking_id="B2")])
    load(spark, layout, landing, "bookings")
    write_lines(landing / "bookings/b.json.gz", [booking(booking_id="B3")])
    (tmp_path / "lake/checkpoints").rename(tmp_path / "lost") if (tmp_path / "lake/checkpoints").exists() else None
    fresh = ingest.ingest_stream(spark, f"{landing}/bookings", layout.raw("bookings"), str(tmp_path / "new"), "again")
    ingest.run_available(fresh)
    assert json_lines.raw_table(spark, layout.raw("bookings")).count() == 3


def test_a_load_name_may_come_again(spark, tmp_path):
    landing, table = tmp_path / "customers", str(tmp_path / "raw")
    write_lines(landing / "a.json.gz", [customer()])
    json_lines.ingest_batch(spark, str(landing), table, "one")
    json_lines.ingest_batch(spark, str(landing), table, "one")
    write_lines(landing / "b.json.gz", [customer(customer_id="C2")])
    json_lines.ingest_batch(spark, str(landing), table, "one")
    json_lines.ingest_batch(spark, str(landing), table, "one")
    assert json_lines.raw_table(spark, table).count() == 2
    assert publish.batch_folders(spark, table) == ["one", "one.2"]


def test_a_table_that_moved_on_is_not_overwritten(spark, tmp_path):
    root = str(tmp_path / "t")
    publish.publish(spark.range(1).withColumn("v", F.lit("kept")), root, base=0)
    with pytest.raises(RuntimeError, match="read it again"):
        publish.publish(spark.range(2).withColumn("v", F.lit("late")), root, base=0)
    publish.publish_parts(spark.range(1).select(F.lit("kept").alias("v"), F.lit(1).alias("day")), f"{root}2", "day")
    assert publish.current(spark, f"{root}2").first().v == "kept"


def test_batch_load_is_all_or_nothing(spark, tmp_path):
    landing, table = tmp_path / "customers", str(tmp_path / "raw")
    write_lines(landing / "customers.json.gz", [customer(), "{bad"])
    with pytest.raises(json_lines.RejectedLoad):
        json_lines.ingest_batch(spark, str(landing), table, "first")
    assert not publish.path_exists(spark, f"{table}/batch=first/_SUCCESS")

    json_lines.ingest_batch(spark, str(landing), table, "second", on_error="continue")
    assert json_lines.raw_table(spark, table).count() == 1
    assert json_lines.rejected_rows(spark, table).count() == 1
    json_lines.ingest_batch(spark, str(landing), table, "third", on_error="continue")
    assert json_lines.raw_table(spark, table).count() == 1


def test_row_numbers_count_lines_of_split_and_packed_files(spark, tmp_path):
    for n in (1, 500, 3000):
        write_lines(tmp_path / f"g{n}.json.gz", [str(i + 1) for i in range(n)])
    (tmp_path / "plain.json").write_text("".join(f"{i + 1}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        for glob, total in (("*.json.gz", 3501), ("*.json", 20000)):
            rows = json_lines.read_json_lines(spark, str(tmp_path), glob)
            assert rows.count() == total
            assert rows.filter(F.col("payload").cast("bigint") != F.col("source_row_number")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    listed = json_lines.list_source(spark, str(tmp_path), json_lines.FILE_PATTERN)
    assert listed.count() == 3


def test_published_table_is_whole_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    assert publish.current(spark, root) is None
    assert publish.publish(spark.range(3), root, "w", 0)
    assert not publish.publish(spark.range(9), root, "w", 0)
    assert publish.current(spark, root).count() == 3
    assert publish.publish(spark.range(5), root, "w", 1)
    assert publish.current(spark, root).count() == 5
    assert publish.current(spark, root, 1).count() == 3


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "t")
    publish.publish(spark.range(3), root, "w", 0)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish.publish(broken, root, "w", 1)
    assert publish.current(spark, root).count() == 3
    assert publish.publish(spark.range(4), root, "w", 1)
    assert publish.current(spark, root).count() == 4


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(6).select(F.col("id"), (F.col("id") % 3).cast("int").alias("day"))
    publish.publish_parts(rows, root, "day")
    before = publish.read_state(spark, root)
    publish.publish_parts(rows.filter("day = 1").limit(0), root, "day", [1])
    publish.publish_parts(spark.range(7, 8).select("id", F.lit(4).alias("day")), root, "day", [4, 5])
    after = publish.read_state(spark, root)
    assert sorted((r.id, r.day) for r in publish.current(spark, root).collect()) == [(0, 0), (2, 2), (3, 0), (5, 2), (7, 4)]
    assert publish.changed_parts(before, after) == ["1", "4"]
    with pytest.raises(ValueError, match="outside"):
        publish.publish_parts(rows, root, "day", [1])


def test_old_states_are_forgotten_but_not_data_in_use(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("day"))
    publish.publish_parts(rows, root, "day")
    for n in range(3):
        publish.publish_parts(spark.range(n, n + 1).select("id", F.lit(1).alias("day")), root, "day", [1])
    assert publish.forget_old_states(spark, root, keep=1) == 2
    assert sorted((r.id, r.day) for r in publish.current(spark, root).collect()) == [(0, 0), (2, 0), (2, 1)]
    assert publish.forget_old_states(spark, root, keep=1) == 0


def test_records_written_as_files_come_back_the_same(spark, small, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    star.write_json_lines(star.raw_bookings(spark, small), str(landing / "bookings"))
    writer = ingest.ingest_stream(spark, f"{landing}/bookings", layout.raw("bookings"), layout.checkpoint("in"), "in",
                                  glob="*.txt.gz", files_per_batch=3)
    ingest.run_available(writer)
    raw = json_lines.raw_table(spark, layout.raw("bookings"))
    assert raw.select("source_filename", "source_row_number").distinct().count() == raw.count() == 6000
    variant = json_lines.as_variant(raw).selectExpr("count(distinct try_variant_get(payload, '$.booking_id', 'string')) n")
    assert variant.first().n == 4599
    typed = clean.valid_bookings(star.typed_bookings(spark, small)).drop("source_filename", "source_row_number", "ingested_at")
    back = clean.valid_bookings(clean.parse_bookings(raw)).select(*typed.columns)
    assert typed.exceptAll(back).isEmpty() and back.exceptAll(typed).isEmpty()


def test_defaults_fill_only_what_is_missing(spark):
    moment = F.lit("2026-01-01").cast("timestamp")
    rows = spark.sql("select 1 n, timestamp'2025-01-01' created_at union all select 2, null")
    got = clean.with_defaults(rows, ["created_at", "updated_at"], moment).orderBy("n").collect()
    assert [(r.created_at.year, r.updated_at.year) for r in got] == [(2025, 2026), (2026, 2026)]


def first_load(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    write_lines(landing / "customers/customers.json.gz", [customer(), customer(customer_id="C2")])
    write_lines(landing / "services/services.json.gz", [service()])
    write_lines(landing / "providers/initial.json.gz", [provider(), provider(provider_id="P2")])
    done = dict(booking_status="COMPLETED", rating=2, service_started_at="2026-01-06T10:00:59Z",
                service_completed_at="2026-01-06T10:01:01Z")
    write_lines(landing / "bookings/first.json.gz", [
        booking(), booking(booking_id="B2", review_text="The provider arrived very late", **done),
        booking(booking_id="B3", booking_created_at="2026-03-01T00:00:00Z", customer_id="C9"),
    ])
    for name in ("customers", "services"):
        json_lines.ingest_batch(spark, f"{landing}/{name}", layout.raw(name), "first")
    for name in ("providers", "bookings"):
        load(spark, layout, landing, name)
    scorer = lexicon_scorer()
    upkeep.refresh_calendar(spark, layout)
    upkeep.refresh_type1(spark, layout)
    ingest.run_available(upkeep.bookings_step(spark, layout))
    ingest.run_available(upkeep.provider_seed_step(spark, layout))
    ingest.run_available(upkeep.review_baseline_step(spark, layout))
    upkeep.backfill_step(spark, layout, scorer, "LEXICON")
    upkeep.refresh_fact(spark, layout)
    upkeep.refresh_daily_kpi(spark, layout)
    return layout, landing, scorer


def snapshot(spark, layout, name, *columns):
    return sorted(tuple(str(v) for v in r) for r in publish.current(spark, layout.table(name)).select(*columns).collect())


def test_tables_follow_the_files(spark, tmp_path):
    layout, landing, scorer = first_load(spark, tmp_path)
    assert snapshot(spark, layout, "fact_booking", "booking_id", "customer_key", "service_duration_minutes") == [
        ("B1", snapshot(spark, layout, "fact_booking", "customer_key")[0][0], "None"),
        ("B2", snapshot(spark, layout, "fact_booking", "customer_key")[0][0], "1"), ("B3", "None", "None")]
    assert snapshot(spark, layout, "fact_review_insight", "booking_id", "sentiment_label") == [("B2", "negative")]
    untouched = publish.read_state(spark, layout.table("fact_booking")).parts["20260105"]

    write_lines(landing / "providers/changes.json.gz", [
        provider(provider_tier="PREMIUM", effective_at="2026-02-01T00:00:00Z", record_updated_at="2026-02-01T00:00:00Z"),
        provider(provider_id="P2", provider_name="renamed", effective_at="2026-02-01T00:00:00Z"),
        provider(provider_id="P3", experience_level=None),
    ])
    write_lines(landing / "bookings/live.json.gz", [
        booking(booking_id="B4", review_text="Excellent, exceeded expectations", booking_created_at="2026-03-02T00:00:00Z"),
        booking(booking_id="B3", booking_created_at="2026-03-01T00:00:00Z", customer_id="C9", booking_status="CANCELLED",
                record_updated_at="2026-04-01T00:00:00Z"),
    ])
    write_lines(landing / "customers/more/customers.json.gz", [customer(customer_id="C9")])
    for name in ("providers", "bookings"):
        load(spark, layout, landing, name)
    json_lines.ingest_batch(spark, f"{landing}/customers", layout.raw("customers"), "second")
    upkeep.refresh_all(spark, layout, scorer, "LEXICON")

    versions = snapshot(spark, layout, "dim_provider", "provider_id", "provider_tier", "is_current")
    assert versions == [("P1", "PREMIUM", "True"), ("P1", "STANDARD", "False"), ("P2", "STANDARD", "True")]
    assert spark.read.parquet(layout.quarantine("provider_changes")).count() == 1
    keyed = publish.current(spark, layout.table("fact_booking")).join(
        publish.current(spark, layout.table("dim_provider")), "provider_key")
    assert sorted((r.booking_id, r.provider_tier) for r in keyed.collect()) == [
        ("B1", "STANDARD"), ("B2", "STANDARD"), ("B3", "PREMIUM"), ("B4", "PREMIUM")]
    assert snapshot(spark, layout, "fact_review_insight", "booking_id", "sentiment_label") == [
        ("B2", "negative"), ("B4", "positive")]
    kpi = publish.current(spark, layout.table("daily_service_kpi"))
    assert {str(r.booking_date): (r.total_bookings, r.cancelled_bookings, r.enriched_review_count, r.negative_review_count)
            for r in kpi.collect()} == {
        "2026-01-05": (2, 0, 1, 1), "2026-03-01": (1, 1, 0, 0), "2026-03-02": (1, 0, 1, 0)}
    # The January partition was not written again: nothing about it changed.
    assert publish.read_state(spark, layout.table("fact_booking")).parts["20260105"] == untouched
    gates = run_gates(publish.current(spark, layout.table("bookings_clean")), publish.current(spark, layout.table("fact_booking")),
                      publish.current(spark, layout.table("dim_date")), publish.current(spark, layout.table("dim_provider")))
    assert {r.check_name: r.violations for r in gates.collect() if r.violations} == {}
    runs = audit.recent_runs(audit.read_runs(spark, layout.audit))
    assert {(r.name, r.state) for r in runs.collect()} >= {("fact_booking", "SUCCEEDED"), ("provider_changes", "SUCCEEDED")}
    assert audit.last_outcomes(audit.read_runs(spark, layout.audit)).filter("state = 'SUCCEEDED'").count() == 7

    states = {n: publish.read_state(spark, layout.table(n)).number for n in (
        "bookings_clean", "dim_provider", "fact_review_insight", "dim_customer", "dim_service", "dim_date", "fact_booking", "daily_service_kpi", "daily_service_sums")}
    files = sorted(str(f) for f in (tmp_path / "lake/tables").rglob("*"))
    for name in ("providers", "bookings"):
        load(spark, layout, landing, name)
    upkeep.refresh_all(spark, layout, scorer, "LEXICON")
    assert states == {n: publish.read_state(spark, layout.table(n)).number for n in states}
    upkeep.refresh_calendar(spark, layout)
    assert files == sorted(str(f) for f in (tmp_path / "lake/tables").rglob("*"))


def test_batch_that_fails_is_applied_once_when_run_again(spark, tmp_path, monkeypatch):
    layout, landing, _ = first_load(spark, tmp_path)
    write_lines(landing / "providers/changes.json.gz", [
        provider(provider_tier="PREMIUM", effective_at="2026-02-01T00:00:00Z", record_updated_at="2026-02-01T00:00:00Z")])
    load(spark, layout, landing, "providers")
    real = upkeep.publish_parts

    def crash_after_publish(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(upkeep, "publish_parts", crash_after_publish)
    with pytest.raises(Exception, match="lost after the write"):
        ingest.run_available(upkeep.provider_changes_step(spark, layout))
    monkeypatch.setattr(upkeep, "publish_parts", real)
    number = publish.read_state(spark, layout.table("dim_provider")).number
    ingest.run_available(upkeep.provider_changes_step(spark, layout))
    assert publish.read_state(spark, layout.table("dim_provider")).number == number
    assert snapshot(spark, layout, "dim_provider", "provider_id", "provider_tier", "is_current") == [
        ("P1", "PREMIUM", "True"), ("P1", "STANDARD", "False"), ("P2", "STANDARD", "True")]


def test_stream_progress_reaches_the_audit_table(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    write_lines(landing / "bookings/a.json.gz", [booking()])
    listener = audit.StreamAudit(spark, layout.audit)
    spark.streams.addListener(listener)
    try:
        load(spark, layout, landing, "bookings")
        for _ in range(60):
            if publish.path_exists(spark, layout.audit):
                if audit.read_runs(spark, layout.audit).filter("state = 'FINISHED'").count():
                    break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    names = {(r.name, r.state) for r in audit.read_runs(spark, layout.audit).collect()}
    assert {("ingest_bookings", "RUNNING"), ("ingest_bookings", "FINISHED")} <= names
