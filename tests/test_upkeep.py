"""Maintained tables against a rebuild, whatever arrives and wherever a run is lost."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import booking, provider, write_lines
from tests.test_streaming import first_load, load
from tidewell.operators import clean, marts
from tidewell.sources import json_lines
from tidewell.streaming import audit, ingest, publish, upkeep
from tidewell.streaming.upkeep import Layout


def table(spark, layout, name):
    return publish.current(spark, layout.table(name))


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rebuilt_kpi(spark, layout):
    return marts.daily_service_kpi(*(table(spark, layout, n) for n in ("fact_booking", "dim_date", "dim_service", "fact_review_insight")))


def random_lines(rng, n):
    out = []
    for _ in range(n):
        done = rng.random() < 0.5
        out.append(booking(
            booking_id=f"B{rng.randrange(12)}", booking_status="COMPLETED" if done else rng.choice(["BOOKED", "CANCELLED"]),
            booking_created_at=f"2026-01-{rng.randrange(5, 9):02d}T00:00:00Z", booking_city=rng.choice(["Pune", "Delhi"]),
            final_amount=rng.choice([100, 250.5, 0]), rating=rng.choice([1, 5, None]) if done else None,
            review_text=rng.choice(["terrible and late", "excellent work", None]), record_updated_at=f"2026-02-{rng.randrange(1, 28):02d}T00:00:00Z"))
    return out


def test_kpi_by_deltas_equals_a_rebuild_after_random_batches(spark, tmp_path, monkeypatch):
    layout, landing, scorer = first_load(spark, tmp_path)
    rng = random.Random(7)
    sums = marts.kpi_sums
    for turn in range(3):
        before = table(spark, layout, "fact_booking").collect()
        write_lines(landing / f"bookings/turn{turn}.json.gz", random_lines(rng, 9))
        load(spark, layout, landing, "bookings")
        for step in (upkeep.bookings_step(spark, layout), upkeep.new_reviews_step(spark, layout, scorer, "LEXICON")):
            ingest.run_available(step)
        number = publish.read_state(spark, layout.table("fact_booking")).number
        upkeep.refresh_fact(spark, layout)
        after = table(spark, layout, "fact_booking").collect()
        changes = upkeep.fact_changes(spark, layout, number, number + 1)
        assert {tuple(r) for r in changes.collect()} == {(*r, -1) for r in set(before) - set(after)} | {(*r, 1) for r in set(after) - set(before)}
        read = []
        monkeypatch.setattr(marts, "kpi_sums", lambda fact, *rest: read.append(fact.count()) or sums(fact, *rest))
        upkeep.refresh_daily_kpi(spark, layout)
        monkeypatch.setattr(marts, "kpi_sums", sums)
        assert same(table(spark, layout, "daily_service_kpi"), rebuilt_kpi(spark, layout))
        rescored = 12
        assert len(read) == 2 and read[0] <= len(set(before) - set(after)) + rescored and read[1] <= len(set(after) - set(before)) + rescored
    latest = clean.clean_bookings(json_lines.raw_table(spark, layout.raw("bookings")))
    assert same(latest, table(spark, layout, "bookings_clean").drop(upkeep.DATE))
    assert not upkeep.refresh_fact(spark, layout) and not upkeep.refresh_daily_kpi(spark, layout)


def test_a_run_lost_between_sums_and_kpi_is_made_good(spark, tmp_path, monkeypatch):
    layout, landing, _ = first_load(spark, tmp_path)
    write_lines(landing / "bookings/more.json.gz", [booking(booking_id="B9"), booking(booking_status="CANCELLED", record_updated_at="2026-05-01T00:00:00Z")])
    load(spark, layout, landing, "bookings")
    ingest.run_available(upkeep.bookings_step(spark, layout))
    upkeep.refresh_fact(spark, layout)
    real = upkeep.publish_parts

    def crash_on_kpi(df, root, *args, **kwargs):
        if root.endswith("daily_service_kpi"):
            raise RuntimeError("lost")
        return real(df, root, *args, **kwargs)

    monkeypatch.setattr(upkeep, "publish_parts", crash_on_kpi)
    with pytest.raises(RuntimeError, match="lost"):
        upkeep.refresh_daily_kpi(spark, layout)
    monkeypatch.setattr(upkeep, "publish_parts", real)
    assert upkeep.refresh_daily_kpi(spark, layout)
    assert same(table(spark, layout, "daily_service_kpi"), rebuilt_kpi(spark, layout))
    # Without the changes that lead to the present state, the sums are made anew.
    write_lines(landing / "bookings/again.json.gz", [booking(booking_id="B8")])
    load(spark, layout, landing, "bookings")
    ingest.run_available(upkeep.bookings_step(spark, layout))
    upkeep.refresh_fact(spark, layout)
    shutil.rmtree(layout.changes("fact_booking"))
    assert upkeep.refresh_daily_kpi(spark, layout)
    assert same(table(spark, layout, "daily_service_kpi"), rebuilt_kpi(spark, layout))


def test_latest_bookings_open_just_their_dates(spark, tmp_path, monkeypatch):
    """A booking that moves to another day leaves its old one; late snapshots change nothing; no table is scanned."""
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    opened = []
    real = upkeep.read_parts
    monkeypatch.setattr(upkeep, "read_parts", lambda spark, root, state, values: opened.append(values) or real(spark, root, state, values))
    monkeypatch.setattr(upkeep, "current", lambda *a: pytest.fail("the whole table was asked for"))
    day = lambda d: f"2026-01-{d:02d}T00:00:00Z"
    steps = [
        ([booking(booking_id=f"B{i}", booking_created_at=day(5 + i)) for i in range(4)], None, {"B0": 5, "B1": 6, "B2": 7, "B3": 8}),
        ([booking(booking_id="B1", booking_created_at=day(20), record_updated_at="2026-06-01T00:00:00Z")], ["20260106", "20260120"], {"B0": 5, "B1": 20, "B2": 7, "B3": 8}),
        ([booking(booking_id="B1", booking_created_at=day(9), record_updated_at="2020-01-01T00:00:00Z"), booking(booking_id="B4", booking_created_at=day(7))],
         ["20260106", "20260107", "20260109", "20260120"], {"B0": 5, "B1": 20, "B2": 7, "B3": 8, "B4": 7}),
    ]
    for turn, (lines, touched, want) in enumerate(steps):
        write_lines(landing / f"bookings/{turn}.json.gz", lines)
        load(spark, layout, landing, "bookings")
        ingest.run_available(upkeep.bookings_step(spark, layout))
        if touched:
            assert opened[-1] == touched
        assert {r.booking_id: r.booking_created_at.day for r in table(spark, layout, "bookings_clean").collect()} == want


def test_provider_events_are_appended_once(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    write_lines(landing / "providers/a.json.gz", [provider(), provider(provider_id="P2", provider_tier="GOLD"), provider(provider_id="P3")])
    assert upkeep.provider_events(spark, layout).count() == 0
    load(spark, layout, landing, "providers")
    for _ in range(2):
        ingest.run_available(upkeep.provider_events_step(spark, layout))
    assert sorted(r.provider_id for r in upkeep.provider_events(spark, layout).collect()) == ["P1", "P3"]
    write_lines(landing / "providers/b.json.gz", [provider(provider_id="P4")])
    load(spark, layout, landing, "providers")
    ingest.run_available(upkeep.provider_events_step(spark, layout))
    events = upkeep.provider_events(spark, layout)
    assert same(events, clean.clean_providers(json_lines.raw_table(spark, layout.raw("providers")))) and events.count() == 3
    # The seed reads the table, and what waits in the stream beside it.
    write_lines(landing / "providers/c.json.gz", [provider(provider_id="P5")])
    load(spark, layout, landing, "providers")
    ingest.run_available(upkeep.provider_seed_step(spark, layout))
    assert sorted(r.provider_id for r in table(spark, layout, "dim_provider").collect()) == ["P1", "P3", "P4", "P5"]


def test_a_provider_batch_writes_the_parts_of_its_providers(spark, tmp_path):
    layout, landing = Layout(str(tmp_path / "lake")), tmp_path / "landing"
    write_lines(landing / "providers/a.json.gz", [provider(provider_id=f"P{i}") for i in range(40)])
    load(spark, layout, landing, "providers")
    ingest.run_available(upkeep.provider_seed_step(spark, layout))
    root, states = layout.table("dim_provider"), []
    states.append(publish.read_state(spark, root))
    for turn, (who, tier) in enumerate([("P7", "PREMIUM"), ("P7", "STANDARD"), ("P8", "PREMIUM"), ("new", "PREMIUM")]):
        write_lines(landing / f"providers/{turn}.json.gz", [provider(provider_id=who, provider_tier=tier, effective_at=f"2026-0{turn + 2}-01T00:00:00Z",
                                                                     record_updated_at=f"2026-0{turn + 2}-01T00:00:00Z")])
        load(spark, layout, landing, "providers")
        ingest.run_available(upkeep.provider_changes_step(spark, layout, every_change=turn == 2))
        states.append(publish.read_state(spark, root))
        changed = publish.changed_parts(states[-2], states[-1])
        assert sum(p.startswith("current-") for p in changed) == 1 and len(changed) == (1 if who == "new" else 2)
    rows = table(spark, layout, "dim_provider")
    assert rows.select("provider_key").distinct().count() == rows.count() == 44
    assert sorted((r.provider_id, r.provider_tier, r.is_current) for r in rows.where("provider_id in ('P7', 'P8', 'new')").collect()) == [
        ("P7", "PREMIUM", False), ("P7", "STANDARD", False), ("P7", "STANDARD", True), ("P8", "PREMIUM", True), ("P8", "STANDARD", False), ("new", "PREMIUM", True)]


def test_the_ledger_knows_what_is_loaded(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "raw")
    write_lines(landing / "a.json.gz", [booking(), "{bad"])
    write_lines(landing / "b.json.gz", [booking()] * 3)
    assert json_lines.ledger(spark, root).count() == 0
    assert json_lines.ingest_batch(spark, str(landing), root, "one", on_error="continue") == {"rows": 5, "rejected": 1}
    rows = lambda: sorted((r.source_filename[-9:], r.load, r.row_count, r.error_count) for r in json_lines.ledger(spark, root).collect())
    want = [("a.json.gz", "one", 1, 1), ("b.json.gz", "one", 3, 0)]
    assert rows() == want
    # A run that is lost after the batch and before its entry: the entry is made up, no file is loaded again.
    shutil.rmtree(f"{root}/_ledger")
    assert json_lines.ingest_batch(spark, str(landing), root, "one") == {"rows": 0, "rejected": 0}
    assert rows() == want and json_lines.raw_table(spark, root).count() == 4
    files = {f.rsplit("/", 1)[0] for f in json_lines.ledger(spark, root).inputFiles()}
    assert all("/_ledger/" in f for f in files)


def test_runs_note_what_they_wrote(spark, tmp_path):
    root = str(tmp_path)
    lines = spark.createDataFrame([("{}", "f", 1), ("{bad", "f", 2)], "payload string, source_filename string, source_row_number bigint").withColumn(
        "ingested_at", F.current_timestamp())
    audit.audited(spark, f"{root}/audit", "some", lambda: json_lines.load_rows(lines, f"{root}/t", "one", "continue"))
    audit.audited(spark, f"{root}/audit", "nothing", lambda: json_lines.load_rows(lines, f"{root}/t", "one", "continue"))
    with pytest.raises(json_lines.RejectedLoad):
        audit.audited(spark, f"{root}/audit", "bad", lambda: json_lines.load_rows(lines, f"{root}/t", "two"))
    got = {r.name: (r.state, r.input_rows, r.detail) for r in audit.read_runs(spark, f"{root}/audit").collect()}
    assert got == {"some": ("SUCCEEDED", 2, '{"rows": 2, "rejected": 1}'), "nothing": ("SUCCEEDED", 0, '{"rows": 0, "rejected": 0}'), "bad": ("FAILED", None, None)}


def test_row_changes_count_repeated_rows(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    after = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (3, "c")], "n int, s string")
    assert sorted(tuple(r) for r in marts.row_changes(before, after).collect()) == [(1, "a", -1), (3, "c", 1), (3, "c", 1)]
    assert marts.row_changes(before, before).isEmpty()
