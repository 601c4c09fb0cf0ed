from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import booking, customer, provider, raw, service
from tidewell.functions import values as V
from tidewell.operators import clean
from tidewell.operators import refresh
from tidewell.plans import queries
from tidewell.plans.stored import Star, silver_bookings
from tidewell.session import TASK_INPUT, configure
from tidewell.sources import star
from tidewell.sources.records import is_malformed


def cleaned(spark, records, ingested=None):
    return {r.booking_id: r for r in clean.clean_bookings(raw(spark, records, ingested)).collect()}


def test_booking_rules(spark):
    kept = cleaned(spark, [
        {k: v for k, v in booking(booking_id="x").items() if k != "booking_id"},
        booking(booking_id=None),
        booking(booking_id="ok"),
        booking(booking_id="date", booking_created_at="not a date"),
        booking(booking_id="padded", booking_status=" completed "),
        booking(booking_id="status", booking_status="PAUSED"),
        booking(booking_id="negative", final_amount=-0.01),
        booking(booking_id="zero", final_amount=0),
        booking(booking_id="text", final_amount="abc"),
        {k: v for k, v in booking(booking_id="none").items() if k != "final_amount"},
        booking(booking_id="blank", review_text="   "),
        booking(booking_id="half", rating="4.5"),
        booking(booking_id="offset", booking_created_at="2026-01-05T05:30:00+05:30"),
        "{bad",
    ])
    assert set(kept) == {"ok", "padded", "zero", "blank", "half", "offset"}
    assert kept["padded"].booking_status == "COMPLETED"
    assert kept["blank"].review_text is None
    assert kept["half"].rating == 5
    assert str(kept["offset"].booking_created_at) == "2026-01-05 00:00:00"


def test_latest_snapshot(spark):
    early, late = "2026-02-01T00:00:00", "2026-02-02T00:00:00"
    kept = cleaned(spark, [
        booking(booking_id="a", record_updated_at="2026-01-06T00:00:00Z", final_amount=1),
        booking(booking_id="a", record_updated_at="2026-01-07T00:00:00Z", booking_status="PAUSED", final_amount=2),
        booking(booking_id="b", final_amount=1),
        booking(booking_id="b", final_amount=2),
        booking(booking_id="c", final_amount=1),
        booking(booking_id="c", final_amount=2),
        booking(booking_id="d", record_updated_at=None, final_amount=1),
        booking(booking_id="d", final_amount=2),
    ], [early, early, late, early, early, early, late, early])
    assert {k: float(v.final_amount) for k, v in kept.items()} == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_latest_snapshot_does_not_depend_on_order(spark, small):
    snapshots = clean.valid_bookings(star.typed_bookings(spark, small))
    once = clean.latest_bookings(snapshots)
    again = clean.latest_bookings(clean.latest_bookings(snapshots.orderBy(F.rand(3))))
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_rows_are_cut_per_key_before_the_shuffle(spark, small):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    ranked = plan(clean.latest_bookings(clean.valid_bookings(star.typed_bookings(spark, small, reviews=False))))
    whole = plan(silver_bookings(spark, small))
    assert ranked.count("WindowGroupLimit") == whole.count("WindowGroupLimit") == 2
    # Texts are fetched for the winners alone: the ranking reads none, and each table is read once for it.
    assert "documents" not in ranked and whole.count("documents.parquet") == 2 and ranked.count("lineitem.parquet") == 1
    before_shuffle = ranked[ranked.index("hashpartitioning(booking_id"):]
    assert "WindowGroupLimit" in before_shuffle


def test_lines_are_dealt_out_once(spark, small):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        typed, reviewed = plan(star.typed_bookings(spark, small, reviews=False)), plan(star.typed_bookings(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # The line items meet orders that have met their customers; texts come to them, however Spark judges their size.
    assert typed.index("hashpartitioning(l_orderkey") < typed.index("hashpartitioning(o_custkey")
    assert "BroadcastHashJoin" not in typed and "BroadcastHashJoin" in reviewed


def test_large_texts_are_joined_without_a_hint(spark, small, monkeypatch):
    handed = star.typed_bookings(spark, small).select("booking_id", "source_row_number", "review_text")
    monkeypatch.setattr(star, "HANDED_OUT", 0)
    joined = star.typed_bookings(spark, small).select("booking_id", "source_row_number", "review_text")
    assert handed.exceptAll(joined).isEmpty() and joined.exceptAll(handed).isEmpty()


def test_snapshots_without_a_review_stay_where_they_are(spark, small, monkeypatch):
    """Texts too large for all tasks go to the few snapshots that have one; the others are dealt out to their orders alone."""
    handed = star.typed_bookings(spark, small)
    monkeypatch.setattr(star, "HANDED_OUT", 20_000)  # more than the ids of 200 documents take, less than their texts
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.typed_bookings(spark, small)
        without, within = joined._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1].split("hashpartitioning(booking_id", 1)
        assert "LeftAnti" in without and "LeftSemi" not in without and "LeftSemi" in within
        assert handed.exceptAll(joined).isEmpty() and joined.exceptAll(handed).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_arrived_snapshots_are_dealt_out_once(spark, small):
    snapshots = clean.valid_bookings(star.typed_bookings(spark, small, reviews=False))
    early = F.col("record_updated_at") < "1996-01-01"
    latest = refresh.refresh_latest(clean.latest_bookings(snapshots.where(early)), snapshots.where(~early))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Union")] and plan.count("hashpartitioning(booking_id") == 2
    whole = clean.latest_bookings(snapshots)
    assert latest.exceptAll(whole).isEmpty() and whole.exceptAll(latest).isEmpty()
    halves = queries.QUERIES["newest_by_aggregation"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in halves[:halves.index("Union")]


def test_stored_tables_are_made_when_asked_for(spark, small, tmp_path):
    tables = Star(spark, small, str(tmp_path))
    made = lambda: {p.name for p in tmp_path.iterdir()}
    assert not made()
    assert tables["providers"].count() and made() == {"providers"}
    assert tables["bookings"].count() and made() == {"providers", "customers", "services", "latest", "bookings"}
    assert set(tables) == {"raw", "latest", "customers", "services", "providers", "dates", "bookings", "reviews", "kpi"}


def test_parsed_records_equal_typed_ones(spark, small):
    typed = star.typed_bookings(spark, small)
    parsed = clean.parse_bookings(star.raw_bookings(spark, small)).select(*typed.columns)
    assert typed.exceptAll(parsed).isEmpty() and parsed.exceptAll(typed).isEmpty()


def test_provider_rules_and_hash(spark):
    rows = clean.clean_providers(raw(spark, [
        provider(provider_id="ok", primary_city=" pune "), provider(provider_id=None),
        provider(provider_id="when", effective_at="soon"), provider(provider_id="tier", provider_tier="GOLD"),
        provider(provider_id="state", active_status="paused"), provider(provider_id="gap1", operating_zone=None),
        provider(provider_id="gap2", operating_zone=None, primary_city=None),
    ])).collect()
    by_id = {r.provider_id: r for r in rows}
    assert set(by_id) == {"ok", "gap1", "gap2"}
    import hashlib

    plain_text = "Pune|North|STANDARD|EXPERT|ACTIVE|Plumbing"
    assert by_id["ok"].attribute_hash == hashlib.sha256(plain_text.encode()).hexdigest()
    assert len({r.attribute_hash for r in rows}) == 3


def test_live_filter_is_weaker(spark):
    typed = clean.parse_providers(raw(spark, [provider(provider_tier="GOLD"), provider(effective_at=None)]))
    assert clean.applicable_changes(typed).count() == 1 and clean.valid_providers(typed).count() == 0


def test_reference_records(spark):
    rows = clean.clean_customers(raw(spark, [
        customer(customer_segment="new", home_city="navi mumbai"), customer(is_active=None, signup_date="never"),
    ])).collect()
    assert [(r.customer_segment, r.home_city, r.signup_date, r.is_active) for r in rows] == [("NEW", "Pune", None, True)]
    row = clean.clean_services(raw(spark, [service(standard_price="12.345", is_active=False)])).first()
    assert (str(row.standard_price), row.skill_level_required, row.is_active) == ("12.35", "BASIC", False)


@pytest.mark.parametrize("given, wanted", [
    ("new delhi", "New Delhi"), ("new-delhi", "New-Delhi"), ("o'neil", "O'neil"), ("NATION_0", "Nation_0"),
    ("a. b.c", "A. B.C"), ("x\\y[z](q)", "X\\Y[Z](Q)"), ("  two  blanks", "  Two  Blanks"), ("état-majeur", "État-Majeur"),
    ("a\tb", "A\tB"), ("", ""),
])
def test_title_case(spark, given, wanted):
    assert spark.createDataFrame([(given,)], "c string").select(V.title_case(F.col("c"))).first()[0] == wanted


def test_scalars(spark):
    row = spark.sql("select timestamp'2026-01-01 10:00:59' a, timestamp'2026-01-01 10:01:01' b, '4.5' n, '1e30' big").select(
        V.minutes_between(F.col("a"), F.col("b")), V.date_key(F.col("a")), V.to_whole(F.col("n")), V.to_whole(F.col("big")),
        V.ratio(F.lit(1), F.lit(0)), V.rate(F.lit(1), F.lit(3)), V.open_end().cast("string")).first()
    assert tuple(row) == (1, 20260101, 5, None, None, 0.3333, "9999-12-31 00:00:00")


def test_malformed_lines(spark):
    lines = ['{"a":1}', "{bad", '{"a":1} rubbish', '{"a":1},{"b":2}', "", " ", "12", "[1,2]", "null", '{"a":"]"}', '1] x', '{"a":1}], "x": [2',
             '1], "end": 1} {"z": [2', '1], "line": [2']
    rows = spark.createDataFrame([(x,) for x in lines], "p string").select("p", is_malformed(F.col("p")).alias("bad")).collect()
    assert [r.p for r in rows if not r.bad] == ['{"a":1}', "12", "[1,2]", "null", '{"a":"]"}']


def test_not_null_split_names_the_columns(spark):
    typed = clean.parse_providers(raw(spark, [provider(), provider(provider_name=None, experience_level=None)]))
    good, bad = clean.split_not_null(typed, ["provider_name", "experience_level", "effective_at"])
    assert good.count() == 1 and bad.first().missing_columns == ["provider_name", "experience_level"]


def test_booking_faults_are_not_interpreted(spark):
    """All broken rules, in their order; a lambda over them would run outside generated code."""
    typed = spark.createDataFrame([("1", "c", "p", "s", "2025-01-01", "BOOKED", 1), (None, None, "p", "s", None, "PAUSED", -1), ("2", "c", "p", None, "x", None, None)],
                                  "booking_id string, customer_id string, provider_id string, service_id string, booking_created_at string, booking_status string, final_amount int")
    found = typed.select(clean.booking_faults().alias("faults"))
    assert [r.faults for r in found.collect()] == [
        [],
        ["booking_id missing", "customer_id missing", "booking_created_at unreadable", "booking_status unknown", "final_amount unreadable or negative"],
        ["service_id missing", "booking_status unknown", "final_amount unreadable or negative"]]
    assert "lambda" not in found._jdf.queryExecution().toString()


def test_tasks_are_small_unless_the_cluster_says_otherwise(spark):
    before = spark.conf.get(TASK_INPUT, None)
    try:
        spark.conf.unset(TASK_INPUT)
        assert configure(spark).conf.get(TASK_INPUT) == "16m"
        spark.conf.set(TASK_INPUT, "8m")
        assert configure(spark).conf.get(TASK_INPUT) == "8m"
    finally:
        spark.conf.set(TASK_INPUT, before) if before else spark.conf.unset(TASK_INPUT)
