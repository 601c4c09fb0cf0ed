from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, booking, raw
from tidewell.functions.lexicon import Lexicon
from tidewell.operators import clean, marts, quality, refresh, reviews, scoring
from tidewell.plans import questions
from tidewell.plans.model import MARKETPLACE
from tidewell.plans.semantic import semantic_query
from tidewell.plans.stored import Star, read, write


def time_of(text):
    return F.lit(at(text))



def label(spark, *texts, scorer=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, review_text string")
    rows = (scorer or scoring.lexicon_scorer())(df).select("n", scoring.sentiment_label(), scoring.theme_label()).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_lexicon_labels(spark):
    assert label(spark, "The provider arrived very late", "Excellent, polite and skilled", "Good work but expensive price", "Hmm", None) == [
        ("negative", "Punctuality"), ("positive", "Professionalism"), ("mixed", "Pricing"),
        ("neutral", "No Complaint"), (None, None)]


def test_lexicon_reads_whole_texts(spark):
    assert label(spark, "filler " * 50000 + "LATE!")[0] == ("negative", "Punctuality")


def test_lexicon_is_checked():
    with pytest.raises(ValueError):
        Lexicon(themes={"Nothing": ["x"]})


def test_the_heavier_side_prevails(spark):
    assert [s for s, _ in label(spark, "excellent amazing wonderful but another", "great, late", "late and good, terrible, rude")] == [
        "positive", "mixed", "negative"]


def test_function_scorer_keeps_failing_rows(spark):
    def judge(text):
        return ("negative" if text[0] == "x" else "positive"), "Other"

    assert label(spark, "xyz", "", "abc", None, scorer=scoring.function_scorer(judge)) == [
        ("negative", "Other"), (None, None), ("positive", "Other"), (None, None)]


def test_trained_scorer(spark):
    rows = [("late and rude", "negative", "Punctuality"), ("polite and skilled", "positive", "Professionalism")] * 5
    labelled = spark.createDataFrame(rows, "review_text string, s string, t string")
    assert label(spark, "so late", "very polite", None, scorer=scoring.train_scorer(labelled, "s", "t")) == [
        ("negative", "Punctuality"), ("positive", "Professionalism"), (None, None)]


def test_fact_joins_carry_no_review_texts(spark, small, tmp_path):
    tables = Star(spark, small, str(tmp_path))
    fact = marts.build_fact_booking(*[tables[n] for n in ("latest", "customers", "services", "providers")])
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "service_started_at" in plan and "review_text" not in plan and "source_row_number" not in plan


def test_keys_are_looked_up_without_the_whole_rows(spark, small, tmp_path):
    """The fact of a stored table deals out booking ids beside what a key depends on; the rows stay in their buckets."""
    tables = Star(spark, small, str(tmp_path))
    latest, providers = tables["latest"], tables["providers"]
    customers, services = tables["customers"].where("customer_key % 3 > 0"), tables["services"].where("service_key % 3 > 0")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for natural in (False, True):
            whole = marts.build_fact_booking(latest, customers, services, providers, natural)
            narrow = marts.build_fact_booking(latest, customers, services, providers, natural, stored=True)
            assert whole.columns == narrow.columns and whole.where("customer_key is null").count() > 0
            assert whole.exceptAll(narrow).isEmpty() and narrow.exceptAll(whole).isEmpty()
            dealt = [x for x in narrow._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan parquet" in x and "booking_id" in x]
            assert len(dealt) == 4 and sum("service_started_at" in x for x in dealt) == 1
        lines = narrow._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(i for i, x in enumerate(lines) if "Scan parquet" in x and "service_started_at" in x)
        depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
        above = [x for x in lines[:at] if len(x) - len(x.lstrip(" :+-")) < depth]
        assert not any("Exchange" in x for x in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_repeated_bookings_keep_their_rows(spark, small, tmp_path):
    """Bookings that come more than once, with the same or another customer, and without an id: as many rows by both ways."""
    tables = Star(spark, small, str(tmp_path))
    dimensions = [tables[n] for n in ("customers", "services", "providers")]
    latest = tables["latest"].where("booking_city < 'Nation_15'")
    several = latest.unionByName(latest.where("rating = 1")).unionByName(latest.where("rating = 2").withColumns({
        "customer_id": F.lit("1"), "booking_created_at": F.col("booking_created_at") - F.expr("interval 1 year")}))
    several = several.unionByName(latest.where("rating = 3").withColumn("booking_id", F.lit(None).cast("string")))
    for natural in (False, True):
        whole = marts.build_fact_booking(several, *dimensions, natural)
        narrow = marts.build_fact_booking(several, *dimensions, natural, stored=True)
        assert whole.columns == narrow.columns and whole.count() == narrow.count() == several.count()
        assert whole.exceptAll(narrow).isEmpty() and narrow.exceptAll(whole).isEmpty()


def test_changes_between_bucketed_states_are_found_in_place(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("b", 2, "x"), ("c", 3, "y"), (None, 4, "z"), ("d", 5, None)], "id string, n int, t string")
    new = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "z"), (None, 4, "z"), (None, 4, "z"), ("d", 5, None)], "id string, n int, t string")
    for name, df in (("old", old), ("new", new)):
        write(df, str(tmp_path / name), "id")
    before, after = (read(spark, str(tmp_path / name), "id") for name in ("old", "new"))
    changes = marts.row_changes(before.where("n < 9").withColumn("n", F.col("n") + 0), after)
    assert "Exchange" not in changes._jdf.queryExecution().executedPlan().toString()
    assert changes.columns == ["id", "n", "t", "change"]
    assert sorted(map(str, changes.collect())) == sorted(map(str, marts.row_changes(old, new).collect()))
    assert sorted((str(r.id), r.n, r.t, r.change) for r in changes.collect()) == [
        ("None", 4, "z", 1), ("b", 2, "x", -1), ("c", 3, "y", -1), ("c", 3, "z", 1)]


def test_touched_dates_are_handed_to_the_fact(spark, small, tmp_path):
    """A refresh of the KPI deals out no booking to find those of the touched dates."""
    tables = Star(spark, small, str(tmp_path))
    fact, dimensions = tables["bookings"], [tables[n] for n in ("dates", "services", "reviews")]
    touched = fact.where("booking_date_key < 19940000").select("booking_date_key").distinct()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = refresh.refresh_kpi(marts.daily_service_kpi(fact.where("rating = 1"), *dimensions), touched, fact, *dimensions)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi, BuildRight" in plan and "LeftAnti, BuildRight" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_trained_scorer_in_an_observed_session(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get == {"rows": 3}
    labelled = spark.createDataFrame([("late late", "negative"), ("polite polite", "positive")] * 10, "review_text string, s string")
    assert label(spark, "so late", None, scorer=scoring.train_scorer(labelled, "s")) == [("negative", None), (None, None)]


def test_reviews_are_scored_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def judge(text):
        calls.add(1)
        return "negative", "Other"

    scorer = scoring.function_scorer(judge)
    t1, t2 = time_of("2026-01-01T00:00:00"), time_of("2026-02-01T00:00:00")
    done = dict(booking_status="COMPLETED")
    snapshots = clean.clean_bookings(raw(spark, [
        booking(booking_id="a", review_text="one", **done), booking(booking_id="b", review_text="two", **done),
        booking(booking_id="c", review_text="open"), booking(booking_id="d", **done)]))
    first = reviews.backfill_reviews(None, snapshots, scorer, "F", now=t1).checkpoint()
    assert sorted(r.booking_id for r in first.collect()) == ["a", "b"]
    before = calls.value
    again = reviews.backfill_reviews(first, snapshots, scorer, "F", now=t2).collect()
    assert calls.value == before and {r.processed_at for r in again} == {at("2026-01-01T00:00:00")}
    live = reviews.enrich_new_reviews(first, clean.parse_bookings(raw(spark, [
        booking(booking_id="a", review_text="one"), booking(booking_id="b", review_text="changed"),
        booking(booking_id="c", review_text="open"), booking(booking_id="c", review_text="older", record_updated_at="2026-01-01T00:00:00Z")])),
        scorer, "L", now=t2).collect()
    assert calls.value == before + 2
    assert sorted((r.booking_id, r.model_source) for r in live) == [("a", "F"), ("b", "L"), ("c", "L")]


def test_backfill_takes_the_newest(spark):
    rows = [booking(booking_id=f"b{i}", review_text="t", booking_status="COMPLETED",
                    booking_created_at=f"2026-01-0{1 + i // 2}T00:00:00Z") for i in range(6)]
    got = reviews.backfill_candidates(clean.clean_bookings(raw(spark, rows)), 3)
    assert sorted(r.booking_id for r in got.collect()) == ["b2", "b4", "b5"]


@pytest.fixture(scope="module")
def star_tables(spark):
    fact = spark.createDataFrame(
        [("1", 20260101, 1, 1, 1, "Pune", "COMPLETED", 10, 2, 1, 0, "100.00", 30),
         ("2", 20260101, 1, 1, 1, "Pune", "CANCELLED", 10, None, 0, 1, "50.00", None),
         ("3", 20260102, 1, 1, 2, "Delhi", "COMPLETED", 10, None, 1, 0, "25.50", 40),
         ("4", 20260102, 1, None, None, None, "BOOKED", 10, None, 0, 0, "1.00", None),
         ("5", 29990101, 1, 1, 1, "Pune", "BOOKED", 10, None, 0, 0, "9.00", None)],
        "booking_id string, booking_date_key int, customer_key bigint, provider_key bigint, service_key bigint, booking_city string,"
        "booking_status string, gross int, rating int, completed_booking_count int, cancelled_booking_count int, final string,"
        "service_duration_minutes int").selectExpr(
            "*", "cast(final as decimal(12,2)) final_amount", "cast(gross as decimal(12,2)) gross_amount",
            "cast(0 as decimal(12,2)) discount_amount", "'UPI' payment_method").drop("final", "gross")
    dates = spark.createDataFrame([(20260101, datetime.date(2026, 1, 1)), (20260102, datetime.date(2026, 1, 2))], "date_key int, full_date date")
    services = spark.createDataFrame([(1, "Plumbing", "Tap", 45), (2, "Electrical", "Fan", 60)],
                                     "service_key bigint, service_category string, service_name string, expected_duration_minutes int")
    insight = spark.createDataFrame([("1", "negative", "Pricing"), ("3", "positive", "Other"), ("77", "negative", "Other")],
                                    "booking_id string, sentiment_label string, complaint_category string")
    return {"bookings": fact, "dates": dates, "services": services, "reviews": insight,
            "customers": spark.createDataFrame([(1, "NEW", "Pune")], "customer_key bigint, customer_segment string, home_city string"),
            "providers": spark.createDataFrame([(1, "P1", "PREMIUM")], "provider_key bigint, provider_id string, provider_tier string")}


def test_kpi(spark, star_tables):
    s = star_tables
    rows = marts.daily_service_kpi(s["bookings"], s["dates"], s["services"], s["reviews"]).collect()
    got = {(str(r.booking_date), r.booking_city, r.service_category): r for r in rows}
    assert set(got) == {("2026-01-01", "Pune", "Plumbing"), ("2026-01-02", "Delhi", "Electrical")}
    r = got[("2026-01-01", "Pune", "Plumbing")]
    assert (r.total_bookings, r.completion_rate, r.cancellation_rate, float(r.total_revenue), r.average_rating,
            r.enriched_review_count, r.negative_review_count) == (2, 0.5, 0.5, 150.0, 2.0, 1, 1)
    assert got[("2026-01-02", "Delhi", "Electrical")].average_rating is None


def ask(tables, *args, **kwargs):
    return [tuple(r) for r in semantic_query(tables, MARKETPLACE, *args, **kwargs).collect()]


def test_metrics_stay_on_their_fact(spark, star_tables):
    rows = ask(star_tables, ["total_bookings", "net_revenue", "enriched_review_count", "negative_review_count"], ["city"],
               order_by=["-total_bookings", "booking_city"])
    assert [(c, n, float(m) if m is not None else None, e, g) for c, n, m, e, g in rows] == [
        ("Pune", 3, 159.0, 1, 1), (None, 1, 1.0, 1, 1), ("Delhi", 1, 25.5, 1, 0)]
    total = ask(star_tables, ["total_bookings", "enriched_review_count"])
    assert total == [(5, 3)]


def test_review_dimension_does_not_multiply_bookings(spark, star_tables):
    rows = ask(star_tables, ["total_bookings"], ["sentiment"])
    assert sorted(rows, key=str) == [("negative", 1), ("positive", 1), (None, 3)]


def test_names_and_synonyms(spark, star_tables):
    assert ask(star_tables, ["GMV"], ["market"], [("job status", "=", "CANCELLED")]) == ask(
        star_tables, ["gross_revenue"], ["booking_city"], [("bookings.booking_status", "in", ["CANCELLED"])])
    with pytest.raises(KeyError, match="unknown metric"):
        ask(star_tables, ["profit"])
    with pytest.raises(KeyError, match="unknown dimension"):
        ask(star_tables, ["revenue"], ["customers.city"])
    assert len(MARKETPLACE.dimensions) == 24 and len(MARKETPLACE.metrics) == 12


def test_unused_entities_are_not_joined(spark, star_tables):
    plan = semantic_query(star_tables, MARKETPLACE, ["net_revenue"], ["booking_city"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_one_to_many_directions_are_refused(spark, star_tables):
    from tidewell.plans.semantic import Dimension, Entity, Metric, Model, Relationship

    model = Model((Entity("a", "k"), Entity("b", "id")), (Relationship("r", "b", "k", "a"),), (Dimension("d", "b", "id"),),
                  (Metric("n", "a", "count(k)", "count"),))
    tables = {"a": spark.createDataFrame([(1,)], "k int"), "b": spark.createDataFrame([(1, 1)], "id int, k int")}
    with pytest.raises(ValueError, match="no allowed join"):
        semantic_query(tables, model, ["n"], ["d"])


def test_questions_on_a_small_star(spark, star_tables):
    verified = questions.verified_revenue_by_category(star_tables).collect()
    assert [(r.service_category, float(r.net_revenue)) for r in verified] == [("Plumbing", 159.0), ("Electrical", 25.5)]


def test_null_rating_is_no_violation(spark, star_tables):
    checks = quality.fact_checks(star_tables["bookings"], star_tables["dates"], ["customer_key"])
    assert checks.filter("check_name = 'invalid_measures'").first().violations == 0


def test_expected_counts_and_manifest(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 6)], "object_name string, row_count bigint")
    gaps = quality.expected_counts(counts, {"a": 5, "b": 7, "c": 1}).collect()
    assert sorted(r.object_name for r in gaps) == ["b", "c"]
    manifest = spark.createDataFrame(
        [([("x/a.json.gz", 5), ("x/b.json.gz", 7), ("x/c.json.gz", 1)],)], "files array<struct<path string, physical_records int>>")
    loads = spark.createDataFrame([("file:/in/x/a.json.gz", 5), ("file:/in/x/b.json.gz", 6)], "source_filename string, row_count bigint")
    assert sorted(r.path for r in quality.manifest_gaps(manifest, loads).collect()) == ["x/b.json.gz", "x/c.json.gz"]
