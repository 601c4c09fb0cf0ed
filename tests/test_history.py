from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, provider, raw
from tidewell.operators import asof, clean, dims, ordered, quality, refresh, scd2
from tidewell.operators.keys import assign_keys
from tidewell.sources import star


def events(spark, *records):
    return clean.parse_providers(raw(spark, list(records)))


def event(tier, day, **more):
    when = f"2026-{day}T00:00:00Z"
    return provider(provider_tier=tier, effective_at=when, record_updated_at=when, **more)


def versions(dim):
    return [(r.provider_id, r.provider_tier, str(r.effective_start_at)[5:10], str(r.effective_end_at)[:10], r.is_current)
            for r in dim.orderBy("provider_id", "effective_start_at").collect()]


@pytest.mark.parametrize("apply", [scd2.scd2_apply, scd2.scd2_apply_all])
def test_version_rules(spark, apply):
    dim = scd2.scd2_seed(events(spark, event("STANDARD", "02-01"), event("PREMIUM", "03-01"),
                                event("STANDARD", "02-01", provider_id="P2"), event("STANDARD", "02-01", provider_id="P3"),
                                event("STANDARD", "02-01", provider_id="P4")))
    assert all(v[3] == "9999-12-31" and v[4] for v in versions(dim)) and dim.count() == 4
    after = apply(dim, events(spark, event("PREMIUM", "09-01"), event("STANDARD", "09-01", provider_id="P2"),
                              event("PREMIUM", "01-01", provider_id="P3"), event("PREMIUM", "02-01", provider_id="P4"),
                              event("PREMIUM", "05-01", provider_id="P5")))
    assert versions(after) == [
        ("P1", "STANDARD", "02-01", "2026-09-01", False), ("P1", "PREMIUM", "09-01", "9999-12-31", True),
        ("P2", "STANDARD", "02-01", "9999-12-31", True), ("P3", "STANDARD", "02-01", "9999-12-31", True),
        ("P4", "STANDARD", "02-01", "9999-12-31", True), ("P5", "PREMIUM", "05-01", "9999-12-31", True)]
    keys = {r.provider_id: r.provider_key for r in dim.collect()}
    kept = {r.provider_id: r.provider_key for r in after.filter("provider_tier = 'STANDARD'").collect()}
    assert keys == kept and after.select("provider_key").distinct().count() == 6


def test_change_back_makes_three_versions(spark):
    changes = events(spark, event("STANDARD", "01-01"), event("PREMIUM", "02-01"), event("STANDARD", "03-01"),
                     event("STANDARD", "04-01"))
    assert [v[1:3] for v in versions(scd2.scd2_history(changes))] == [
        ("STANDARD", "01-01"), ("PREMIUM", "02-01"), ("STANDARD", "03-01")]


def test_only_the_newest_change_of_a_batch_counts(spark):
    dim = scd2.scd2_seed(events(spark, event("STANDARD", "01-01")))
    batch = events(spark, event("PREMIUM", "02-01"), event("STANDARD", "03-01"))
    assert len(versions(scd2.scd2_apply(dim, batch))) == 1
    assert len(versions(scd2.scd2_apply_all(dim, batch))) == 3


def test_seed_leaves_known_providers_alone(spark):
    dim = scd2.scd2_seed(events(spark, event("STANDARD", "05-01")))
    again = scd2.scd2_seed(events(spark, event("PREMIUM", "01-01"), event("PREMIUM", "01-01", provider_id="P2")), dim)
    assert versions(again) == [("P1", "STANDARD", "05-01", "9999-12-31", True), ("P2", "PREMIUM", "01-01", "9999-12-31", True)]


def test_batches_in_time_order_equal_the_full_history(spark, small):
    all_events = star.provider_events(spark, small).checkpoint()
    want = versions(scd2.scd2_history(all_events))
    years = [r[0] for r in all_events.select(F.year("effective_at")).distinct().orderBy(F.year("effective_at")).collect()]
    dim = scd2.scd2_seed(all_events.filter(F.year("effective_at") == years[0]))
    for year in years:
        dim = scd2.scd2_apply_all(dim, all_events.filter(F.year("effective_at") == year)).checkpoint()
        assert {r.check_name: r.violations for r in quality.stack([
            quality.version_checks(dim), quality.overlapping_intervals(dim)]).collect()
        } == dict.fromkeys(["current_version_count", "invalid_intervals", "overlapping_intervals"], 0)
    assert versions(dim) == want
    quarters = [r[0] for r in all_events.select("effective_at").distinct().orderBy("effective_at").limit(6).collect()]
    dim = scd2.scd2_seed(all_events.filter(F.col("effective_at") == quarters[0]))
    for quarter in quarters[1:]:
        dim = scd2.scd2_apply(dim, all_events.filter(F.col("effective_at") == quarter)).checkpoint()
    assert versions(dim) == versions(scd2.scd2_history(all_events.filter(F.col("effective_at").isin(quarters))))


def timeline(spark, seed=1, rows=600):
    """Random instants; one key holds most of them."""
    rng = random.Random(seed)
    made = {}
    for _ in range(rows):
        key = rng.choice(["hot", "hot", "hot", "a", "b"])
        made[(key, rng.randrange(400 * 24))] = rng.randrange(4)
    base = at("2026-01-01T00:00:00").timestamp()
    data = [(k, int(base) + h * 3600, v) for (k, h), v in made.items()]
    return data, spark.createDataFrame(data, "key string, s bigint, v int").select(
        "key", F.timestamp_seconds("s").alias("at"), "s", "v")


@pytest.mark.parametrize("unit", ["day", "month"])
def test_neighbours_across_period_borders(spark, unit):
    data, df = timeline(spark)
    both = ordered.with_next(ordered.with_previous(df, "key", "at", "v", "p", unit), "key", "at", "v", "n", unit)
    got = {(r.key, r.s): (r.p, r.n) for r in both.collect()}
    for key in {d[0] for d in data}:
        line = sorted(d for d in data if d[0] == key)
        for i, (_, s, _) in enumerate(line):
            assert got[(key, s)] == (line[i - 1][2] if i else None, line[i + 1][2] if i + 1 < len(line) else None)


def test_overlap_pairs_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a"]), s, s + rng.choice([1, 2, 5, 40, 0, 0, -3])) for s in
            (rng.randrange(300) for _ in range(250))]
    df = spark.createDataFrame(rows, "key string, s int, e int").select(
        "key", F.timestamp_seconds(F.col("s") * 86400).alias("s"), F.timestamp_seconds(F.col("e") * 86400).alias("e"))
    got = {r.key: r.overlapping_pairs for r in ordered.overlap_pairs(df, "key", "s", "e").collect()}
    assert set(got) == {"hot", "a"}
    for key in got:
        mine = [r for r in rows if r[0] == key]
        assert got[key] == sum(a[1] < b[2] and b[1] < a[2] for i, a in enumerate(mine) for b in mine[:i])


def test_every_valid_version_is_found_whatever_the_size(spark):
    rows = spark.createDataFrame([(1, "P1", at("2026-01-25T00:00:00")), (2, "P1", at("2026-02-10T00:00:00"))], "_k int, id string, at timestamp")
    dim = spark.createDataFrame(
        [("P1", 10, at("2026-01-01T00:00:00"), at("2026-02-01T00:00:00")),
         ("P1", 11, at("2026-01-20T00:00:00"), at("2026-03-01T00:00:00"))], "id string, k int, s timestamp, e timestamp")
    got = asof.point_in_time_join(rows, dim, "id", "at", "s", "e", ["k"])
    assert sorted((r._k, r.k) for r in got.collect()) == [(1, 10), (1, 11), (2, 11)]


def test_point_in_time_boundaries(spark):
    rows = spark.createDataFrame(
        [(1, "P1", at("2026-01-01T00:00:00")), (2, "P1", at("2026-09-01T00:00:00")), (3, "P1", at("2025-12-31T23:59:59")),
         (4, "P9", at("2026-05-01T00:00:00")), (5, None, at("2026-05-01T00:00:00")), (6, "P1", None),
         (7, "P1", at("2026-10-01T00:00:00")), (8, "P1", at("2027-06-01T00:00:00"))], "n int, id string, at timestamp")
    dim = spark.createDataFrame(
        [("P1", 10, at("2026-01-01T00:00:00"), at("2026-09-01T00:00:00")),
         ("P1", 11, at("2026-09-01T00:00:00"), at("2026-10-01T00:00:00")),
         ("P1", 12, at("2027-01-01T00:00:00"), at("9999-12-31T00:00:00"))], "id string, k int, s timestamp, e timestamp")
    got = asof.point_in_time_join(rows, dim, "id", "at", "s", "e", ["k"])
    assert {r.n: r.k for r in got.collect()} == {1: 10, 2: 11, 3: None, 4: None, 5: None, 6: None, 7: None, 8: 12}


def plain_join(rows, dim):
    """By definition: every row with every version of its key that is valid at its time."""
    return sorted((n, k) for n, key, t in rows for hits in [[k for key_, k, s, e in dim if key == key_ and key is not None and None not in (t, s, e) and s <= t < e]]
                  for k in hits or [-1])


def interval_tables(spark, rows, dim):
    second = lambda c: F.timestamp_seconds(F.col(c))
    left = spark.createDataFrame(rows, "n int, id string, at bigint").withColumn("at", second("at"))
    right = spark.createDataFrame(dim, "id string, v int, s bigint, e bigint").withColumns({"s": second("s"), "e": second("e")})
    clashes = {c: F.lit(1) for c in ("k", "t", "b", "own", "row", "version", "run", "low", "high", "k_own")}
    return left.withColumns(clashes), right.withColumns(clashes)


def test_point_in_time_join_of_any_intervals(spark):
    """Overlapping, repeated, empty, negative, open and null intervals, and a key whose versions are far shorter than the others'."""
    rng, far = random.Random(11), 253402214400
    dim = [(rng.choice(["a", "b"]), i, s, s + rng.choice([0, -5, 3, 50, 5_000, 400_000])) for i, s in enumerate(rng.randrange(900_000) for _ in range(150))]
    dim += [("hot", 1000 + i, 300_000 + 7 * i, 300_007 + 7 * i) for i in range(600)] + [("hot", 1999, 304_200, far), ("a", 2000, 5, far), ("a", 2000, 5, far)]
    dim += [(None, 3000, 1, far), ("a", 3001, None, far), ("a", 3002, 1, None)]
    rows = [(i, rng.choice(["a", "b", "hot", "hot", "none", None]), rng.choice([None, -10, 2_000_000, far, rng.randrange(299_000, 306_000), rng.randrange(1_400_000)]))
            for i in range(900)]
    left, right = interval_tables(spark, rows, dim)
    got = asof.point_in_time_join(left, right, "id", "at", "s", "e", ["v"])
    assert got.columns == [*left.columns, "v"]
    assert sorted((r.n, -1 if r.v is None else r.v) for r in got.collect()) == plain_join(rows, dim)
    assert asof.point_in_time_join(left, right.where("false"), "id", "at", "s", "e", ["v"]).where("v is null").count() == len(rows)
    assert asof.point_in_time_join(left.where("false"), right, "id", "at", "s", "e", ["v"]).count() == 0


def test_rows_compared_stay_flat_when_versions_grow(spark):
    """Ten times the versions per key, in the same time: as many comparisons for each row."""
    rng, span, compared = random.Random(3), 1_000_000, []
    rows = [(i, f"k{i % 3}", rng.randrange(span)) for i in range(400)]
    for n in (40, 400, 4000):
        step = span // n
        dim = [(f"k{k}", i, i * step, (i + 1) * step) for k in range(3) for i in range(n)]
        left, right = interval_tables(spark, rows, dim)
        left, right = asof.candidates(left, right, "id", "at", "s", "e", ["v"])
        compared.append(left.join(right, ["k", "b"]).count() / len(rows))
        assert right.count() <= 3 * len(dim)
    assert max(compared) <= 3 and max(compared) < 1.5 * min(compared)


def test_a_key_of_many_short_versions_has_bins_of_its_own(spark):
    dim = [(f"k{i}", i, 0, 1_000_000) for i in range(50)] + [("hot", i, 10 * i, 10 * i + 10) for i in range(5000)]
    rows = [(i, "hot", 10 * i + 3) for i in range(0, 5000, 10)]
    left, right = asof.candidates(*interval_tables(spark, rows, dim), "id", "at", "s", "e", ["v"])
    assert left.join(right, ["k", "b"]).count() <= 3 * len(rows)


def test_a_long_version_among_short_ones_lies_in_many_bins(spark, monkeypatch):
    monkeypatch.setattr(asof, "RUN", 7)
    dim = [("a", 1, 0, 100_000)] + [(f"k{i}", i, 10 * i, 10 * i + 1) for i in range(10_000)]
    rows = [(i, "a", 997 * i) for i in range(100)]
    left, right = interval_tables(spark, rows, dim)
    assert asof.point_in_time_join(left, right, "id", "at", "s", "e", ["v"]).where("v = 1").count() == 100


def test_point_in_time_join_on_dates_and_numbers(spark):
    rows = spark.sql("select 'a' as id, date'2024-03-01' as day, 7L as n union all select 'a', date'2024-05-01', 20L")
    dim = spark.sql("select 'a' as id, date'2024-01-01' as s, date'2024-05-01' as e, 5L as x, 8L as y")
    assert [r.x for r in asof.point_in_time_join(rows, dim, "id", "day", "s", "e", ["x"]).orderBy("n").collect()] == [5, None]
    assert [r.x for r in asof.point_in_time_join(rows, dim, "id", "n", "x", "y", ["x"]).orderBy("n").collect()] == [5, None]


def test_keys_are_unique_and_stay(spark):
    first = assign_keys(spark.range(100).select(F.col("id").cast("string").alias("id")), ["id"], "k")
    given = {r.id: r.k for r in first.collect()}
    assert len(set(given.values())) == 100 and min(given.values()) > 0
    more = assign_keys(spark.range(100, 130).select(F.col("id").cast("string").alias("id")), ["id"], "k", existing=first)
    added = [r.k for r in more.collect()]
    assert len(set(added)) == 30 and min(added) > max(given.values())
    shuffled = assign_keys(spark.range(100).repartition(7).select(F.col("id").cast("string").alias("id")), ["id"], "k")
    assert {r.id: r.k for r in shuffled.collect()} == given


def test_type1_merge_overwrites_with_nulls_and_keeps_keys(spark):
    now, later = F.lit(at("2026-01-01T00:00:00")), F.lit(at("2026-02-01T00:00:00"))
    columns = "customer_id string, customer_name string, customer_segment string, home_city string, signup_date date, is_active boolean"
    import datetime

    one = spark.createDataFrame([("a", "A", "NEW", "Pune", datetime.date(2024, 1, 1), True), ("b", "B", "NEW", "Pune", None, True)], columns)
    two = spark.createDataFrame([("a", "A2", "LOYAL", "Delhi", None, False), ("c", "C", "NEW", "Pune", None, True)], columns)
    dim = dims.merge_customers(None, one, now)
    after = {r.customer_id: r for r in dims.merge_customers(dim, two, later).collect()}
    before = {r.customer_id: r for r in dim.collect()}
    assert set(after) == {"a", "b", "c"}
    a = after["a"]
    assert (a.customer_name, a.signup_date, a.is_active, a.customer_key) == ("A2", None, False, before["a"].customer_key)
    assert a.created_at == before["a"].created_at and a.updated_at > before["a"].updated_at
    assert after["b"] == before["b"] and after["c"].customer_key > max(r.customer_key for r in before.values())


def test_calendar(spark):
    days = dims.build_dim_date(spark)
    assert days.count() == 1096 and days.agg(F.max("date_key")).first()[0] == 20280101
    row = days.filter("date_key = 20260103").first()
    assert (row.day_name, row.day_of_week, row.week_number, row.month_name, row.quarter, row.is_weekend) == ("Sat", 6, 1, "Jan", 1, True)
    more = dims.build_dim_date(spark, "2024-12-30", "2025-01-02", days)
    assert more.count() == 1098 and more.select("date_key").distinct().count() == 1098


def test_rekeyed_bookings(spark):
    before = scd2.scd2_seed(events(spark, event("STANDARD", "01-01"), event("STANDARD", "01-01", provider_id="P2")))
    before = before.checkpoint()
    after = scd2.scd2_apply(before, events(spark, event("PREMIUM", "06-01")))
    bookings = spark.createDataFrame(
        [(1, "P1", at("2026-05-31T00:00:00")), (2, "P1", at("2026-06-01T00:00:00")), (3, "P2", at("2026-07-01T00:00:00"))],
        "booking_id int, provider_id string, booking_created_at timestamp")
    assert [r.booking_id for r in refresh.rekeyed_bookings(bookings, before, after).collect()] == [2]
