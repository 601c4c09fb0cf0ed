"""The registered queries as plain SQL over the given tables.

Written apart from the Spark code: rates and averages are rounded half up in whole
numbers, and intervals are found by comparing rows, so agreement means something.
"""

from __future__ import annotations

from tidewell.functions.lexicon import SERVICE_LEXICON
from tidewell.plans.queries import CUT_OFF, SAMPLE_PROVIDERS, STANDS_FOR

INSULTS = "'trash','pathetic','idiot','worthless','disgusting','stupid','clown','scum','loser','moron'"


def rate(part: str, whole: str) -> str:
    return (f"CASE WHEN ({whole}) = 0 THEN NULL ELSE "
            f"cast((({part}) * 20000 + ({whole})) // (2 * ({whole})) AS double) / 10000 END")


def mean(total: str, count: str) -> str:
    return (f"CASE WHEN ({count}) = 0 THEN NULL ELSE "
            f"cast((({total}) * 200 + ({count})) // (2 * ({count})) AS double) / 100 END")


def money(expr: str) -> str:
    return f"cast(sum({expr}) AS double)"


def big(expr: str) -> str:
    return f"cast({expr} AS bigint)"


def _city(col: str) -> str:
    return f"upper({col}[1]) || lower({col}[2:])"


SNAP = f"""
review_of AS (
  SELECT booking, doc_id
  FROM (SELECT l_orderkey * 10 + l_linenumber AS booking, l_orderkey % 256 AS r,
          row_number() OVER (PARTITION BY l_orderkey % 256 ORDER BY l_orderkey * 10 + l_linenumber) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING bool_and(l_returnflag = 'A'))
  JOIN (SELECT doc_id, doc_id % 256 AS r, row_number() OVER (PARTITION BY doc_id % 256 ORDER BY doc_id) AS n FROM documents) USING (r, n)
),
lines AS (
  SELECT l.*, o_custkey, o_orderdate, o_orderpriority, {_city('n_name')} AS city,
    CASE WHEN l_returnflag = 'R' THEN 'CANCELLED' WHEN l_returnflag = 'A' THEN 'COMPLETED'
         WHEN l_linestatus = 'F' THEN 'IN_PROGRESS' ELSE 'BOOKED' END AS status,
    cast(l_extendedprice AS decimal(12,2)) AS gross,
    cast(round(cast(l_extendedprice AS decimal(12,2)) * cast(l_discount AS decimal(4,2)), 2) AS decimal(12,2)) AS disc,
    nullif(trim(text), '') AS review
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN review_of ON booking = l_orderkey * 10 + l_linenumber LEFT JOIN documents USING (doc_id)
),
priced AS (
  SELECT *, cast(round((gross - disc) * cast(0.18 AS decimal(4,2)), 2) AS decimal(12,2)) AS tax FROM lines
),
snap AS (
  SELECT cast(l_orderkey * 10 + l_linenumber AS varchar) AS booking_id,
    cast(o_custkey AS varchar) AS customer_id, cast(l_suppkey AS varchar) AS provider_id,
    cast(l_partkey AS varchar) AS service_id, city AS booking_city,
    o_orderdate AS booking_created_at, o_orderdate + INTERVAL 2 DAY AS scheduled_at,
    CASE WHEN status = 'COMPLETED' THEN l_shipdate + INTERVAL 9 HOUR END AS service_started_at,
    CASE WHEN status = 'COMPLETED' THEN l_shipdate + INTERVAL 9 HOUR + to_minutes(15 + cast(l_quantity AS integer)) END
      AS service_completed_at,
    status AS booking_status, gross AS gross_amount, disc AS discount_amount, tax AS tax_amount,
    cast(gross - disc + tax AS decimal(12,2)) AS final_amount, o_orderpriority AS payment_method,
    CASE WHEN status = 'COMPLETED' THEN 1 + cast(l_quantity AS integer) % 5 END AS rating,
    review AS review_text, l_shipdate AS record_updated_at,
    'bookings/' || strftime(l_shipdate, '%Y-%m') || '.json.gz' AS source_filename,
    cast(gross * 100 AS bigint) AS source_row_number, cast(l_quantity AS integer) AS q
  FROM priced
)"""

LATEST = SNAP + """,
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY record_updated_at DESC, source_row_number DESC) AS rn
    FROM snap) WHERE rn = 1
)"""

EVENTS = f"""
quarters AS (
  SELECT l_suppkey, date_trunc('quarter', l_shipdate) AS effective_at, count(*) AS n,
    count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS r, count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS o
  FROM lineitem GROUP BY 1, 2
),
unhashed AS (
  SELECT cast(l_suppkey AS varchar) AS provider_id, s_name AS provider_name, {_city('n_name')} AS primary_city,
    'Zone ' || (r % 5) AS operating_zone,
    CASE WHEN n >= 22 THEN 'PREMIUM' ELSE 'STANDARD' END AS provider_tier,
    'LEVEL ' || (l_suppkey % 3) AS experience_level,
    CASE WHEN o % 10 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS active_status,
    'Category ' || (l_suppkey % 5) AS primary_service_category,
    cast(effective_at AS timestamp) AS effective_at, l_suppkey
  FROM quarters JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
events_in AS (
  SELECT *, sha256(concat_ws('|', primary_city, operating_zone, provider_tier, experience_level, active_status,
    primary_service_category)) AS attribute_hash FROM unhashed
)"""


def versions(source: str, name: str = "versions") -> str:
    """Versions out of ordered events: unchanged ones dropped, each ended by the next."""
    return f"""
{name}_walk AS (
  SELECT *, lag(attribute_hash) OVER (PARTITION BY provider_id ORDER BY effective_at) AS before FROM {source}
),
{name} AS (
  SELECT * EXCLUDE (before), effective_at AS effective_start_at,
    coalesce(lead(effective_at) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS effective_end_at,
    lead(effective_at) OVER w IS NULL AS is_current
  FROM {name}_walk WHERE before IS NULL OR before <> attribute_hash
  WINDOW w AS (PARTITION BY provider_id ORDER BY effective_at)
)"""


def hits(words: str) -> str:
    return f"len(list_filter(toks, lambda w: w IN ({words})))"


SCORED_COLUMNS = f"""
    CASE WHEN {hits(INSULTS)} > 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
    {hits("'the','an'")} AS punctuality, {hits("'of','to'")} AS pricing, {hits("'in','is','it'")} AS communication"""

THEME = """CASE WHEN greatest(punctuality, pricing, communication) = 0
      THEN CASE WHEN sentiment_label = 'negative' THEN 'Other' ELSE 'No Complaint' END
    WHEN punctuality >= pricing AND punctuality >= communication THEN 'Punctuality'
    WHEN pricing >= communication THEN 'Pricing' ELSE 'Communication' END"""


def scored(source: str, text: str, name: str) -> str:
    return f"""
{name}_words AS (SELECT *, string_split_regex(lower({text}), '[^a-z]+') AS toks FROM {source}),
{name}_counts AS (SELECT * EXCLUDE (toks), {SCORED_COLUMNS} FROM {name}_words),
{name} AS (SELECT *, {THEME} AS complaint_category FROM {name}_counts)"""


REVIEWED = scored("(SELECT * FROM latest WHERE booking_status = 'COMPLETED' AND review_text IS NOT NULL)", "review_text",
                  "reviews")

FACT = LATEST + "," + EVENTS + "," + versions("events_in") + "," + REVIEWED + """,
fact AS (
  SELECT b.* EXCLUDE (rn, q, review_text),
    cast(strftime(b.booking_created_at, '%Y%m%d') AS integer) AS booking_date_key,
    cast(b.booking_created_at AS date) AS booking_date,
    date_diff('minute', b.service_started_at, b.service_completed_at) AS mins,
    CASE WHEN b.booking_status = 'COMPLETED' THEN 1 ELSE 0 END AS done,
    CASE WHEN b.booking_status = 'CANCELLED' THEN 1 ELSE 0 END AS lost,
    upper(c_mktsegment) AS customer_segment, upper(cn.n_name[1]) || lower(cn.n_name[2:]) AS customer_home_city,
    p_name AS service_name, p_type AS service_category, upper(p_brand) AS skill_level_required, 15 + p_size AS expected,
    v.provider_name, v.primary_city AS provider_city, v.operating_zone, v.provider_tier, v.experience_level, v.active_status,
    v.effective_start_at AS version_start_at,
    r.booking_id AS review_id, r.sentiment_label, r.complaint_category
  FROM latest b
  JOIN customer ON b.customer_id = cast(c_custkey AS varchar) JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN part ON b.service_id = cast(p_partkey AS varchar)
  LEFT JOIN versions v ON v.provider_id = b.provider_id
    AND b.booking_created_at >= v.effective_start_at AND b.booking_created_at < v.effective_end_at
  LEFT JOIN reviews r ON r.booking_id = b.booking_id
)"""

BOOKING_VIEW = """booking_id, customer_id, provider_id, service_id, booking_city,
  cast(booking_created_at AS varchar) AS booking_created_at, cast(scheduled_at AS varchar) AS scheduled_at,
  cast(service_started_at AS varchar) AS service_started_at, cast(service_completed_at AS varchar) AS service_completed_at,
  booking_status, cast(gross_amount AS double) AS gross_amount, cast(discount_amount AS double) AS discount_amount,
  cast(tax_amount AS double) AS tax_amount, cast(final_amount AS double) AS final_amount, payment_method,
  cast(rating AS bigint) AS rating, cast(record_updated_at AS varchar) AS record_updated_at, source_filename,
  source_row_number, sha256(review_text) AS review_hash"""

# The faults the adapter plants, one per quantity.
FAULTY = SNAP + """,
faulty AS (
  SELECT * REPLACE (
    CASE WHEN q = 1 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN q = 2 THEN NULL ELSE booking_created_at END AS booking_created_at,
    CASE WHEN q = 4 THEN 'PAUSED' ELSE booking_status END AS booking_status,
    CASE WHEN q = 5 THEN -0.01 WHEN q = 6 THEN NULL WHEN q = 7 THEN 0 ELSE final_amount END AS final_amount,
    CASE WHEN q = 8 THEN NULL ELSE record_updated_at END AS record_updated_at,
    CASE WHEN q = 9 THEN NULL ELSE review_text END AS review_text,
    CASE WHEN q = 10 THEN 5 ELSE rating END AS rating)
  FROM snap
)"""
VALID = "q NOT IN (1, 2, 4, 5, 6)"

PROVIDER_VIEW = """provider_id, provider_name, primary_city, operating_zone, provider_tier, experience_level,
  active_status, primary_service_category, cast(effective_at AS varchar) AS effective_at, attribute_hash"""

VERSION_VIEW = """provider_id, primary_city, operating_zone, provider_tier, experience_level, active_status,
  cast(effective_start_at AS varchar) AS effective_start_at, cast(effective_end_at AS varchar) AS effective_end_at,
  is_current, attribute_hash"""

FAULTY_EVENTS = EVENTS + """,
faulty_events AS (
  SELECT * REPLACE (
    CASE WHEN month(effective_at) = 4 AND operating_zone = 'Zone 0' THEN NULL ELSE provider_id END AS provider_id,
    CASE WHEN month(effective_at) = 4 AND operating_zone = 'Zone 1' THEN NULL ELSE effective_at END AS effective_at,
    CASE WHEN month(effective_at) = 4 AND operating_zone = 'Zone 2' THEN 'GOLD' ELSE provider_tier END AS provider_tier,
    CASE WHEN month(effective_at) = 4 AND operating_zone = 'Zone 3' THEN 'PAUSED' ELSE active_status END AS active_status)
  FROM unhashed
)"""

MIXED = """
mixed AS (
  SELECT props AS payload, 'events/' || strftime(ts, '%Y-%m-%d') || '.json.gz' AS source_filename,
    cast(date_trunc('day', ts) AS timestamp) AS ingested_at FROM events
  UNION ALL
  SELECT text, 'documents/' || source || '.json.gz', TIMESTAMP '2024-02-01 00:00:00' FROM documents
  UNION ALL
  SELECT unnest(['{"a": "' || r_name || '"}', '{"a": "' || r_name || '"}], "x": [2', '["' || r_name || '"]], "end": 1} {"z": [2',
    '"' || r_name || '"], "line": [2', '"' || r_name || '", 2']), 'forged/regions.json.gz', TIMESTAMP '2024-03-01 00:00:00' FROM region
)"""

FIRST, SECOND = "2002-01-03 00:00:00", "2002-01-04 00:00:00"

SQL: dict[str, str] = {}

# ---- sources

SQL["load_history"] = f"""WITH {MIXED},
judged AS (SELECT *, json_valid(payload) AS ok FROM mixed)
SELECT source_filename, count(CASE WHEN ok THEN 1 END) AS row_count, count(CASE WHEN NOT ok THEN 1 END) AS error_count,
  cast(max(ingested_at) AS varchar) AS last_load_time,
  CASE WHEN count(CASE WHEN NOT ok THEN 1 END) = 0 THEN 'LOADED' WHEN count(CASE WHEN ok THEN 1 END) = 0 THEN 'LOAD_FAILED'
    ELSE 'PARTIALLY_LOADED' END AS status
FROM judged GROUP BY source_filename"""

SQL["new_file_rows"] = """
SELECT 'batch_' || strftime(l_shipdate, '%Y%m') AS source_filename, count(*) AS row_count FROM lineitem
WHERE strftime(l_shipdate, '%Y%m') NOT IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders) GROUP BY 1"""

SQL["ledger_history"] = SQL["load_history"]

SQL["new_file_rows_by_ledger"] = SQL["new_file_rows"]

SQL["manifest_check"] = """
SELECT 'documents/' || source || '.json.gz' AS path, count(*) + 1 AS physical_records, count(*) AS row_count FROM documents WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'never/came.json.gz', count(*), NULL FROM region"""

SQL["load_runs"] = """
WITH mixed AS (SELECT props AS payload FROM events UNION ALL SELECT text FROM documents)
SELECT 'customers' AS name, 'SUCCEEDED' AS state, 2 * count(*) AS input_rows, 0::BIGINT AS rejected, NULL::BOOLEAN AS malformed FROM customer
UNION ALL SELECT 'services', 'SUCCEEDED', 2 * count(*), 0, NULL FROM part
UNION ALL SELECT 'providers', 'SUCCEEDED', count(DISTINCT (l_suppkey, date_trunc('quarter', l_shipdate))), 0, NULL
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'mixed', 'SUCCEEDED', count(*), count(CASE WHEN NOT coalesce(json_valid(payload), false) THEN 1 END), NULL FROM mixed
UNION ALL SELECT 'refused', 'FAILED', NULL, NULL, true"""

SQL["raw_table_counts"] = f"""WITH {SNAP}, {EVENTS}
SELECT 'RAW_BOOKING_EVENTS' AS object_name, count(*) AS row_count FROM snap
UNION ALL SELECT 'RAW_PROVIDER_EVENTS', count(*) FROM events_in
UNION ALL SELECT 'RAW_CUSTOMERS', 2 * count(*) FROM customer
UNION ALL SELECT 'RAW_SERVICES', 2 * count(*) FROM part"""

# ---- casts, validation, latest state

SQL["parsed_bookings"] = f"WITH {SNAP} SELECT {BOOKING_VIEW} FROM snap"

SQL["booking_faults"] = f"""WITH {FAULTY}
SELECT booking_id, source_row_number, booking_status, booking_city, cast(rating AS bigint) AS rating,
  cast(final_amount AS double) AS final_amount, review_text IS NOT NULL AS has_review,
  cast(record_updated_at AS varchar) AS record_updated_at,
  CASE q WHEN 1 THEN 'customer_id missing' WHEN 2 THEN 'booking_created_at unreadable'
    WHEN 4 THEN 'booking_status unknown' WHEN 5 THEN 'final_amount unreadable or negative'
    WHEN 6 THEN 'final_amount unreadable or negative' ELSE '' END AS faults
FROM faulty"""

SQL["valid_booking_counts"] = f"""WITH {FAULTY}
SELECT booking_status, count(*) AS valid_rows FROM faulty WHERE {VALID} GROUP BY 1"""

SQL["latest_valid_bookings"] = f"""WITH {FAULTY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY booking_id
    ORDER BY record_updated_at DESC NULLS LAST, source_row_number DESC) AS rn FROM faulty WHERE {VALID})
SELECT {BOOKING_VIEW} FROM ranked WHERE rn = 1"""

SQL["latest_bookings"] = f"WITH {LATEST} SELECT {BOOKING_VIEW} FROM latest"

SQL["newest_by_aggregation"] = SQL["latest_bookings"]
SQL["refreshed_latest_bookings"] = SQL["latest_bookings"]

SQL["provider_changes"] = f"WITH {EVENTS} SELECT {PROVIDER_VIEW} FROM events_in"

SQL["valid_provider_events"] = f"""WITH {FAULTY_EVENTS},
hashed AS (SELECT *, sha256(concat_ws('|', primary_city, operating_zone, provider_tier, experience_level, active_status,
  primary_service_category)) AS attribute_hash FROM faulty_events)
SELECT {PROVIDER_VIEW} FROM hashed WHERE provider_id IS NOT NULL AND effective_at IS NOT NULL
  AND provider_tier <> 'GOLD' AND active_status <> 'PAUSED'"""

SQL["provider_changes_maintained"] = SQL["valid_provider_events"]

SQL["applicable_provider_events"] = f"""WITH {FAULTY_EVENTS}
SELECT provider_tier, active_status, count(*) AS events FROM faulty_events
WHERE provider_id IS NOT NULL AND effective_at IS NOT NULL GROUP BY 1, 2"""

SQL["missing_required_columns"] = f"""WITH {FAULTY}
SELECT CASE q WHEN 1 THEN 'customer_id' WHEN 2 THEN 'booking_created_at' WHEN 6 THEN 'final_amount'
  ELSE 'record_updated_at' END AS missing_columns, count(*) AS rows FROM faulty WHERE q IN (1, 2, 6, 8) GROUP BY 1"""

SQL["distinct_json_values"] = "SELECT count(DISTINCT json_extract_string(props, '$.k')) AS distinct_values FROM events"

SQL["distinct_raw_bookings"] = """SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) AS distinct_values
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SQL["json_value_counts"] = """
SELECT cast(json_extract_string(props, '$.k') AS bigint) AS k, count(*) AS rows FROM events GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM documents"""

# ---- dimensions

SQL["calendar"] = """
WITH bounds AS (SELECT min(cast(o_orderdate AS date)) AS a, max(cast(o_orderdate AS date)) AS b FROM orders),
days AS (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS date) AS d FROM bounds)
SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, cast(d AS varchar) AS full_date, strftime(d, '%a') AS day_name,
  isodow(d) AS day_of_week, weekofyear(d) AS week_number, month(d) AS month_number, strftime(d, '%b') AS month_name,
  quarter(d) AS quarter, year(d) AS year, isodow(d) >= 6 AS is_weekend FROM days"""

SQL["calendar_extended"] = SQL["calendar"].replace(
    "SELECT min(cast(o_orderdate AS date)) AS a, max(cast(o_orderdate AS date)) AS b FROM orders", "SELECT DATE '1996-01-01' AS a, DATE '1998-12-31' AS b")

SQL["customer_dimension"] = f"""
SELECT cast(c_custkey AS varchar) AS customer_id, c_name AS customer_name, upper(c_mktsegment) AS customer_segment,
  {_city('n_name')} AS home_city, cast(cast(DATE '1994-01-01' + cast(c_custkey % 365 AS integer) AS date) AS varchar) AS signup_date,
  c_acctbal >= 0 AS is_active, CASE WHEN c_acctbal >= 0 THEN '{FIRST}' ELSE '{SECOND}' END AS created_at,
  '{SECOND}' AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

SQL["service_dimension"] = f"""
SELECT cast(p_partkey AS varchar) AS service_id, p_name AS service_name, p_type AS service_category,
  cast(cast(p_retailprice AS decimal(12,2)) AS double) AS standard_price, cast(15 + p_size AS bigint) AS expected_duration_minutes,
  upper(p_brand) AS skill_level_required, true AS is_active,
  CASE WHEN cast(p_retailprice AS decimal(12,2)) < 1000 THEN '{FIRST}' ELSE '{SECOND}' END AS created_at,
  '{SECOND}' AS updated_at FROM part"""

SQL["surrogate_keys"] = f"""WITH {EVENTS}, {versions('events_in')},
counts AS (
  SELECT 'customers' AS object_name, count(*) AS n FROM customer
  UNION ALL SELECT 'moved_customers', 0
  UNION ALL SELECT 'services', count(*) FROM part
  UNION ALL SELECT 'provider_versions', count(*) FROM versions)
SELECT object_name, n AS rows, n AS distinct_keys, cast(0 AS bigint) AS invalid_keys FROM counts"""

# ---- provider history

SQL["provider_seed"] = f"""WITH {EVENTS},
experts AS (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY effective_at) AS rn FROM events_in
  WHERE experience_level = 'LEVEL 2' AND year(effective_at) = 1997),
everybody AS (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY effective_at) AS rn FROM events_in),
seeded AS (
  SELECT * FROM experts WHERE rn = 1 UNION ALL
  SELECT * FROM everybody WHERE rn = 1 AND provider_id NOT IN (SELECT provider_id FROM experts)),
dim AS (SELECT *, effective_at AS effective_start_at, TIMESTAMP '9999-12-31 00:00:00' AS effective_end_at, true AS is_current
  FROM seeded)
SELECT {VERSION_VIEW} FROM dim"""

SQL["latest_provider_changes"] = f"""WITH {EVENTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY effective_at DESC) AS rn FROM events_in)
SELECT {PROVIDER_VIEW} FROM ranked WHERE rn = 1"""

SQL["provider_batch_applied"] = f"""WITH {EVENTS},
early AS (SELECT * FROM events_in WHERE effective_at < TIMESTAMP '1998-01-01'),
{versions('early', 'dim')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY effective_at DESC) AS rn FROM events_in
  WHERE effective_at >= TIMESTAMP '1998-01-01'),
batch AS (
  SELECT * REPLACE (
    CASE WHEN operating_zone = 'Zone 1' THEN 'new-' || provider_id ELSE provider_id END AS provider_id,
    CASE WHEN operating_zone = 'Zone 0' THEN effective_at - INTERVAL 6 YEAR ELSE effective_at END AS effective_at)
  FROM ranked WHERE rn = 1),
closing AS (
  SELECT d.provider_id, b.effective_at AS closed_at FROM dim d JOIN batch b ON d.provider_id = b.provider_id
  WHERE d.is_current AND d.attribute_hash <> b.attribute_hash AND b.effective_at > d.effective_start_at),
result AS (
  SELECT d.* REPLACE (
    CASE WHEN is_current THEN coalesce(closed_at, effective_end_at) ELSE effective_end_at END AS effective_end_at,
    is_current AND closed_at IS NULL AS is_current)
  FROM dim d LEFT JOIN closing c ON c.provider_id = d.provider_id
  UNION ALL BY NAME
  SELECT b.* EXCLUDE (rn), b.effective_at AS effective_start_at, TIMESTAMP '9999-12-31 00:00:00' AS effective_end_at,
    true AS is_current
  FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.provider_id = b.provider_id AND d.is_current
                    AND d.attribute_hash = b.attribute_hash)
    AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.provider_id = b.provider_id AND d.is_current
                    AND b.effective_at <= d.effective_start_at))
SELECT {VERSION_VIEW} FROM result"""

SQL["provider_history"] = f"WITH {EVENTS}, {versions('events_in')} SELECT {VERSION_VIEW} FROM versions"

SQL["provider_history_applied"] = SQL["provider_history"]

_SAMPLE = ", ".join(f"'{p}'" for p in SAMPLE_PROVIDERS)
SQL["provider_sample_history"] = f"""WITH {EVENTS}, {versions('events_in')}
SELECT provider_id, provider_tier, primary_city, operating_zone, active_status,
  cast(effective_start_at AS varchar) AS effective_start_at, cast(effective_end_at AS varchar) AS effective_end_at, is_current
FROM versions WHERE provider_id IN ({_SAMPLE})"""

# ---- joins and marts

SQL["point_in_time_versions"] = f"""WITH {SNAP}, {EVENTS}, {versions('events_in')}
SELECT booking_id, source_row_number, s.provider_id, cast(booking_created_at AS varchar) AS booking_created_at,
  v.provider_tier, v.operating_zone, cast(v.effective_start_at AS varchar) AS effective_start_at
FROM snap s LEFT JOIN versions v ON v.provider_id = s.provider_id
  AND booking_created_at >= effective_start_at AND booking_created_at < effective_end_at"""

SQL["point_in_time_misses"] = f"""WITH {SNAP}, {EVENTS}, {versions('events_in')},
late AS (SELECT * REPLACE (effective_start_at + to_days(180) AS effective_start_at) FROM versions)
SELECT booking_id, source_row_number, s.provider_id, cast(booking_created_at AS varchar) AS booking_created_at,
  cast(v.effective_start_at AS varchar) AS effective_start_at
FROM snap s LEFT JOIN late v ON v.provider_id = s.provider_id
  AND booking_created_at >= effective_start_at AND booking_created_at < effective_end_at"""

SQL["point_in_time_overlapping"] = f"""WITH {SNAP}, {EVENTS}, {versions('events_in')},
longer AS (SELECT *, CASE WHEN is_current THEN effective_end_at ELSE effective_end_at + to_days(30) END AS until FROM versions)
SELECT booking_id, source_row_number, s.provider_id, cast(booking_created_at AS varchar) AS booking_created_at,
  v.provider_tier, cast(v.effective_start_at AS varchar) AS effective_start_at
FROM snap s LEFT JOIN longer v ON v.provider_id = s.provider_id
  AND booking_created_at >= effective_start_at AND booking_created_at < until"""

SQL["fact_booking"] = f"""WITH {FACT}
SELECT booking_id, cast(booking_date_key AS bigint) AS booking_date_key, booking_city, booking_status, payment_method,
  cast(booking_created_at AS varchar) AS booking_created_at, cast(scheduled_at AS varchar) AS scheduled_at,
  cast(service_started_at AS varchar) AS service_started_at, cast(service_completed_at AS varchar) AS service_completed_at,
  cast(gross_amount AS double) AS gross_amount, cast(discount_amount AS double) AS discount_amount,
  cast(tax_amount AS double) AS tax_amount, cast(final_amount AS double) AS final_amount,
  mins AS service_duration_minutes, cast(rating AS bigint) AS rating, cast(done AS bigint) AS completed_booking_count,
  cast(lost AS bigint) AS cancelled_booking_count, cast(record_updated_at AS varchar) AS record_updated_at, source_filename,
  customer_id, service_id, provider_id, cast(version_start_at AS varchar) AS version_start_at FROM fact"""

KPI = f"""kpi AS (
  SELECT booking_date_key, booking_date, booking_city, service_category, count(*) AS total_bookings,
    sum(done) AS completed_bookings, sum(lost) AS cancelled_bookings,
    {rate('sum(done)', 'count(*)')} AS completion_rate, {rate('sum(lost)', 'count(*)')} AS cancellation_rate,
    sum(final_amount) AS total_revenue, {mean('sum(rating)', 'count(rating)')} AS average_rating,
    count(review_id) AS enriched_review_count,
    count(CASE WHEN sentiment_label = 'negative' THEN 1 END) AS negative_review_count
  FROM fact GROUP BY 1, 2, 3, 4)"""

KPI_VIEW = """cast(booking_date_key AS bigint) AS booking_date_key, cast(booking_date AS varchar) AS booking_date, booking_city,
  service_category, total_bookings, cast(completed_bookings AS bigint) AS completed_bookings,
  cast(cancelled_bookings AS bigint) AS cancelled_bookings, completion_rate, cancellation_rate,
  cast(total_revenue AS double) AS total_revenue, average_rating, enriched_review_count, negative_review_count"""

SQL["daily_service_kpi"] = f"WITH {FACT}, {KPI} SELECT {KPI_VIEW} FROM kpi"
SQL["stored_kpi"] = SQL["daily_service_kpi"]
SQL["refreshed_kpi"] = SQL["daily_service_kpi"]
SQL["kpi_by_deltas"] = SQL["daily_service_kpi"]
SQL["newest_kpis"] = f"""WITH {FACT}, {KPI}, newest AS (
  SELECT * FROM kpi ORDER BY booking_date DESC, total_revenue DESC, booking_city, service_category LIMIT 20)
SELECT {KPI_VIEW} FROM newest"""
SQL["kpis_since_day"] = f"""WITH {FACT}, {KPI}
SELECT cast(booking_date AS varchar) AS booking_date, booking_city, service_category, total_bookings, cancellation_rate,
  cast(total_revenue AS double) AS total_revenue, average_rating, enriched_review_count, negative_review_count
FROM kpi WHERE booking_date >= DATE '{CUT_OFF}'"""

SQL["overlapping_interval_pairs"] = """
WITH spans AS (
  SELECT l_suppkey, l_shipdate AS s, l_shipdate + to_days(cast(l_quantity AS integer)) AS e, row_number() OVER () AS n
  FROM lineitem)
SELECT a.l_suppkey, count(b.n) AS overlapping_pairs FROM spans a
LEFT JOIN spans b ON a.l_suppkey = b.l_suppkey AND a.n < b.n AND a.s < b.e AND b.s < a.e GROUP BY 1"""

# ---- review scoring

DOCS = scored("documents", "text", "docs")

SQL["scored_documents"] = f"WITH {DOCS} SELECT doc_id, sentiment_label, complaint_category FROM docs"
SQL["scored_with_gaps"] = f"""WITH {DOCS}
SELECT lang, sentiment_label, count(*) AS rows FROM docs GROUP BY 1, 2
UNION ALL SELECT n_name, NULL, count(*) FROM nation GROUP BY 1"""

_WEIGHTS = {"the": 2, "la": 2, "der": 3, "and": 1, "un": 1, "of": -1, "de": -2, "in": -2, "le": -3, "that": -1}


def _side(sign: int) -> str:
    return " + ".join(f"{abs(w)} * len(list_filter(toks, lambda t: t = '{word}'))" for word, w in _WEIGHTS.items() if w * sign > 0)


def _service_scored(text: str) -> str:
    """Every word of a text joined to the lexicon's lists as tables; sums by text."""
    weights = ", ".join(f"('{w}', {side}, {v})" for side, words in ((1, SERVICE_LEXICON.positive), (2, SERVICE_LEXICON.negative)) for w, v in words.items())
    keywords = ", ".join(f"('{w}', {i}, '{name}')" for i, (name, words) in enumerate(SERVICE_LEXICON.themes.items()) for w in words)
    return f"""
weights(word, side, v) AS (VALUES {weights}),
keywords(word, place, theme) AS (VALUES {keywords}),
said AS (SELECT doc_id, unnest(string_split_regex(lower({text}), '[^a-z]+')) AS word FROM documents),
sides AS (SELECT doc_id, coalesce(sum(v) FILTER (side = 1), 0) AS pos, coalesce(sum(v) FILTER (side = 2), 0) AS neg FROM said JOIN weights USING (word) GROUP BY 1),
mentions AS (SELECT doc_id, theme, place, count(*) AS n FROM said JOIN keywords USING (word) GROUP BY ALL),
foremost AS (SELECT doc_id, arg_min(theme, -n * 100 + place) AS theme FROM mentions GROUP BY 1),
service AS (
  SELECT doc_id, text IS NOT NULL AS given, theme, CASE
      WHEN coalesce(pos, 0) = 0 AND coalesce(neg, 0) = 0 THEN 'neutral' WHEN neg > 3 * pos THEN 'negative'
      WHEN pos > 3 * neg THEN 'positive' ELSE 'mixed' END AS label
  FROM documents LEFT JOIN sides USING (doc_id) LEFT JOIN foremost USING (doc_id)),
service_scored AS (
  SELECT doc_id, CASE WHEN given THEN label END AS sentiment_label,
    CASE WHEN given THEN coalesce(theme, CASE WHEN label IN ('negative', 'mixed') THEN 'Other' ELSE 'No Complaint' END) END AS complaint_category
  FROM service)"""


SQL["service_scored_documents"] = f"WITH {_service_scored('text')} SELECT * FROM service_scored"


def _stands_for(text: str) -> str:
    """DuckDB's expressions look at no neighbours, so words are told apart by splitting."""
    cases = " ".join(f"WHEN w = '{a}' THEN '{b}'" for a, b in STANDS_FOR.items())
    return (f"array_to_string(list_transform(string_split_regex(lower({text}), '[^a-z]+'), lambda w: CASE {cases} ELSE w END), ' ')")


SQL["theme_word_documents"] = f"""WITH {_service_scored(_stands_for('text'))}
SELECT sentiment_label, complaint_category, count(*) AS documents, cast(sum(doc_id) AS bigint) AS id_sum FROM service_scored GROUP BY 1, 2"""

SQL["weighed_documents"] = f"""
WITH words AS (SELECT doc_id, string_split_regex(lower(text), '[^a-z]+') AS toks FROM documents),
sums AS (SELECT doc_id, {_side(1)} AS p, {_side(-1)} AS n, {hits("'to','die'")} AS punctuality,
  {hits("'is','el','und'")} AS pricing, {hits("'it','en'")} AS communication FROM words),
labelled AS (SELECT *, CASE WHEN p + n = 0 THEN 'neutral' WHEN n > 3 * p THEN 'negative' WHEN p > 3 * n THEN 'positive' ELSE 'mixed' END
  AS sentiment_label FROM sums)
SELECT doc_id, sentiment_label, CASE WHEN greatest(punctuality, pricing, communication) = 0
    THEN CASE WHEN sentiment_label IN ('negative', 'mixed') THEN 'Other' ELSE 'No Complaint' END
  WHEN punctuality >= pricing AND punctuality >= communication THEN 'Punctuality'
  WHEN pricing >= communication THEN 'Pricing' ELSE 'Communication' END AS complaint_category FROM labelled"""
SQL["function_scored_documents"] = f"""WITH {DOCS}, named AS (
  SELECT CASE WHEN regexp_matches(lower(text), '[a-z]') THEN sentiment_label END AS sentiment_label,
    CASE WHEN regexp_matches(lower(text), '[a-z]') THEN 'Other' END AS complaint_category FROM docs)
SELECT sentiment_label, complaint_category, count(*) AS rows FROM named GROUP BY 1, 2"""
SQL["score_agreement"] = f"""WITH {DOCS}, judged AS (
  SELECT CASE WHEN toxic = 1 THEN 'negative' ELSE 'neutral' END AS expected, sentiment_label AS predicted
  FROM docs JOIN labels USING (doc_id)),
whole AS (SELECT count(CASE WHEN expected = predicted THEN 1 END) AS hit, count(*) AS n FROM judged)
SELECT expected, predicted, count(*) AS rows, (SELECT {rate('hit', 'n')} FROM whole) AS accuracy
FROM judged GROUP BY 1, 2"""

SQL["newest_review_candidates"] = f"""WITH {LATEST}, newest AS (
  SELECT * FROM latest WHERE booking_status = 'COMPLETED' AND review_text IS NOT NULL
  ORDER BY booking_created_at DESC, booking_id LIMIT 100)
SELECT booking_id, sha256(review_text) AS review_hash FROM newest"""

ARRIVING = """
arriving AS (
  SELECT booking_id, review_text, sha256(review_text) AS review_hash FROM (
    SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY record_updated_at DESC, sha256(review_text)) AS arn
    FROM snap WHERE review_text IS NOT NULL) WHERE arn = 1
)"""

SQL["arriving_review_candidates"] = f"WITH {SNAP}, {ARRIVING} SELECT booking_id, review_hash FROM arriving"
SQL["changed_reviews"] = f"""WITH {LATEST}, {REVIEWED}, {ARRIVING}
SELECT booking_id, review_hash FROM arriving
WHERE (booking_id, review_hash) NOT IN (SELECT (booking_id, sha256(review_text)) FROM reviews)"""

INSIGHT_VIEW = """booking_id, sha256(review_text) AS review_hash, sentiment_label, complaint_category,
  cast(NULL AS varchar) AS review_summary, model_source, processed_at"""

SQL["review_insight_backfill"] = f"""WITH {LATEST}, {REVIEWED}, marked AS (
  SELECT *, CASE WHEN final_amount < 40000 AND sentiment_label <> 'negative' THEN 'EARLIER' ELSE 'BACKFILL' END AS model_source,
    CASE WHEN final_amount < 40000 AND sentiment_label <> 'negative' THEN '{FIRST}' ELSE '{SECOND}' END AS processed_at
  FROM reviews)
SELECT {INSIGHT_VIEW} FROM marked"""

SQL["review_insight_live"] = f"""WITH {LATEST}, {REVIEWED}, {ARRIVING}, {scored('arriving', 'review_text', 'live')},
known AS (SELECT booking_id, sha256(review_text) AS review_hash FROM reviews),
marked AS (
  SELECT l.booking_id, l.review_text, l.sentiment_label, l.complaint_category,
    CASE WHEN k.booking_id IS NULL THEN 'LIVE' ELSE 'BACKFILL' END AS model_source,
    CASE WHEN k.booking_id IS NULL THEN '{SECOND}' ELSE '{FIRST}' END AS processed_at
  FROM live l LEFT JOIN known k ON k.booking_id = l.booking_id AND k.review_hash = l.review_hash)
SELECT {INSIGHT_VIEW} FROM marked"""

# ---- reports and gates

SQL["dimension_counts"] = f"""WITH {EVENTS}, {versions('events_in')}
SELECT 'DIM_DATE' AS object_name, (SELECT cast(date_diff('day', date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR) AS bigint)
  FROM orders) AS row_count
UNION ALL SELECT 'DIM_CUSTOMER', count(*) FROM customer
UNION ALL SELECT 'DIM_SERVICE', count(*) FROM part
UNION ALL SELECT 'DIM_PROVIDER', count(*) FROM versions"""

SQL["layer_reconciliation"] = f"""WITH {FACT}
SELECT 'RAW_BOOKING_ROWS' AS measure, count(*) AS value FROM snap
UNION ALL SELECT 'RAW_DISTINCT_BOOKINGS', count(DISTINCT booking_id) FROM snap
UNION ALL SELECT 'LATEST_BOOKINGS', count(*) FROM latest
UNION ALL SELECT 'FACT_BOOKINGS', count(*) FROM fact
UNION ALL SELECT 'ENRICHED_REVIEWS', count(*) FROM reviews"""

SQL["review_label_counts"] = f"""WITH {LATEST}, {REVIEWED}
SELECT sentiment_label, complaint_category, count(*) AS review_count FROM reviews GROUP BY 1, 2"""

SQL["overall_health"] = f"""WITH {FACT}
SELECT count(*) AS total_fact_rows, {big('sum(done)')} AS completed_bookings, {big('sum(lost)')} AS cancelled_bookings,
  {rate('sum(done)', 'count(*)')} AS completion_rate, {rate('sum(lost)', 'count(*)')} AS cancellation_rate,
  {money('final_amount')} AS net_revenue, {mean('sum(rating)', 'count(rating)')} AS average_rating FROM fact"""

SQL["baseline_snapshot"] = f"""WITH {LATEST}, f AS (
  SELECT *, CASE WHEN booking_status = 'CANCELLED' THEN 1 ELSE 0 END AS lost FROM latest)
SELECT count(*) AS fact_bookings, {money('final_amount')} AS net_revenue,
  {rate('sum(lost)', 'count(*)')} AS cancellation_rate FROM f"""

SQL["enrichment_coverage"] = f"""WITH {LATEST}, {REVIEWED}, sides AS (
  SELECT (SELECT count(review_text) FROM latest) AS c, (SELECT count(*) FROM reviews) AS e)
SELECT c AS review_candidates, e AS enriched_reviews, {rate('e', 'c')} AS enrichment_coverage FROM sides"""

SQL["run_history"] = """
SELECT event_type || '-' || event_id AS name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
  CASE WHEN event_type = 'error' THEN props END AS error_message, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(ts + to_minutes(cast(floor(value) AS integer)), '%Y-%m-%d %H:%M:%S') AS completed_at
FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR"""

SQL["last_outcomes"] = """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT event_type AS name, CASE WHEN value > 50 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, event_id AS input_rows,
  props AS error_message FROM ranked WHERE rn = 1"""

SQL["unexpected_counts"] = """
SELECT 'DIM_SERVICE' AS object_name, cast(0 AS bigint) AS expected_count, count(*) AS row_count FROM part
UNION ALL SELECT 'DIM_NOWHERE', 5, NULL"""


def gates(snapshots: str, fact: str, dims: str, missing: str, no_date: str, broken: str) -> str:
    """Every gate by definition, over CTEs of these names; `n` tells versions apart."""
    return f"""SELECT 'duplicate_latest_bookings' AS check_name, count(*) AS violations FROM
  (SELECT booking_id FROM {snapshots} GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_fact_bookings', count(*) FROM (SELECT booking_id FROM {fact} GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'missing_dimension_keys', count(*) FROM {fact} WHERE version_start_at IS NULL OR {missing}
UNION ALL SELECT 'invalid_date_keys', count(*) FROM {fact} WHERE booking_date IS NULL OR {no_date}
UNION ALL SELECT 'current_version_count', count(*) FROM
  (SELECT provider_id FROM {dims} GROUP BY 1 HAVING count(CASE WHEN is_current THEN 1 END) <> 1)
UNION ALL SELECT 'invalid_intervals', count(*) FROM {dims} WHERE effective_start_at >= effective_end_at
UNION ALL SELECT 'overlapping_intervals', count(*) FROM {dims} a JOIN {dims} b ON a.provider_id = b.provider_id AND a.n < b.n
  AND a.effective_start_at < b.effective_end_at AND b.effective_start_at < a.effective_end_at
UNION ALL SELECT 'invalid_measures', count(*) FROM {fact} WHERE {broken}"""


SQL["quality_gates"] = f"""WITH {FACT}, numbered AS (SELECT *, row_number() OVER () AS n FROM versions)
{gates("latest", "fact", "numbered", "customer_segment IS NULL OR service_name IS NULL",
       "booking_date < (SELECT date_trunc('year', min(o_orderdate)) FROM orders)",
       "final_amount < 0 OR discount_amount < 0 OR rating NOT BETWEEN 1 AND 5 OR mins < 0")}"""

SQL["gates_on_broken_tables"] = f"""WITH {FACT},
moved AS (
  SELECT * REPLACE (CASE WHEN is_current THEN effective_end_at WHEN operating_zone = 'Zone 3' THEN effective_start_at
    WHEN operating_zone = 'Zone 2' THEN effective_end_at + INTERVAL 1 YEAR ELSE effective_end_at END AS effective_end_at),
    row_number() OVER () AS n
  FROM versions WHERE NOT (is_current AND operating_zone = 'Zone 0')),
broken AS (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE booking_city = 'Nation_2')
{gates("snap", "broken", "moved", "booking_city IN ('Nation_1', 'Nation_3', 'Nation_4', 'Nation_5')",
       "year(booking_date) >= 1998 OR booking_city = 'Nation_5'",
       "rating + 1 > 5 OR (payment_method = '5-LOW' AND discount_amount > 0) OR (booking_status = 'CANCELLED' AND final_amount > 0) "
       "OR (payment_method = '2-HIGH' AND mins > 0)")}"""

SQL["duplicate_bookings"] = f"""WITH {SNAP}
SELECT booking_id, count(*) AS duplicate_count FROM snap GROUP BY 1 HAVING count(*) > 1"""

SQL["current_version_exceptions"] = f"""WITH {EVENTS}, {versions('events_in')}
SELECT provider_id, count(CASE WHEN is_current THEN 1 END) AS current_version_count
FROM versions WHERE NOT (is_current AND operating_zone = 'Zone 0') GROUP BY 1
HAVING count(CASE WHEN is_current THEN 1 END) <> 1"""

SQL["cancellation_by_city"] = f"""WITH {FACT}
SELECT booking_city, {rate('sum(lost)', 'count(*)')} AS cancellation_rate, count(*) AS total_bookings FROM fact GROUP BY 1"""
SQL["revenue_and_rating_by_category"] = f"""WITH {FACT}
SELECT service_category, {money('final_amount')} AS net_revenue, {mean('sum(rating)', 'count(rating)')} AS average_rating
FROM fact GROUP BY 1"""
SQL["category_share"] = f"""WITH {FACT}
SELECT service_category, count(*) AS total_bookings, {money('final_amount')} AS net_revenue,
  {rate('count(*)', '(SELECT count(*) FROM fact)')} AS booking_share FROM fact GROUP BY 1"""
SQL["cancellation_by_city_and_category"] = f"""WITH {FACT}
SELECT booking_city, service_category, count(*) AS total_bookings, {rate('sum(lost)', 'count(*)')} AS cancellation_rate
FROM fact GROUP BY 1, 2"""
SQL["low_ratings_by_city_and_category"] = f"""WITH {FACT}
SELECT booking_city, service_category, {mean('sum(rating)', 'count(rating)')} AS average_rating,
  {rate('count(CASE WHEN rating <= 3 THEN 1 END)', 'count(rating)')} AS low_rating_share FROM fact GROUP BY 1, 2"""
SQL["tier_advantage"] = f"""WITH {FACT}
SELECT provider_tier, count(*) AS total_bookings, {rate('sum(done)', 'count(*)')} AS completion_rate,
  {mean('sum(rating)', 'count(rating)')} AS average_rating FROM fact WHERE provider_tier IS NOT NULL GROUP BY 1"""
SQL["weekend_demand"] = f"""WITH {FACT},
days AS (SELECT cast(unnest(generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders), (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY)) AS date) AS d),
booked AS (SELECT booking_date, count(*) AS n FROM fact GROUP BY 1)
SELECT isodow(d) >= 6 AS is_weekend, count(*) AS calendar_days, {big('coalesce(sum(n), 0)')} AS total_bookings,
  {mean('coalesce(sum(n), 0)', 'count(*)')} AS bookings_per_day
FROM days LEFT JOIN booked ON d = booking_date GROUP BY 1"""
SQL["negative_themes"] = f"""WITH {LATEST}, {REVIEWED}
SELECT complaint_category, count(*) AS review_count FROM reviews WHERE sentiment_label = 'negative' GROUP BY 1"""
SQL["version_change_kinds"] = f"""WITH {EVENTS}, {versions('events_in')}, walked AS (
  SELECT provider_tier <> lag(provider_tier) OVER w AS t, operating_zone <> lag(operating_zone) OVER w AS z,
    primary_city <> lag(primary_city) OVER w AS c, active_status <> lag(active_status) OVER w AS a
  FROM versions WINDOW w AS (PARTITION BY provider_id ORDER BY effective_start_at)),
kinds AS (
  SELECT 'provider_tier' AS changed_attribute, count(CASE WHEN t THEN 1 END) AS versions FROM walked
  UNION ALL SELECT 'operating_zone', count(CASE WHEN z THEN 1 END) FROM walked
  UNION ALL SELECT 'primary_city', count(CASE WHEN c THEN 1 END) FROM walked
  UNION ALL SELECT 'active_status', count(CASE WHEN a THEN 1 END) FROM walked)
SELECT * FROM kinds WHERE versions > 0"""

# ---- metrics and questions

METRIC_SQL = {
    "total_bookings": "count(booking_id)",
    "completed_bookings": big("sum(done)"),
    "cancelled_bookings": big("sum(lost)"),
    "completion_rate": rate("sum(done)", "count(*)"),
    "cancellation_rate": rate("sum(lost)", "count(*)"),
    "gross_revenue": money("gross_amount"),
    "net_revenue": money("final_amount"),
    "average_booking_value": mean("cast(sum(final_amount) * 100 AS hugeint)", "count(*)").replace("* 200", "* 2"),
    "average_rating": mean("sum(rating)", "count(rating)"),
    "average_service_duration": mean("sum(mins)", "count(mins)"),
    "enriched_review_count": "count(review_id)",
    "negative_review_count": "count(CASE WHEN sentiment_label = 'negative' THEN 1 END)",
}

# Calendar dimensions of a booking, by result name.
DIMENSION_SQL = {
    "booking_date": "cast(booking_date AS varchar)",
    "year": "year(booking_date)",
    "quarter": "quarter(booking_date)",
    "month_name": "strftime(booking_date, '%b')",
    "day_name": "strftime(booking_date, '%a')",
    "is_weekend": "isodow(booking_date) >= 6",
    "sentiment": "sentiment_label",
    "complaint_theme": "complaint_category",
}


def metrics(names: list[str], dimensions: list[str] = (), where: str = "true") -> str:
    dims = [f"{DIMENSION_SQL.get(d, d)} AS {d}" for d in dimensions]
    columns = dims + [f"{METRIC_SQL[n]} AS {n}" for n in names]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(dims)))}" if dims else ""
    return f"WITH {FACT} SELECT {', '.join(columns)} FROM fact WHERE {where}{group}"


EVERY = list(METRIC_SQL)
SQL["metrics_overall"] = metrics(EVERY)
SQL["metrics_by_city_and_category"] = metrics(EVERY, ["booking_city", "service_category"])
SQL["metrics_by_status_and_payment"] = metrics(EVERY, ["booking_status", "payment_method"])
SQL["metrics_by_calendar"] = metrics(EVERY, ["year", "quarter", "month_name", "day_name", "is_weekend"])
SQL["metrics_by_date"] = metrics(EVERY, ["booking_date"])
SQL["metrics_by_customer"] = metrics(EVERY, ["customer_segment", "customer_home_city"])
SQL["metrics_by_provider"] = metrics(EVERY, ["provider_id", "provider_name", "provider_city"])
SQL["metrics_by_provider_state"] = metrics(EVERY, ["operating_zone", "provider_tier", "experience_level", "active_status"])
SQL["metrics_by_service"] = metrics(EVERY, ["service_name", "skill_level_required"])
SQL["metrics_by_review"] = metrics(EVERY, ["sentiment", "complaint_theme"])
SQL["metrics_by_booking"] = metrics(["net_revenue", "average_rating", "enriched_review_count"], ["booking_id"])
SQL["metrics_by_synonym"] = metrics(
    ["gross_revenue", "net_revenue", "average_booking_value"], ["booking_city", "customer_segment"],
    f"booking_status IN ('COMPLETED', 'BOOKED') AND booking_date >= DATE '{CUT_OFF}'")
SQL["city_volume_and_cancellation"] = metrics(["total_bookings", "cancellation_rate"], ["booking_city"])
SQL["verified_cancellation_rate_by_city"] = f"""WITH {FACT}
SELECT booking_city, sum(lost) / nullif(count(*), 0) AS cancellation_rate FROM fact GROUP BY booking_city"""
SQL["verified_revenue_by_category"] = metrics(["net_revenue"], ["service_category"])
SQL["revenue_by_city"] = metrics(["net_revenue"], ["booking_city"])
SQL["revenue_by_category"] = f"""WITH {LATEST}
SELECT p_type AS service_category, {money('final_amount')} AS net_revenue FROM latest
JOIN part ON service_id = cast(p_partkey AS varchar) GROUP BY 1"""
SQL["cancellation_trend"] = f"""WITH {FACT}, monthly AS (
  SELECT booking_city, strftime(booking_date, '%Y-%m') AS booking_month, {rate('sum(lost)', 'count(*)')} AS cancellation_rate
  FROM fact GROUP BY 1, 2),
walked AS (SELECT m.*, b.cancellation_rate AS previous_rate FROM monthly m LEFT JOIN monthly b ON b.booking_city = m.booking_city
  AND b.booking_month = strftime(strptime(m.booking_month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m'))
SELECT *, cancellation_rate > previous_rate AS increased FROM walked"""
SQL["tier_and_experience"] = metrics(["completion_rate", "average_rating"], ["provider_tier", "experience_level"])
SQL["segments_by_category"] = metrics(["total_bookings"], ["customer_segment", "service_category"])
SQL["negative_complaint_themes"] = metrics(["enriched_review_count"], ["complaint_theme"], "sentiment_label = 'negative'")
SQL["actual_and_expected_duration"] = f"""WITH {FACT},
actual AS (SELECT service_name, {METRIC_SQL['average_service_duration']} AS average_service_duration FROM fact GROUP BY 1),
expected AS (SELECT p_name AS service_name, {mean('sum(15 + p_size)', 'count(*)')} AS expected_duration FROM part GROUP BY 1)
SELECT * FROM actual JOIN expected USING (service_name)"""
SQL["needs_attention"] = metrics(["cancellation_rate", "average_rating", "negative_review_count"],
                                 ["booking_city", "service_category"])
SQL["city_summary"] = metrics(["total_bookings", "completion_rate", "cancellation_rate", "net_revenue"], ["booking_city"])
SQL["before_and_after_day"] = f"""WITH {FACT}
SELECT booking_city, service_category, CASE WHEN booking_date < DATE '{CUT_OFF}' THEN 'before' ELSE 'after' END AS period,
  count(*) AS total_bookings, {METRIC_SQL['cancellation_rate']} AS cancellation_rate, {METRIC_SQL['net_revenue']} AS net_revenue,
  {METRIC_SQL['average_rating']} AS average_rating FROM fact GROUP BY 1, 2, 3"""
SQL["tier_changers"] = f"""WITH {FACT},
changers AS (SELECT provider_id FROM versions GROUP BY 1 HAVING count(DISTINCT provider_tier) > 1)
SELECT v.provider_id, v.provider_tier, cast(v.effective_start_at AS varchar) AS effective_start_at,
  count(booking_id) AS total_bookings, {rate('coalesce(sum(done), 0)', 'count(booking_id)')} AS completion_rate,
  {mean('sum(rating)', 'count(rating)')} AS average_rating
FROM versions v JOIN changers USING (provider_id)
LEFT JOIN fact f ON f.provider_id = v.provider_id AND f.version_start_at = v.effective_start_at GROUP BY ALL"""
SQL["completed_only"] = metrics(["total_bookings", "net_revenue", "average_rating"], ["booking_city"],
                                "booking_status = 'COMPLETED'")
