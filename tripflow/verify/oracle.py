"""The same results in SQL, written independently: nothing is imported from the operators."""

from __future__ import annotations

# What the queries are asked for.
DRIFT_FROM = "1998-06-01 00:00:00"
MONTH = ("1998-06-01", "1998-06-30")
NINETEEN_MONTHS = ("1998-06-01", "1999-12-31")
PREVIEW_ROWS = 100
SINCE = "2024-01-05 00:00:00"
VENDOR = 1

# Payment codes and their texts.
PAYMENT_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Summed columns and the ends of their names in the report.
REVENUE_MEASURES = {
    "fare_amount": "fare",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "ehail_fee": "ehail_fee",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
}

# Columns of a staged trip and their types.
TRIP_TYPES = {
    "vendorid": "INTEGER",
    "ratecodeid": "INTEGER",
    "pickup_locationid": "INTEGER",
    "dropoff_locationid": "INTEGER",
    "pickup_datetime": "TIMESTAMP",
    "dropoff_datetime": "TIMESTAMP",
    "store_and_fwd_flag": "VARCHAR",
    "passenger_count": "INTEGER",
    "trip_distance": "DECIMAL(18,6)",
    "trip_type": "INTEGER",
    **dict.fromkeys(REVENUE_MEASURES, "DECIMAL(18,2)"),
    "payment_type": "INTEGER",
}

MONEY = list(REVENUE_MEASURES)
SHARED_MONEY = [m for m in MONEY if m != "ehail_fee"]

# One raw trip per lineitem row; yellow trips have a fixed type and no hail fee.
RAW = """raw AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'Green' ELSE 'Yellow' END AS service_type,
    l_suppkey AS vendorid,
    l_linenumber % 6 + 1 AS ratecodeid,
    l_partkey % 26 AS pulocationid,
    l_orderkey % 26 AS dolocationid,
    l_shipdate AS pickup_datetime,
    l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) AS dropoff_datetime,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    l_quantity AS trip_distance,
    CASE WHEN l_linestatus = 'F' THEN l_linenumber % 2 + 1 ELSE 1 END AS trip_type,
    l_extendedprice AS fare_amount,
    l_discount * 10 AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    floor(l_extendedprice) * l_discount AS tip_amount,
    l_tax * 100 AS tolls_amount,
    CASE WHEN l_linestatus = 'F' THEN l_tax * 10 ELSE 0 END AS ehail_fee,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    l_extendedprice + l_discount * 10 + l_tax * 100 AS total_amount,
    l_partkey % 7 AS payment_type,
    CASE WHEN l_linenumber > 3 THEN CAST(2.5 AS DOUBLE) ELSE 0 END AS congestion_surcharge
  FROM lineitem)"""

ZONES = """zones AS (
  SELECT n_nationkey AS locationid,
    CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
    n_name AS zone,
    replace(CASE WHEN r_name = 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END,
      'Boro', 'Green') AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_RAW_NAMES = {"pickup_locationid": "pulocationid", "dropoff_locationid": "dolocationid"}


def _typed(name: str) -> str:
    return f"CAST({_RAW_NAMES.get(name, name)} AS {TRIP_TYPES[name]}) AS {name}"


# Fixed value: the order that decides which of several trips with one key stays.
_ORDER_BY = [
    "ratecodeid", "pulocationid", "dolocationid", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "congestion_surcharge",
]
_ORDER = ", ".join(f"{n} ASC NULLS LAST" for n in _ORDER_BY)
_KEY = "md5(concat(CAST(vendorid AS VARCHAR), '-', CAST(pickup_datetime AS VARCHAR)))"
_DESCRIPTION = (
    "CASE CAST(payment_type AS INTEGER) "
    + " ".join(f"WHEN {code} THEN '{text}'" for code, text in PAYMENT_DESCRIPTIONS.items())
    + " END"
)

STAGED = f"""staged AS (
  SELECT {_KEY} AS tripid, service_type,
    {", ".join(_typed(n) for n in TRIP_TYPES)},
    {_DESCRIPTION} AS payment_type_description
  FROM raw WHERE vendorid IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY service_type, vendorid, pickup_datetime ORDER BY {_ORDER}) = 1)"""

FACT = """fact AS (
  SELECT s.*, p.borough AS pickup_borough, p.zone AS pickup_zone,
    q.borough AS dropoff_borough, q.zone AS dropoff_zone
  FROM staged s
  JOIN zones p ON s.pickup_locationid = p.locationid AND p.borough <> 'Unknown'
  JOIN zones q ON s.dropoff_locationid = q.locationid AND q.borough <> 'Unknown')"""


def _doubles(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" for n in names)


_STAGED_OUT = f"""tripid, {", ".join(n for n in TRIP_TYPES if n not in (*MONEY, "trip_distance"))},
    payment_type_description, {_doubles([*MONEY, "trip_distance"])}"""


def _staged_service(service: str) -> str:
    return f"""WITH {RAW}, {STAGED}
SELECT {_STAGED_OUT} FROM staged WHERE service_type = '{service}'"""


def _revenue(measures: list[str]) -> str:
    return ", ".join(
        f"CAST(sum(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) AS revenue_monthly_{REVENUE_MEASURES[m]}"
        for m in measures
    )


# Raw amounts are doubles: added as they are, and the total rounded to cents.
def _raw_revenue(measures: list[str]) -> str:
    return ", ".join(
        f"round(fsum({m}), 2) AS revenue_monthly_{REVENUE_MEASURES[m]}" for m in measures
    )


_RAW_MEANS = """fsum(passenger_count) / count(passenger_count) AS avg_montly_passenger_count,
    fsum(trip_distance) / count(trip_distance) AS avg_montly_trip_distance"""

_MEANS = """CAST(sum(CAST(passenger_count AS INTEGER)) AS DOUBLE) / count(passenger_count)
      AS avg_montly_passenger_count,
    CAST(sum(CAST(trip_distance AS DECIMAL(18,6))) AS DOUBLE) / count(trip_distance)
      AS avg_montly_trip_distance"""

MONTHLY_BY_NAME = f"""WITH {RAW}, {STAGED}, {ZONES}, {FACT}
SELECT pickup_zone AS revenue_zone,
    CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month, service_type,
    {_revenue(MONEY)}, count(tripid) AS total_monthly_trips, {_MEANS}
FROM fact GROUP BY ALL"""

MONTHLY_BY_ID = f"""WITH {RAW}
SELECT pulocationid AS revenue_zone,
    CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month, service_type,
    {_raw_revenue(SHARED_MONEY)}, {_RAW_MEANS}
FROM raw GROUP BY ALL"""

EVENT_TRIPS = """trips AS (
  SELECT CASE WHEN event_type IN ('click', 'signup') THEN 'Green' ELSE 'Yellow' END
      AS service_type,
    CAST(user_id % 26 AS INTEGER) AS zone, date_trunc('hour', ts) AS hour, ts,
    value AS amount
  FROM events)"""


def _hourly_side(service: str) -> str:
    name = service.lower()
    return f"""{name} AS (
  SELECT zone AS revenue_zone, CAST(hour AS TIMESTAMP) AS revenue_hour,
    round(fsum(amount), 2) AS revenue_hourly_total_amount_{name},
    count(*) AS number_records_{name}
  FROM trips WHERE service_type = '{service}' GROUP BY ALL)"""


_MERGED = f"""WITH {EVENT_TRIPS}, {_hourly_side("Green")}, {_hourly_side("Yellow")},
merged AS (SELECT * FROM green FULL OUTER JOIN yellow USING (revenue_zone, revenue_hour))"""
HOURLY_MERGE = f"{_MERGED}\nSELECT * FROM merged"
HOURLY_IN_ZONES = f"""{_MERGED}
SELECT revenue_zone, revenue_hour,
    revenue_hourly_total_amount_green, revenue_hourly_total_amount_yellow
FROM merged JOIN nation ON revenue_zone = n_nationkey"""

_COMMON = [
    "vendorid", "pickup_datetime", "dropoff_datetime", "ratecodeid", "pulocationid",
    "dolocationid", "store_and_fwd_flag", "passenger_count", "trip_distance", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "payment_type", "congestion_surcharge", "service_type",
]

FEATURES = """features AS (
  SELECT CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance,
    CAST(pulocationid AS VARCHAR) AS pulocationid, CAST(dolocationid AS VARCHAR) AS dolocationid,
    CAST(payment_type AS VARCHAR) AS payment_type, fare_amount, tolls_amount,
    tip_amount, vendorid, pickup_datetime
  FROM raw WHERE fare_amount <> 0)"""

# Ordinary least squares with one feature has a closed form.
FITTED = f"""split AS (SELECT *, substr({_KEY}, 1, 2) < 'cd' AS in_train FROM features),
line AS (
  SELECT regr_slope(tip_amount, fare_amount) AS slope,
    regr_intercept(tip_amount, fare_amount) AS intercept, avg(fare_amount) AS mean_fare
  FROM split WHERE in_train),
scored AS (SELECT *, slope * fare_amount + intercept AS predicted FROM split, line)"""

# With one number and one category the slope is that of deviations within the
# category, and a prediction is the category's mean and slope times deviation.
FITTED_WITHIN = f"""split AS (SELECT *, substr({_KEY}, 1, 2) < 'cd' AS in_train FROM features),
means AS (
  SELECT payment_type, count(*) AS n, avg(fare_amount) AS x, avg(tip_amount) AS y
  FROM split WHERE in_train GROUP BY payment_type),
line AS (
  SELECT sum((fare_amount - x) * (tip_amount - y)) / sum((fare_amount - x) * (fare_amount - x))
    AS slope
  FROM split JOIN means USING (payment_type) WHERE in_train),
whole AS (
  SELECT slope, sum(n * x) / sum(n) AS mean_x, sum(n * y) / sum(n) AS mean_y
  FROM means, line GROUP BY slope),
scored AS (
  SELECT s.*, y + slope * (fare_amount - x) AS predicted, mean_y AS baseline,
    slope * (fare_amount - mean_x) AS by_fare,
    (y - slope * x) - (mean_y - slope * mean_x) AS by_payment
  FROM split s JOIN means USING (payment_type), whole)"""

_SCORED = """passenger_count, trip_distance, pulocationid, dolocationid, payment_type, fare_amount,
  tolls_amount, tip_amount, vendorid, pickup_datetime, round(predicted, 4) AS predicted_tip_amount"""

# The penalties that the seeded search draws.
_PENALTIES = [
    (12.788535969157675, 0.0),
    (14.831009995196657, 0.1),
    (4.4642147629764555, 0.0),
    (13.533989748458225, 0.0),
    (11.809850248980794, 0.0),
]
_PENALTY_ROWS = ", ".join(f"({i}, CAST({l1} AS DOUBLE), CAST({l2} AS DOUBLE))" for i, (l1, l2) in enumerate(_PENALTIES))

_BY_ZONE = f"""WITH {RAW}, {FEATURES}, {FITTED}
SELECT pulocationid, count(*) AS trips, round(avg(predicted), 4) AS predicted_tip_amount
FROM scored GROUP BY pulocationid"""


def _info(name: str, numeric: bool) -> str:
    if numeric:
        value = f"CAST({name} AS DOUBLE)"
        middle = (
            f'min({value}) AS "min", max({value}) AS "max", round(avg({value}), 4) AS "mean", '
            f'round(stddev_samp({value}), 4) AS "stddev", CAST(NULL AS BIGINT) AS category_count'
        )
    else:
        none = "CAST(NULL AS DOUBLE)"
        middle = (
            f'{none} AS "min", {none} AS "max", {none} AS "mean", {none} AS "stddev", '
            f"count(DISTINCT {name}) AS category_count"
        )
    return (
        f"SELECT '{name}' AS input, {middle}, "
        f"count(*) FILTER ({name} IS NULL) AS null_count FROM features"
    )


_CATEGORIES = ("pulocationid", "dolocationid", "payment_type")
_NUMBERS = ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")


def _dates(bounds) -> str:
    low, high = bounds
    return f"CAST(l_shipdate AS DATE) BETWEEN DATE '{low}' AND DATE '{high}'"


def _violations(check: str, column: str, count: str, severity: str = "warn") -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS column_name, "
        f"'{severity}' AS severity, {count} AS violations"
    )


def _repeated(columns: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT 1 FROM staged GROUP BY {columns} HAVING count(*) > 1))"
    )


def _orphans(column: str, service: str = "") -> str:
    only = f"service_type = '{service}' AND " if service else ""
    return (
        f"(SELECT count(*) FROM staged WHERE {only}{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM nation WHERE n_nationkey = {column}))"
    )


_STAGED_COLUMNS = ["tripid", "service_type", *TRIP_TYPES, "payment_type_description"]

ORACLE: dict[str, str] = {
    "monthly_zone_revenue": MONTHLY_BY_NAME,
    "marts_job": MONTHLY_BY_NAME,
    "monthly_mart_from_days": MONTHLY_BY_NAME,
    "staging_green": _staged_service("Green"),
    "staging_yellow": _staged_service("Yellow"),
    "trip_keys": f"WITH {RAW} SELECT vendorid, pickup_datetime, {_KEY} AS tripid FROM raw",
    "first_trip_per_vendor_day": """
SELECT l_suppkey, l_shipdate, l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate
  ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey) = 1""",
    "dim_zones": f"WITH {ZONES} SELECT * FROM zones",
    "fact_trips": f"""WITH {RAW}, {STAGED}, {ZONES}, {FACT}
SELECT service_type, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, {_STAGED_OUT}
FROM fact""",
    "fact_trip_coverage": f"""WITH {RAW}, {STAGED}, {ZONES}, {FACT},
a AS (SELECT service_type, count(*) AS staged FROM staged GROUP BY ALL),
b AS (SELECT service_type, count(*) AS kept FROM fact GROUP BY ALL)
SELECT service_type, staged, kept, staged - kept AS dropped FROM a JOIN b USING (service_type)""",
    "monthly_revenue_by_zone_id": MONTHLY_BY_ID,
    "monthly_report_job": MONTHLY_BY_ID,
    "aligned_union": f"""WITH {RAW}
SELECT {", ".join(_COMMON)} FROM raw""",
    "service_counts": f'WITH {RAW} SELECT service_type, count(*) AS "count" FROM raw GROUP BY ALL',
    "service_union_job": f"""WITH {RAW}
SELECT service_type, payment_type, count(*) AS "count" FROM raw GROUP BY ALL""",
    "avg_distance_by_service": f"""WITH {RAW}
SELECT service_type, fsum(trip_distance) / count(trip_distance) AS avg_trip_distance
FROM raw GROUP BY ALL""",
    "hourly_revenue_green": f"""WITH {EVENT_TRIPS}
SELECT CAST(hour AS TIMESTAMP) AS hour, zone, round(fsum(amount), 2) AS amount,
    count(*) AS number_records
FROM trips WHERE service_type = 'Green' AND ts >= TIMESTAMP '{SINCE}' GROUP BY ALL""",
    "hourly_outer_merge": HOURLY_MERGE,
    "hourly_service_columns": HOURLY_MERGE,
    "hourly_green_yellow_merge": HOURLY_IN_ZONES,
    "hourly_merge_job": HOURLY_IN_ZONES,
    "trip_zone_names": f"""WITH {RAW}
SELECT pulocationid AS pickup_location, p.n_name AS pickup_zone,
    dolocationid AS dropoff_location, q.n_name AS dropoff_zone, trip_distance
FROM raw JOIN nation p ON pulocationid = p.n_nationkey
    JOIN nation q ON dolocationid = q.n_nationkey""",
    "zone_distances_job": f"""WITH {RAW}
SELECT p.n_name AS pickup_zone, q.n_name AS dropoff_zone, count(*) AS trips,
    fsum(trip_distance) AS distance
FROM raw JOIN nation p ON pulocationid = p.n_nationkey
    JOIN nation q ON dolocationid = q.n_nationkey GROUP BY ALL""",
    "long_paid_trips": f"""WITH {RAW}
SELECT vendorid, pickup_datetime, payment_type, trip_distance FROM raw
WHERE store_and_fwd_flag = 'N' AND payment_type <> 0
    AND pickup_datetime >= TIMESTAMP '2000-01-01' AND vendorid IS NOT NULL""",
    "trip_date_and_hours": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS pickup_date, value / 3600 AS trip_time_hr
FROM events""",
    "ordered_preview": f"""
SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT {PREVIEW_ROWS}""",
    "distinct_vendors_in_range": f"""
SELECT DISTINCT l_suppkey AS vendorid FROM lineitem WHERE {_dates(MONTH)}""",
    "vendor_trip_count_in_range": f"""
SELECT count(*) AS trips FROM lineitem WHERE {_dates(NINETEEN_MONTHS)} AND l_suppkey = {VENDOR}""",
    "partition_row_counts": """
SELECT 'events_dated' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_id,
  count(*) AS total_rows
FROM events GROUP BY ALL""",
    "reloaded_dates": """
SELECT *, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS total_rows FROM events""",
    "external_to_dated_job": "SELECT * FROM events",
    "external_csv_view": f"""WITH {ZONES}
SELECT * FROM zones UNION ALL SELECT * FROM zones""",
    "typed_feature_table": f"""WITH {RAW}
SELECT CAST(passenger_count AS BIGINT) AS passenger_count,
    CAST(payment_type AS VARCHAR) AS payment_type, fare_amount
FROM raw WHERE fare_amount <> 0""",
    "drifting_months": f"""WITH {RAW}
SELECT CAST(passenger_count AS INTEGER) AS passenger_count, count(*) AS trips,
    CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fare_amount,
    CAST(0 AS BIGINT) AS airport_fees
FROM (SELECT * FROM raw WHERE pickup_datetime < TIMESTAMP '{DRIFT_FROM}'
      UNION ALL SELECT * FROM raw WHERE pickup_datetime >= TIMESTAMP '{DRIFT_FROM}')
GROUP BY 1""",
    "quality_report": f"""WITH {RAW}, {STAGED}
{_violations("unique", "service_type+tripid", _repeated("service_type, tripid"))}
UNION ALL {_violations("unique", "tripid", _repeated("tripid"), "error")}
UNION ALL {_violations("not_null", "tripid",
    "(SELECT count(*) FROM staged WHERE tripid IS NULL)")}
UNION ALL {_violations("relationships", "pickup_locationid", _orphans("pickup_locationid"))}
UNION ALL {_violations("relationships", "dropoff_locationid (service_type = Green)",
    _orphans("dropoff_locationid", "Green"), "error")}
UNION ALL {_violations("relationships", "dropoff_locationid (service_type = Yellow)",
    _orphans("dropoff_locationid", "Yellow"))}
UNION ALL {_violations("accepted_values", "payment_type",
    "(SELECT count(*) FROM staged WHERE payment_type NOT BETWEEN 1 AND 6)")}""",
    "shared_trip_keys": f"""WITH {RAW}, {STAGED}
SELECT tripid, count(*) AS row_count FROM staged GROUP BY tripid HAVING count(*) > 1""",
    "trips_without_zone": f"""WITH {RAW}
SELECT pulocationid, count(*) AS row_count FROM raw
WHERE pulocationid NOT IN (SELECT n_nationkey FROM nation) GROUP BY ALL""",
    "column_profile": f"WITH {RAW}, {STAGED}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS row_count FROM staged"
        for c in _STAGED_COLUMNS
    ),
    "tip_features": f"""WITH {RAW}, {FEATURES}
SELECT * EXCLUDE (vendorid, pickup_datetime) FROM features""",
    "tip_feature_info": f"WITH {RAW}, {FEATURES}\n"
    + "\nUNION ALL ".join(
        [_info(n, True) for n in _NUMBERS] + [_info(n, False) for n in _CATEGORIES]
    ),
    "tip_model_eval": f"""WITH {RAW}, {FEATURES}, {FITTED},
e AS (SELECT tip_amount AS y, tip_amount - predicted AS err FROM scored WHERE NOT in_train)
SELECT count(*) AS "rows", round(avg(abs(err)), 4) AS mean_absolute_error,
    round(avg(err * err), 4) AS mean_squared_error,
    round(1 - avg(err * err) / var_pop(y), 4) AS r2_score,
    round(1 - var_pop(err) / var_pop(y), 4) AS explained_variance
FROM e""",
    "tip_prediction_by_zone": _BY_ZONE,
    "json_scored_by_zone": _BY_ZONE,
    "stream_scored_by_zone": f"""SELECT pulocationid, true AS scored, trips AS messages,
  predicted_tip_amount
FROM ({_BY_ZONE})
UNION ALL SELECT NULL, false, count(*), NULL FROM events""",
    "tip_attribution_by_zone": f"""WITH {RAW}, {FEATURES}, {FITTED}
SELECT pulocationid, round(avg(slope * mean_fare + intercept), 4) AS baseline_prediction,
    round(avg(slope * (fare_amount - mean_fare)), 4) AS attribution
FROM scored GROUP BY pulocationid""",
    "tip_predictions": f"""WITH {RAW}, {FEATURES}, {FITTED_WITHIN}
SELECT {_SCORED} FROM scored""",
    "tip_explained": f"""WITH {RAW}, {FEATURES}, {FITTED_WITHIN}
SELECT {_SCORED}, round(baseline, 4) AS baseline_prediction,
  CASE WHEN abs(by_fare) >= abs(by_payment) THEN 'fare_amount' ELSE 'payment_type' END AS feature_0,
  round(CASE WHEN abs(by_fare) >= abs(by_payment) THEN by_fare ELSE by_payment END, 4)
    AS attribution_0,
  CASE WHEN abs(by_fare) >= abs(by_payment) THEN 'payment_type' ELSE 'fare_amount' END AS feature_1,
  round(CASE WHEN abs(by_fare) >= abs(by_payment) THEN by_payment ELSE by_fare END, 4)
    AS attribution_1
FROM scored""",
    "tip_tuning": f"""WITH {RAW}, {FEATURES},
split AS (SELECT *, substr({_KEY}, 1, 2) < 'cd' AS in_train FROM features),
moments AS (
  SELECT avg(fare_amount) AS x, avg(tip_amount) AS y, covar_pop(fare_amount, tip_amount) AS xy,
    stddev_pop(fare_amount) AS px, stddev_pop(tip_amount) AS py
  FROM split WHERE in_train),
penalties(trial, l1, l2) AS (VALUES {_PENALTY_ROWS}),
lines AS (
  SELECT trial, l1, l2, greatest(xy / px - l1, 0) / (1 + l2 / py) / px AS slope, x, y
  FROM penalties, moments),
errors AS (
  SELECT trial, l1, l2, tip_amount AS t,
    tip_amount - (y + slope * (fare_amount - x)) AS e
  FROM split, lines WHERE NOT in_train),
report AS (
  SELECT trial, l1, l2, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(t) AS r2
  FROM errors GROUP BY trial, l1, l2)
SELECT trial, round(l1, 4) AS l1_reg, round(l2, 4) AS l2_reg, round(rmse, 4) AS rmse,
  round(r2, 4) AS r2_score, rmse = min(rmse) OVER () AS is_best
FROM report""",
    "batch_scored_trips": f"""WITH {RAW}
SELECT vendorid, pickup_datetime, pulocationid, dolocationid, trip_distance,
    trip_distance * 3 AS predicted_duration FROM raw""",
    "json_roundtrip": "SELECT event_id, user_id, value FROM events",
    "stream_json_events": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    CAST(NULL AS VARCHAR) AS malformed
FROM events""",
    "stream_resumed": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    CAST(NULL AS VARCHAR) AS malformed
FROM events""",
    "stream_by_batch": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    CAST(NULL AS VARCHAR) AS malformed
FROM events""",
    "produced_messages": "SELECT event_id, user_id, value FROM events",
    "seed_round_trip": """
SELECT CAST(n_nationkey AS INTEGER) AS locationid,
    CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
    n_name AS zone,
    CASE WHEN r_name = 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "output_file_count": "SELECT CAST(4 AS BIGINT) AS files, count(*) AS trips FROM lineitem",
    "sampled_staging": f"""WITH {RAW}, {STAGED}
SELECT tripid, service_type FROM staged ORDER BY tripid, service_type LIMIT {PREVIEW_ROWS}""",
    "registered_months": """
SELECT l_suppkey AS "VendorID", CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS "count"
FROM lineitem
WHERE l_linestatus = 'F' AND l_shipdate IS NOT NULL
GROUP BY 1, 2, 3""",
    "mart_descriptions": f"""WITH {RAW}, {STAGED}, {ZONES}, {FACT},
monthly AS (
  SELECT DISTINCT pickup_zone, date_trunc('month', pickup_datetime), service_type FROM fact),
texts(table_name, column_name, comment) AS (VALUES
  ('dim_zones', '', 'Places trips start and end in, one row per zone number'),
  ('dim_zones', 'locationid', 'Zone number that trips refer to'),
  ('dim_zones', 'borough', 'Borough of the zone; Unknown for numbers without a place'),
  ('dim_zones', 'zone', 'Zone name; several zones may share one'),
  ('dim_zones', 'service_zone', 'Area of service the zone belongs to'),
  ('monthly_zone_revenue', '', 'Revenue and trips by pickup zone name, month and service'),
  ('monthly_zone_revenue', 'revenue_zone', 'Pickup zone name'),
  ('monthly_zone_revenue', 'revenue_month', 'First instant of the month'),
  ('monthly_zone_revenue', 'service_type', 'Green or Yellow'),
  ('monthly_zone_revenue', 'revenue_monthly_total_amount',
    'Sum of all charges of the group''s trips'),
  ('monthly_zone_revenue', 'total_monthly_trips', 'Trips of the group'))
SELECT column_name, comment, table_name, CASE table_name
    WHEN 'dim_zones' THEN (SELECT count(*) + 1 FROM nation)
    ELSE (SELECT count(*) FROM monthly) END AS row_count
FROM texts""",
}
