"""The registered queries as SQL over the given tables, for an independent check."""

from __future__ import annotations

from cabtally.fixed_values import ID_NAMESPACE, PAYMENT_TYPES

TRIPS = """
trips AS (
  SELECT event_id AS trip_id,
         CAST(event_id % 2 + 1 AS INTEGER) AS vendorid,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS tpep_pickup_datetime,
         CAST(date_trunc('second', ts) + to_seconds((event_id * 37) % 3600) AS TIMESTAMP)
           AS tpep_dropoff_datetime,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id % 7 AS INTEGER) END
           AS passenger_count,
         value / 10 AS trip_distance,
         CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(event_id % 8 AS INTEGER) END
           AS payment_type,
         CAST(user_id % 27 AS INTEGER) AS pulocationid,
         CAST(event_id % 26 AS INTEGER) AS dolocationid,
         CAST(value AS DECIMAL(18,2)) AS total_amount
  FROM events
)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS locationid,
         'B' || CAST(n_regionkey AS VARCHAR) AS borough,
         n_name AS zone,
         CASE WHEN n_nationkey >= 23 THEN 'N/A' ELSE 'Boro Zone' END AS service_zone,
         CASE WHEN n_nationkey >= 23 THEN '#N/A' WHEN n_nationkey = 22 THEN '90.7'
              ELSE CAST(CAST(40 + n_nationkey * 0.01 AS DECIMAL(9,2)) AS VARCHAR) END AS latitude,
         CASE WHEN n_nationkey = 24 THEN '#N/A'
              ELSE CAST(CAST(-74 - n_nationkey * 0.01 AS DECIMAL(9,2)) AS VARCHAR) END AS longitude
  FROM nation
)"""

LABELS = (
    "\nlabels(payment_type, payment_type_name) AS (VALUES "
    + ", ".join(f"({code}, '{label}')" for code, label in PAYMENT_TYPES.items())
    + ")"
)

KEY_COLUMN = "CAST(1 AS INTEGER) AS partition_key"

ALL_TRIPS = f"WITH {TRIPS} SELECT * FROM trips"

PASSENGERS = f"""WITH {TRIPS}
SELECT passenger_count AS passenger_number, count(*) AS "count", {KEY_COLUMN}
FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1"""

PAYMENT = f"""WITH {TRIPS}, {LABELS},
counts AS (SELECT payment_type, count(*) AS "count" FROM trips
           WHERE payment_type IS NOT NULL GROUP BY 1)
SELECT payment_type, "count", payment_type_name, {KEY_COLUMN}
FROM counts LEFT JOIN labels USING (payment_type)"""

PICKUP_HOUR = f"""WITH {TRIPS}
SELECT lpad(CAST(hour(tpep_pickup_datetime) AS VARCHAR), 2, '0') || ':00' AS pickup_hour,
       count(*) AS "count", {KEY_COLUMN}
FROM trips WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1"""


def _revenue_per_day(where: str = "true") -> str:
    return f"""WITH {TRIPS}, days AS (
  SELECT CAST(year(tpep_dropoff_datetime) AS INTEGER) AS "year",
         CAST(month(tpep_dropoff_datetime) AS INTEGER) AS "month",
         CAST(day(tpep_dropoff_datetime) AS INTEGER) AS "day",
         CAST(sum(total_amount) AS DOUBLE) AS total_amount
  FROM trips WHERE {where} AND tpep_dropoff_datetime IS NOT NULL GROUP BY 1, 2, 3)
"""


AFTER_START = "tpep_pickup_datetime > TIMESTAMP '2018-01-01 00:00:00'"
DAY_COLUMNS = f"""SELECT "year", "month", "day", total_amount,
       make_date("year", "month", "day") AS "timestamp", {KEY_COLUMN} FROM days"""


def _heat_points(location: str) -> str:
    return f"""WITH {TRIPS}, {ZONES}
SELECT TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
       count(*) AS weight
FROM trips LEFT JOIN zones ON {location} = locationid
WHERE TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90
  AND TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180
GROUP BY 1, 2"""


def _location_table(location: str) -> str:
    return f"""WITH {TRIPS}, {ZONES},
visited AS (SELECT DISTINCT {location} AS locationid FROM trips WHERE {location} IS NOT NULL)
SELECT locationid, borough, zone, service_zone, {KEY_COLUMN}
FROM visited LEFT JOIN zones USING (locationid)"""


STREAM_STATISTICS = f"""WITH {TRIPS}
SELECT 'passenger_number_statistics' AS statistic, CAST(passenger_count AS VARCHAR) AS "key",
       CAST(count(*) AS DOUBLE) AS total
FROM trips WHERE passenger_count IS NOT NULL GROUP BY passenger_count
UNION ALL
SELECT 'payment_type_statistics', CAST(payment_type AS VARCHAR), CAST(count(*) AS DOUBLE)
FROM trips WHERE payment_type IS NOT NULL GROUP BY payment_type
UNION ALL
SELECT 'total_amount_statistics',
       concat_ws('-', year(tpep_dropoff_datetime), month(tpep_dropoff_datetime),
                 day(tpep_dropoff_datetime)),
       CAST(sum(total_amount) AS DOUBLE)
FROM trips WHERE tpep_dropoff_datetime IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'pickup_hour_statistics',
       lpad(CAST(hour(tpep_pickup_datetime) AS VARCHAR), 2, '0') || ':00',
       CAST(count(*) AS DOUBLE)
FROM trips WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 2"""

STAGE_ROW_COUNTS = f"""WITH {TRIPS}, days AS (
  SELECT DISTINCT CAST(tpep_dropoff_datetime AS DATE) AS dropoff,
         tpep_pickup_datetime >= TIMESTAMP '2024-01-16 00:00:00' AS is_new
  FROM trips WHERE {AFTER_START}),
counts AS (SELECT count(*) FILTER (WHERE is_new) AS new_days,
                  count(*) FILTER (WHERE NOT is_new) AS stored_days,
                  count(DISTINCT dropoff) AS all_days FROM days)
SELECT 'new' AS stage, new_days AS "rows" FROM counts
UNION ALL SELECT 'stored', stored_days FROM counts
UNION ALL SELECT 'merged', all_days FROM counts
UNION ALL SELECT 'dated', all_days FROM counts
UNION ALL SELECT 'published', all_days FROM counts"""

STAGE_METRICS = f"""WITH {TRIPS}, c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE total_amount IS NULL) AS missing,
         count(tpep_dropoff_datetime) AS with_day,
         count(*) FILTER (WHERE tpep_dropoff_datetime IS NOT NULL AND {AFTER_START}) AS counted,
         count(DISTINCT CASE WHEN {AFTER_START} THEN CAST(tpep_dropoff_datetime AS DATE) END) AS days FROM trips)
SELECT 'read' AS stage, n AS "rows" FROM c UNION ALL SELECT 'unusable_amounts', 0 FROM c
UNION ALL SELECT 'missing_amounts', missing FROM c UNION ALL SELECT 'with_day', with_day FROM c
UNION ALL SELECT 'counted', counted FROM c UNION ALL SELECT 'days', days FROM c UNION ALL SELECT 'published', days FROM c"""

DURATION = "(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60 AS trip_duration"
_PARTS = ["trip_id", "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "total_amount", "copy"]
_NAME = " || '|' || ".join(
    f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in _PARTS
)
TRIP_IDS = f"""WITH {TRIPS}, copies AS (
  SELECT *, unnest(CASE WHEN trip_id % 20 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM trips),
named AS (SELECT trip_id, sha1(unhex('{ID_NAMESPACE.replace("-", "")}') || encode({_NAME})) AS h FROM copies)
SELECT trip_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
       || substr('89ab', CAST('0x' || h[17:17] AS INTEGER) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] AS id
FROM named"""

TRIP_STORE_UPSERT = f"""WITH {TRIPS}
SELECT trip_id, passenger_count,
       CAST(CASE WHEN trip_id % 10 = 3 THEN total_amount + trip_id // 10 % 3 + 1 ELSE total_amount END AS DECIMAL(18,2))
         AS total_amount, {DURATION} FROM trips"""

MERGE_ACTIONS = f"""WITH {TRIPS}
SELECT trip_id, passenger_count,
       CAST(CASE WHEN trip_id % 5 = 0 AND trip_id % 20 <> 15 AND trip_id % 100 < 60 THEN total_amount + trip_id % 100
                 ELSE total_amount END AS DECIMAL(18,2)) AS total_amount, {DURATION}
FROM trips WHERE trip_id % 100 <> 0
UNION ALL
SELECT -1 - trip_id, passenger_count, CAST(trip_id % 100 AS DECIMAL(18,2)), NULL
FROM trips WHERE trip_id % 20 = 15 AND trip_id % 100 <> 35"""

ORACLE: dict[str, str] = {
    "scan_csv": f"WITH {TRIPS} SELECT trip_id, passenger_count, total_amount FROM trips",
    "passenger_merge": PASSENGERS,
    "payment_merge": PAYMENT,
    "peak_hour_merge": PICKUP_HOUR,
    "total_amount_day_merge": _revenue_per_day(AFTER_START) + DAY_COLUMNS,
    "total_amount_week": f"""WITH {TRIPS}
SELECT CAST(isoyear(tpep_dropoff_datetime) AS INTEGER) AS "year",
       CAST(week(tpep_dropoff_datetime) AS INTEGER) AS week,
       CAST(sum(total_amount) AS DOUBLE) AS total_amount, {KEY_COLUMN}
FROM trips WHERE {AFTER_START} AND tpep_dropoff_datetime IS NOT NULL GROUP BY 1, 2""",
    "trip_distance_merge": f"""WITH {TRIPS}
SELECT CASE WHEN trip_distance < 1 THEN 'Short' WHEN trip_distance < 10 THEN 'Medium'
            ELSE 'Long' END AS trip_distance, count(*) AS "count"
FROM trips WHERE trips.trip_distance IS NOT NULL GROUP BY 1""",
    "trip_duration": f"""WITH {TRIPS}
SELECT trip_id, (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60
       AS trip_duration FROM trips""",
    "trip_id_audit": """SELECT count(*) AS "rows", count(*) AS distinct_ids,
       CAST(36 AS INTEGER) AS id_length FROM events""",
    "trip_duration_class": f"""WITH {TRIPS},
minutes AS (SELECT (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60 AS m
            FROM trips)
SELECT CASE WHEN m < 5 THEN 'Very Short' WHEN m < 10 THEN 'Short' WHEN m < 20 THEN 'Medium'
            ELSE 'Long' END AS duration_class, count(*) AS "count"
FROM minutes WHERE m IS NOT NULL GROUP BY 1""",
    "heat_points_pickup": _heat_points("pulocationid"),
    "heat_points_dropoff": _heat_points("dolocationid"),
    "location_pickup": _location_table("pulocationid"),
    "location_dropoff": _location_table("dolocationid"),
    "publish_json": f"WITH {TRIPS} SELECT trip_id, total_amount FROM trips",
    "land_csv_dedup": ALL_TRIPS,
    "stream_landing": ALL_TRIPS,
    "stream_landing_dedup": ALL_TRIPS,
    "state_audit": f"""WITH {TRIPS}
SELECT passenger_count AS passenger_number, count(*) AS "count", true AS agrees
FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1""",
    "stream_passenger": PASSENGERS,
    "stream_payment": PAYMENT,
    "stream_total_amount": _revenue_per_day() + DAY_COLUMNS,
    "stream_peak_hour": PICKUP_HOUR,
    "stream_statistics": STREAM_STATISTICS,
    "stream_batches": STREAM_STATISTICS,
    "trip_ids": TRIP_IDS,
    "trip_store_upsert": TRIP_STORE_UPSERT,
    "merge_actions": MERGE_ACTIONS,
    "batch_statistics": STREAM_STATISTICS.replace(
        "FROM trips WHERE tpep_dropoff", f"FROM trips WHERE {AFTER_START} AND tpep_dropoff"
    ),
    "stream_passenger_stateful": f"""WITH {TRIPS}
SELECT passenger_count AS passenger_number, count(*) AS "count"
FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1""",
    "report_total_amount": _revenue_per_day(AFTER_START)
    + 'SELECT "year", "month", "day", total_amount FROM days ORDER BY 1, 2, 3',
    "preview_trips": f"WITH {TRIPS} SELECT * FROM trips ORDER BY trip_id LIMIT 20",
    "stage_row_counts": STAGE_ROW_COUNTS,
    "stage_metrics": STAGE_METRICS,
}
