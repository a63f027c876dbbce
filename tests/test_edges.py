"""Null, type and range edges of the statistics, records and zones."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cabtally.functions.trips import distance_class, duration_class, hour_label
from cabtally.operators.geo import heat_points, location_table
from cabtally.operators.reports import id_audit, ordered_report, preview, trip_store
from cabtally.operators.statistics import (
    DISTANCE,
    DURATION,
    PASSENGERS,
    PAYMENT_TYPE,
    PICKUP_HOUR,
    REVENUE_PER_DAY,
    REVENUE_PER_WEEK,
    STATISTICS,
    combine,
)
from cabtally.plans.fixtures import trips, zones
from cabtally.sources.records import decode_json, decode_trips, encode_json

TRIP = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count int, payment_type int, trip_distance double, total_amount double"
)


def at(text):
    return datetime.fromisoformat(text)


def trip(
    pickup="2024-01-05 10:00:00",
    dropoff="2024-01-05 10:06:00",
    passengers=1,
    payment=1,
    distance=2.0,
    amount=10.0,
):
    return (pickup and at(pickup), dropoff and at(dropoff), passengers, payment, distance, amount)


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), TRIP)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_stored_key_absent_from_the_batch_keeps_its_total(make):
    for statistic in STATISTICS.values():
        stored = statistic.totals(make(trip()))
        assert rows(statistic.totals(make(), stored)) == rows(stored)


def test_trips_without_a_key_do_not_count(make):
    empty = make((None,) * 6)
    for statistic in STATISTICS.values():
        assert rows(statistic.totals(empty)) == []


def test_hours_add_up_across_runs_and_absent_hours_stay(make):
    stored = PICKUP_HOUR.totals(make(trip("2024-01-05 07:00:00"), trip("2024-01-05 23:59:59")))
    merged = PICKUP_HOUR.totals(make(trip("2024-02-05 07:30:00")), stored)
    assert rows(merged) == [("07:00", 2), ("23:00", 1)]


def test_hour_label_of_null_is_null(spark):
    label = hour_label(F.lit(None).cast("timestamp_ntz"))
    assert spark.range(1).select(label).first()[0] is None


def test_unknown_payment_code_has_no_label(make):
    totals = PAYMENT_TYPE.totals(make(trip(payment=6), trip(payment=7), trip(payment=None)))
    assert rows(PAYMENT_TYPE.present(totals)) == [(6, 1, "Voided trip", 1), (7, 1, None, 1)]


def test_passenger_key_is_a_number(make):
    totals = PASSENGERS.totals(make(trip(passengers=10), trip(passengers=2)))
    assert totals.dtypes == [("passenger_number", "int"), ("count", "bigint")]


def test_distance_classes(spark, make):
    values = [-1.0, 0.99, 1.0, 9.99, 10.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "d double")
    classes = [r[0] for r in frame.select(distance_class(F.col("d"))).collect()]
    assert classes == ["Short", "Short", "Medium", "Medium", "Long", None]
    assert rows(DISTANCE.totals(make(*[trip(distance=v) for v in values]))) == [
        ("Long", 1),
        ("Medium", 2),
        ("Short", 2),
    ]


def test_duration_classes(spark, make):
    values = [-3.0, 4.99, 5.0, 9.99, 10.0, 19.99, 20.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "m double")
    classes = [r[0] for r in frame.select(duration_class(F.col("m"))).collect()]
    assert classes == [
        "Very Short", "Very Short", "Short", "Short", "Medium", "Medium", "Long", None,
    ]
    assert rows(DURATION.totals(make(trip(dropoff="2024-01-05 09:00:00")))) == [("Very Short", 1)]


def test_revenue_filter_is_strict_and_for_batches_only(make):
    rides = make(
        trip("2018-01-01 00:00:00", "2018-01-01 00:10:00", amount=1.0),
        trip("2018-01-01 00:00:01", "2018-01-01 00:10:00", amount=2.0),
    )
    assert REVENUE_PER_DAY.totals(rides, batch=True).first().total_amount == 2
    assert REVENUE_PER_DAY.totals(rides).first().total_amount == 3


def test_revenue_goes_by_the_day_of_dropoff(make):
    night = make(trip("2024-01-05 23:55:00", "2024-01-06 00:05:00"))
    (row,) = REVENUE_PER_DAY.present(REVENUE_PER_DAY.totals(night, batch=True)).collect()
    assert (row.year, row.month, row.day, str(row.timestamp)) == (2024, 1, 6, "2024-01-06")


def test_amounts_are_summed_exactly_and_bad_ones_add_nothing(make):
    rides = make(*[trip(amount=0.1)] * 30, trip(amount=float("inf")), trip(amount=None))
    (row,) = REVENUE_PER_DAY.present(REVENUE_PER_DAY.totals(rides)).collect()
    assert row.total_amount == 3.0


def test_iso_week_belongs_to_the_year_of_the_week(make):
    rides = make(
        trip("2020-12-31 23:00:00", "2021-01-01 00:10:00", amount=1.0),
        trip("2024-12-30 10:00:00", "2024-12-30 10:10:00", amount=2.0),
    )
    totals = REVENUE_PER_WEEK.present(REVENUE_PER_WEEK.totals(rides, batch=True))
    assert rows(totals) == [(2020, 53, 1.0, 1), (2025, 1, 2.0, 1)]


@pytest.mark.parametrize("batch", [True, False])
def test_one_combined_pass_equals_separate_passes(spark, sf_dir, make, batch):
    chosen = list(STATISTICS.values())
    odd = make((None,) * 6, trip("2017-05-05 10:00:00"), trip(passengers=None), trip(None))
    for rides in (trips(spark, sf_dir), odd):
        combined = combine(rides, chosen, batch)
        for statistic in chosen:
            together = statistic.add(statistic.from_combined(combined))
            assert rows(together) == rows(statistic.totals(rides, batch=batch))


def test_report_sorts_months_as_numbers(make):
    totals = REVENUE_PER_DAY.totals(
        make(trip("2024-10-01 10:00:00", "2024-10-01 10:09:00"),
             trip("2024-02-01 10:00:00", "2024-02-01 10:09:00"))
    )
    assert [r.month for r in ordered_report(totals).collect()] == [2, 10]


def test_trip_store_has_unique_ids_and_fractional_minutes(spark, sf_dir):
    store = trip_store(trips(spark, sf_dir))
    assert tuple(id_audit(store).first()) == (10000, 10000, 36)
    minutes = preview(store, "trip_id", 2).select("trip_duration").collect()
    assert [r[0] for r in minutes] == [0.0, 37 / 60]


# Zones


def zone_frame(spark, *rows):
    schema = "locationid int, borough string, zone string, service_zone string, " \
             "latitude string, longitude string"
    return spark.createDataFrame([(i, "b", "z", "s", lat, lon) for i, lat, lon in rows], schema)


def test_only_valid_coordinates_are_points(spark):
    lookup = zone_frame(
        spark,
        (1, "40.5", "-74.5"),
        (2, "#N/A", "-74.5"),
        (3, "90.7", "-74.5"),
        (4, "40.5", "-180.5"),
        (5, None, "-74.5"),
        (6, "-90", "180"),
        (7, "NaN", "1"),
        (8, "40.5", "-74.5"),
    )
    rides = spark.createDataFrame([(i,) for i in (1, 1, 2, 3, 4, 5, 6, 7, 8, 9, None)], "p int")
    assert rows(heat_points(rides, lookup, "p")) == [(-90.0, 180.0, 1), (40.5, -74.5, 3)]


def test_location_without_zone_is_kept(spark):
    lookup = zone_frame(spark, (1, "1", "1"), (2, "1", "1"))
    rides = spark.createDataFrame([(1,), (1,), (9,), (None,)], "p int")
    assert rows(location_table(rides, lookup, "p").select("locationid", "zone")) == [
        (1, "z"),
        (9, None),
    ]


def test_zones_view_matches_the_lookup_shape(spark, sf_dir):
    frame = zones(spark, sf_dir)
    assert [kind for _, kind in frame.dtypes] == ["int"] + ["string"] * 5
    assert {r.latitude for r in frame.collect()} >= {"90.7", "#N/A", "40.00"}


# Records


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_names_are_published_in_lower_case(spark):
    frame = spark.createDataFrame([(1, 2)], "VendorID int, PULocationID int")
    assert encode_json(frame).first()[0] == '{"vendorid":1,"pulocationid":2}'
    decoded = decode_trips(encode_json(frame)).first()
    assert (decoded.vendorid, decoded.pulocationid) == (1, 2)


def test_whole_numbers_with_a_fraction_part_and_nan(spark):
    text = '{"vendorid":1.0,"passenger_count":2.0,"trip_distance":NaN,"total_amount":NaN}'
    row = decode_trips(messages(spark, text)).first()
    assert (row.vendorid, row.passenger_count) == (1, 2)
    assert row.trip_distance is None and row.total_amount is None


def test_bytes_and_bad_values(spark):
    texts = messages(
        spark,
        '{"passenger_count":1e99,"tpep_pickup_datetime":"2024-03-31 02:30:00"}',
        '{"tpep_pickup_datetime":"soon","total_amount":1.5}',
    ).select(F.col("value").cast("binary").alias("value"))
    first, second = decode_trips(texts).collect()
    assert first.passenger_count is None
    assert first.tpep_pickup_datetime == at("2024-03-31 02:30:00")
    assert second.tpep_pickup_datetime is None and second.total_amount == 1.5


def test_end_markers_and_malformed_messages(spark):
    texts = messages(
        spark, '{"vendorid":1}', '{"end_of_stream":true}', '{"end_of_stream":false}', "bad", "[1]"
    )
    decoded = decode_json(texts, keep_malformed=True)
    assert [r._malformed for r in decoded.collect()] == [None, None, "bad", "[1]"]
    assert [r.vendorid for r in decode_trips(texts).collect()] == [1, None, None, None]


def test_a_value_of_the_wrong_kind_does_not_cost_the_others(spark):
    texts = messages(spark, '{"passenger_count":"many","payment_type":2}')
    row = decode_trips(texts).first()
    assert (row.passenger_count, row.payment_type) == (None, 2)
    assert rows(PAYMENT_TYPE.totals(decode_trips(texts))) == [(2, 1)]
    assert rows(PASSENGERS.totals(decode_trips(texts))) == []
