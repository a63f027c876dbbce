"""Every registered query against DuckDB over the same tables."""

import pytest
from oracle_check import assert_same, connect

import __spark_entry__ as entry_points
from cabtally.plans.oracle import ORACLE
from cabtally.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    assert assert_same(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["year", "month", "day", "total_amount", "timestamp", "partition_key"]
    assert result.count() > 0


def test_ordered_results_are_in_order(spark, sf_dir):
    hours = [row.pickup_hour for row in QUERIES["peak_hour_merge"](spark, sf_dir).collect()]
    assert hours == sorted(hours)
    days = [row[:3] for row in QUERIES["report_total_amount"](spark, sf_dir).collect()]
    assert days == sorted(days)
    first = [row.trip_id for row in QUERIES["preview_trips"](spark, sf_dir).collect()]
    assert first == list(range(20))


def test_results_do_not_depend_on_the_session_time_zone(spark, sf_dir, duck):
    before = spark.conf.get("spark.sql.session.timeZone")
    # Clocks go forward on 31 March there; the wall-clock times must not.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("scan_csv", "trip_duration", "stream_peak_hour", "total_amount_day_merge"):
            assert_same(QUERIES[name](spark, sf_dir), duck, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
