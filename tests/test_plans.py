"""The plans Spark makes: what reaches the scan, how often data is shuffled and parsed."""

import re

import pytest
from pyspark.sql import functions as F

from cabtally.operators.statistics import PASSENGERS, PAYMENT_TYPE, REVENUE_PER_DAY, STATISTICS
from cabtally.plans.fixtures import FIELDS, trips
from cabtally.plans.registry import QUERIES
from cabtally.sources.records import decode_trips, encode_json

PYTHON = re.compile(r"Python|Pandas|ExistingRDD")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_trips(spark, tmp_path_factory):
    """Trips as a Parquet table of their own, as a user has them."""
    path = str(tmp_path_factory.mktemp("trips"))
    trips(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not PYTHON.search(text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(STATISTICS))
def test_a_merge_is_one_shuffle_after_partial_sums(spark, stored_trips, tmp_path, name):
    statistic = STATISTICS[name]
    statistic.totals(stored_trips).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.schema(statistic.schema).parquet(f"{tmp_path}/stored")
    text = plan(statistic.totals(stored_trips, stored, batch=True))
    assert text.count("Exchange") == 1 and "Join" not in text and "Sort" not in text
    assert text.index("Exchange") < text.index("partial_sum")


def test_filters_and_columns_reach_the_scan(stored_trips):
    text = plan(PASSENGERS.totals(stored_trips))
    assert "PushedFilters: [IsNotNull(passenger_count)]" in text
    assert "ReadSchema: struct<passenger_count:int>" in text
    text = plan(REVENUE_PER_DAY.totals(stored_trips, batch=True))
    assert "GreaterThan(tpep_pickup_datetime,2018-01-01T00:00)" in text
    assert "IsNotNull(tpep_dropoff_datetime)" in text
    assert "vendorid" not in text


def test_the_split_reaches_the_scan(spark, sf_dir):
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan(trips(spark, sf_dir, "new"))
    assert "LessThan(ts,2024-01-16T00:00)" in plan(trips(spark, sf_dir, "stored"))


@pytest.mark.parametrize("statistic", STATISTICS.values(), ids=STATISTICS)
def test_a_message_is_parsed_once(spark, sf_dir, tmp_path, statistic):
    encode_json(trips(spark, sf_dir)).write.text(f"{tmp_path}/messages")
    messages = spark.read.text(f"{tmp_path}/messages")
    assert plan(statistic.totals(decode_trips(messages, FIELDS))).count("from_json") == 1


def test_payment_labels_are_joined_after_the_totals(stored_trips):
    text = plan(PAYMENT_TYPE.present(PAYMENT_TYPE.totals(stored_trips)))
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")
    assert "LocalTableScan" in text


def test_trips_are_counted_before_they_meet_the_zones(spark, sf_dir):
    text = plan(QUERIES["heat_points_pickup"](spark, sf_dir))
    assert text.index("BroadcastHashJoin") < text.index("partial_count(1)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = QUERIES["heat_points_pickup"](spark, sf_dir)
        assert "SortMergeJoin" in plan(beyond) and beyond.count() == 22
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stage_counts_read_each_part_once(spark, sf_dir):
    frame = QUERIES["stage_row_counts"](spark, sf_dir)
    frame.collect()
    final = plan(frame).split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def test_one_value_in_a_third_of_the_rows(spark, sf_dir):
    """A hot key leaves each task as one row."""
    skewed = trips(spark, sf_dir).withColumn(
        "passenger_count",
        F.when(F.col("trip_id") % 3 == 0, 1).otherwise((F.col("trip_id") % 97).cast("int")),
    )
    want = {}
    for row in skewed.select("passenger_count").collect():
        want[row[0]] = want.get(row[0], 0) + 1
    totals = PASSENGERS.totals(skewed.repartition(8))
    assert {r.passenger_number: r["count"] for r in totals.collect()} == want
