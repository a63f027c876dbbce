"""The keyed merge against a full outer join written out, and its algebra."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabtally.operators.merge import merge_totals, upsert
from cabtally.operators.statistics import REVENUE_PER_DAY, STATISTICS
from cabtally.plans.fixtures import trips

SUM = {"n": "bigint"}


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def frame(spark, values, schema="k int, n bigint"):
    return spark.createDataFrame(values, schema)


def outer_join(stored, delta):
    return stored.withColumnRenamed("n", "old").join(delta, "k", "full").select(
        "k", (F.coalesce("old", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n")
    )


def test_merge_equals_the_full_outer_join(spark):
    stored = frame(spark, [(1, 10), (2, 20), (3, 0)])
    delta = frame(spark, [(2, 5), (4, 7)])
    merged = merge_totals(stored, delta, ["k"], SUM)
    assert rows(merged) == rows(outer_join(stored, delta)) == [(1, 10), (2, 25), (3, 0), (4, 7)]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    stored=st.dictionaries(st.integers(0, 5), st.integers(-9, 9)),
    delta=st.lists(st.tuples(st.integers(0, 8), st.integers(-9, 9)), max_size=20),
)
def test_merge_equals_the_full_outer_join_at_random(spark, stored, delta):
    left = frame(spark, list(stored.items()))
    right = frame(spark, delta)
    summed = right.groupBy("k").agg(F.sum("n").alias("n"))
    assert rows(merge_totals(left, right, ["k"], SUM)) == rows(outer_join(left, summed))


def test_missing_side_counts_as_zero(spark):
    stored = frame(spark, [(1, 10), (2, None)])
    delta = frame(spark, [(1, None), (3, None)])
    assert rows(merge_totals(stored, delta, ["k"], SUM)) == [(1, 10), (2, 0), (3, 0)]
    assert rows(merge_totals(None, delta, ["k"], SUM)) == [(1, 0), (3, 0)]


def test_several_keys(spark):
    schema = "y int, m int, n bigint"
    stored = frame(spark, [(2024, 2, 1), (2024, 10, 2)], schema)
    delta = frame(spark, [(2024, 10, 3), (2025, 10, 4)], schema)
    merged = merge_totals(stored, delta, ["y", "m"], SUM)
    assert rows(merged) == [(2024, 10, 5), (2024, 2, 1), (2025, 10, 4)]


@pytest.mark.parametrize("name", sorted(STATISTICS))
@pytest.mark.parametrize("remainder", [0, 3])
def test_any_split_gives_the_same_totals(spark, sf_dir, name, remainder):
    statistic = STATISTICS[name]
    everything = trips(spark, sf_dir)
    first = everything.filter(F.col("trip_id") % 7 == remainder)
    rest = everything.filter(F.col("trip_id") % 7 != remainder)
    merged = statistic.totals(rest, statistic.totals(first))
    assert rows(merged) == rows(statistic.totals(everything))


def test_upsert_replaces_and_adds(spark):
    stored = frame(spark, [(1, 10), (2, 20)])
    assert rows(upsert(stored, frame(spark, [(2, 1), (3, 2)]), ["k"])) == [(1, 10), (2, 1), (3, 2)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_very_large_amounts_add_up(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        trips = spark.sql(
            "SELECT timestamp_ntz'2024-01-01 10:00:00' AS tpep_dropoff_datetime,"
            " timestamp_ntz'2024-01-01 10:00:00' AS tpep_pickup_datetime, amount AS total_amount"
            " FROM VALUES (9e15D), (9e15D), (1e17D), (double('NaN')) AS t(amount)"
        )
        stored = REVENUE_PER_DAY.totals(trips)
        both = REVENUE_PER_DAY.totals(trips, stored).collect()
        assert [str(r.total_amount) for r in both] == ["236000000000000000.00"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
