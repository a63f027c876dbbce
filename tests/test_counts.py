"""Counts of a job's own run, several statistics in one pass, state and copies across batches."""

import json

import pytest
from pyspark.sql import functions as F

from cabtally.operators.reports import StageCounts
from cabtally.operators.statistics import PASSENGERS, PAYMENT_TYPE, REVENUE_PER_DAY, combine
from cabtally.plans.fixtures import FIELDS, trips
from cabtally.plans.jobs import observed_revenue
from cabtally.plans.registry import state_audit
from cabtally.sources.files import read_csv, read_trips
from cabtally.sources.records import decode_trips, encode_json
from cabtally.sources.storage import Storage
from cabtally.sources.streams import open_stream
from cabtally.streaming.landing import land_stream
from cabtally.streaming.queries import STATE_STORE, finish
from cabtally.streaming.statistics import merge_stream, running_totals_stream


def test_amounts_that_add_nothing_are_counted(spark, folder):
    rows = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS tpep_pickup_datetime, day AS tpep_dropoff_datetime, amount AS total_amount"
        " FROM VALUES (TIMESTAMP_NTZ '2024-01-02 00:00:00', 1e26), (TIMESTAMP_NTZ '2024-01-02 00:00:00', 5.5D),"
        " (NULL, 2e30), (TIMESTAMP_NTZ '2024-01-03 00:00:00', NULL), (TIMESTAMP_NTZ '2024-01-03 00:00:00', double('NaN')) AS t(day, amount)"
    )
    got = {r.stage: r.rows for r in observed_revenue(rows, f"{folder}/revenue").collect()}
    assert got == {"read": 5, "unusable_amounts": 3, "missing_amounts": 1, "with_day": 4, "counted": 4, "days": 2, "published": 2}
    assert {r.day: r.total_amount for r in spark.read.parquet(f"{folder}/revenue").collect()} == {2: 5.5, 3: 0.0}


def test_stages_are_counted_by_the_run_itself(spark):
    counts = StageCounts()
    rows = counts.at("all", spark.range(100), even=F.col("id") % 2 == 0)
    counts.at("few", rows.where("id < 7")).write.format("noop").mode("overwrite").save()
    assert {tuple(r) for r in counts.report(spark).collect()} == {("all", 100), ("even", 50), ("few", 7)}


def test_a_stream_tells_of_amounts_that_add_nothing(spark, folder):
    values = ['{"total_amount":1e30,"tpep_dropoff_datetime":"2024-01-02 00:00:00"}', '{"total_amount":1.5}']
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(f"{folder}/messages")
    rows = decode_trips(open_stream(spark, "text", f"{folder}/messages"))
    query = merge_stream(rows, [REVENUE_PER_DAY], f"{folder}/tables", f"{folder}/checkpoint")
    finish(query)
    seen = [p.observedMetrics["trips"] for p in query.recentProgress if "trips" in p.observedMetrics]
    assert (sum(r.rows for r in seen), sum(r.unusable_amounts for r in seen)) == (2, 1)


def test_rows_of_a_combined_pass_follow_the_sum_of_the_keys(spark):
    n = 100_000
    dirty = spark.range(4 * n).selectExpr(
        f"cast(id % {n} AS int) AS passenger_count", f"cast(id * 7919 % {n + 3} AS int) AS payment_type"
    )
    combined = combine(dirty, [PASSENGERS, PAYMENT_TYPE])
    assert combined.count() == 2 * n + 3
    for statistic in (PASSENGERS, PAYMENT_TYPE):
        got = statistic.add(statistic.from_combined(combined))
        assert got.exceptAll(statistic.totals(dirty)).isEmpty() and got.count() == statistic.totals(dirty).count()


def test_state_is_kept_by_rocksdb_and_agrees_after_a_restart(spark, sf_dir, folder, small="/root/testdata/sf0.001"):
    rows = state_audit(spark, small).collect()
    assert rows and all(r.agrees for r in rows)
    encode_json(trips(spark, small)).write.text(f"{folder}/messages")
    stream = decode_trips(open_stream(spark, "text", f"{folder}/messages"), FIELDS)
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    finish(running_totals_stream(stream, PASSENGERS, folder, f"{folder}/checkpoint"))
    assert {name: spark.conf.get(name, None) for name in STATE_STORE} == before
    _, _, conf = Storage(spark, folder).read(f"{folder}/checkpoint/offsets/0").partition("\n")
    kept = json.loads(conf.split("\n")[0])["conf"]
    for name in ("providerClass", "compression.codec"):
        assert kept[f"spark.sql.streaming.stateStore.{name}"] == STATE_STORE[f"spark.sql.streaming.stateStore.{name}"]


def _messages(spark, folder, *batches):
    for i, values in enumerate(batches):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(f"{folder}/messages/{i}")


@pytest.mark.parametrize("across, left", [(None, 5), ("1 day", 3)])
def test_copies_in_several_batches(spark, folder, across, left):
    one, two = '{"vendorid":1,"rest":"x"}', '{"vendorid":2}'
    _messages(spark, folder, [one, one, "bad"], [one, two, "bad"], [two, "worse", '{"z":1}'])
    stream = open_stream(spark, "text", f"{folder}/messages", options={"maxFilesPerTrigger": "1"})
    finish(land_stream(stream, f"{folder}/landed", f"{folder}/checkpoint", across=across, partitions=4))
    assert read_trips(spark, f"{folder}/landed").count() == left
    malformed = sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(f"{folder}/landed/_malformed").collect())
    assert malformed == (["bad", "bad", "worse"] if across is None else ["bad", "worse"])


def test_copies_are_known_after_a_restart(spark, folder):
    for part in range(2):
        _messages(spark, f"{folder}/{part}", ['{"vendorid":1}', f'{{"vendorid":{part + 2}}}'])
        stream = open_stream(spark, "text", f"{folder}/*/messages")
        finish(land_stream(stream, f"{folder}/landed", f"{folder}/checkpoint", across="1 day", partitions=4))
    assert sorted(r.vendorid for r in read_csv(spark, f"{folder}/landed").collect()) == [1, 2, 3]


def test_a_number_that_is_missing_does_not_make_a_message_malformed(spark, folder):
    _messages(spark, folder, ['{"tip_amount":NaN,"vendorid":7}', '{"vendorid":8,"z":1}'])
    stream = open_stream(spark, "text", f"{folder}/messages")
    finish(land_stream(stream, f"{folder}/landed", f"{folder}/checkpoint", across="1 day", partitions=4))
    assert sorted((r.vendorid, r.tip_amount) for r in read_trips(spark, f"{folder}/landed").collect()) == [(7, None), (8, None)]
    assert Storage(spark, folder).names(f"{folder}/landed/_malformed") == []
