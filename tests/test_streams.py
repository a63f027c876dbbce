"""Streams over message and trip files: equal to batch, restartable, safe to replay."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from cabtally import __main__ as command
from cabtally.fixed_values import TRIP_FIELDS
from cabtally.operators.statistics import (
    PASSENGERS,
    PAYMENT_TYPE,
    PICKUP_HOUR,
    REVENUE_PER_DAY,
    STATISTICS,
)
from cabtally.plans.fixtures import FIELDS, trips, with_copies, with_end_markers
from cabtally.sources.files import read_trips
from cabtally.sources.records import decode_trips, encode_json
from cabtally.sources.storage import Storage
from cabtally.sources.streams import open_stream, publish
from cabtally.streaming.landing import land_batch, land_stream
from cabtally.streaming.queries import start
from cabtally.streaming.statistics import latest, merge_stream, open_table, running_totals_stream

STREAMED = [PASSENGERS, PAYMENT_TYPE, REVENUE_PER_DAY, PICKUP_HOUR]
ONE_FILE = {"maxFilesPerTrigger": "1"}


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def small(spark):
    return trips(spark, "/root/testdata/sf0.001").cache()


@pytest.fixture
def inbox(folder, small):
    """Four message files."""
    publish(small.repartition(4, "trip_id"), "text", f"{folder}/inbox")
    return f"{folder}/inbox"


def trip_stream(spark, inbox):
    return decode_trips(open_stream(spark, "text", inbox, options=ONE_FILE), FIELDS)


@pytest.mark.parametrize("statistics", [[s] for s in STREAMED] + [STREAMED], ids=repr)
def test_stream_in_micro_batches_equals_batch(spark, folder, small, inbox, statistics):
    query = merge_stream(trip_stream(spark, inbox), statistics, folder, f"{folder}/checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    for statistic in statistics:
        assert rows(latest(spark, folder, statistic)) == rows(
            statistic.present(statistic.totals(small))
        )


def test_restart_takes_only_what_is_new(spark, folder, small, inbox):
    def run():
        merge_stream(
            trip_stream(spark, inbox), [PASSENGERS], folder, f"{folder}/checkpoint"
        ).awaitTermination()

    run()
    run()
    assert rows(latest(spark, folder, PASSENGERS)) == rows(
        PASSENGERS.present(PASSENGERS.totals(small))
    )
    publish(small, "text", inbox)
    run()
    assert rows(latest(spark, folder, PASSENGERS)) == rows(
        PASSENGERS.present(PASSENGERS.totals(small.union(small)))
    )


def test_replayed_batch_counts_once(spark, folder, small, inbox):
    """The mark that the last batch ended is lost, so the stream runs that batch again."""
    table = open_table(spark, folder, PASSENGERS)
    merged, replays = [], []

    def run(seen):
        merge_stream(
            trip_stream(spark, inbox),
            [PASSENGERS, PAYMENT_TYPE],
            folder,
            f"{folder}/checkpoint",
            committed=lambda statistic, table: merged.append(statistic.name),
        ).awaitTermination()
        start(
            open_stream(spark, "text", inbox, options=ONE_FILE),
            lambda rows, batch, query: seen.append((query, batch)),
            f"{folder}/control",
        ).awaitTermination()

    first = []
    run(first)
    before, version = rows(table.read()), table._state().version
    assert [batch for _, batch in first] == [0, 1, 2, 3] and len(merged) == 8
    for checkpoint in ("checkpoint", "control"):
        for mark in (".3.crc", "3"):
            os.remove(f"{folder.removeprefix('file://')}/{checkpoint}/commits/{mark}")
    run(replays)
    assert replays == first[-1:]
    assert len(merged) == 10  # the copies are made again, the totals stay
    assert rows(table.read()) == before and table._state().version == version


def test_a_crash_between_two_tables_is_made_good(spark, folder, small, inbox):
    fail = [True]

    def crash_once(statistic, table):
        if statistic is PASSENGERS and fail:
            fail.clear()
            raise RuntimeError("lost driver")

    def run():
        merge_stream(
            trip_stream(spark, inbox),
            [PASSENGERS, PAYMENT_TYPE],
            folder,
            f"{folder}/checkpoint",
            committed=crash_once,
        ).awaitTermination()

    with pytest.raises(Exception, match="lost driver"):
        run()
    run()
    for statistic in (PASSENGERS, PAYMENT_TYPE):
        assert rows(open_table(spark, folder, statistic).read()) == rows(statistic.totals(small))


def test_a_copy_that_a_crash_has_prevented_is_made_on_replay(spark, folder, inbox):
    made = []

    def copy(statistic, table):
        if not made:
            made.append(None)
            raise RuntimeError("lost driver")
        made.append(rows(table.read()))

    def run():
        stream = decode_trips(open_stream(spark, "text", inbox), FIELDS)
        merge_stream(stream, [PASSENGERS], folder, f"{folder}/c", committed=copy).awaitTermination()

    with pytest.raises(Exception, match="lost driver"):
        run()
    run()
    assert made[1:] == [rows(open_table(spark, folder, PASSENGERS).read())]


def test_the_guard_holds_where_threads_are_not_pinned(folder, inbox):
    script = f"""
from pyspark.sql import SparkSession
from cabtally.sources.streams import open_stream
from cabtally.streaming.queries import start
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
seen = []
for _ in range(2):
    stream = open_stream(spark, "text", "{inbox}", options={{"maxFilesPerTrigger": "2"}})
    start(stream, lambda rows, batch, query: seen.append((query, batch)), "{folder}/c").awaitTermination()
(query,) = {{query for query, _ in seen}}
assert query and [batch for _, batch in seen] == [0, 1], seen
"""
    env = os.environ | {"PYSPARK_PIN_THREAD": "false", "PYTHONPATH": os.pathsep.join(sys.path)}
    subprocess.run([sys.executable, "-c", script], env=env, check=True, timeout=120)


def test_the_state_is_read_once_per_batch(spark, folder, small, inbox):
    query = running_totals_stream(
        trip_stream(spark, inbox), PASSENGERS, folder, f"{folder}/checkpoint", partitions=2
    )
    query.awaitTermination()
    keys = PASSENGERS.totals(small).count()
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert len(updated) == 4 and max(updated) <= keys
    version = open_table(spark, folder, PASSENGERS)._state().folder
    files = Storage(spark, folder).names(f"{folder}/{PASSENGERS.name}/{version}")
    assert sum(name.startswith("part-") for name in files) == 1


def test_new_checkpoint_starts_new_batches(spark, folder, small, inbox):
    for run in ("one", "two"):
        merge_stream(
            trip_stream(spark, inbox), [PASSENGERS], folder, f"{folder}/checkpoint-{run}"
        ).awaitTermination()
    assert rows(open_table(spark, folder, PASSENGERS).read()) == rows(
        PASSENGERS.totals(small.union(small))
    )


@pytest.mark.parametrize("name", ["passengers", "revenue-per-day"])
def test_running_totals_equal_batch_also_after_a_restart(spark, folder, small, inbox, name):
    statistic = STATISTICS[name]

    def run():
        running_totals_stream(
            trip_stream(spark, inbox), statistic, folder, f"{folder}/checkpoint", partitions=2
        ).awaitTermination()

    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert rows(open_table(spark, folder, statistic).read()) == rows(statistic.totals(small))
    publish(small, "text", inbox)
    run()
    assert rows(open_table(spark, folder, statistic).read()) == rows(
        statistic.totals(small.union(small))
    )


def test_files_older_than_the_newest_are_not_lost(spark, tmp_path, folder, small, inbox):
    seen = []

    def run():
        stream = open_stream(spark, "text", inbox)
        start(stream, lambda b, i, q: seen.append(b.count()), f"{folder}/c").awaitTermination()

    run()
    publish(small.limit(10), "text", inbox)
    old = time.time() - 40 * 86400
    for path in tmp_path.glob("inbox/part-*"):
        if path.stat().st_mtime > time.time() - 3 and sum(1 for _ in path.open()) == 10:
            os.utime(path, (old, old))
    run()
    assert sum(seen) == 1010


# Landing


def landed(spark, folder):
    return read_trips(spark, f"{folder}/landed", FIELDS)


def test_landing_removes_copies_and_markers(spark, folder, small):
    messages = with_end_markers(encode_json(with_copies(small)), every=50)
    assert messages.count() > 1050
    assert land_batch(messages, f"{folder}/landed", "batch", FIELDS)
    assert rows(landed(spark, folder)) == rows(small)


def test_copies_are_removed_within_a_batch_only(spark, folder, small, inbox):
    publish(small.limit(10), "text", inbox)
    for n in range(5):
        messages = open_stream(spark, "text", inbox, options=ONE_FILE)
        land_stream(messages, f"{folder}/landed", f"{folder}/c", FIELDS).awaitTermination()
    assert landed(spark, folder).count() == 1010
    assert rows(landed(spark, folder).distinct()) == rows(small)


def test_a_landed_batch_is_left_alone(spark, folder, small):
    messages = encode_json(small)
    assert land_batch(messages, f"{folder}/landed", "a/batch-1", FIELDS)
    assert not land_batch(messages, f"{folder}/landed", "a/batch-1", FIELDS)
    assert land_batch(messages, f"{folder}/landed", "a/batch-2", FIELDS)
    assert landed(spark, folder).count() == 2000


def test_a_batch_that_is_being_written_is_not_read(spark, folder, small):
    encode_json(small).write.text(f"{folder}/landed/_writing/batch-0")
    land_batch(encode_json(small), f"{folder}/landed", "batch-0", FIELDS)
    assert landed(spark, folder).count() == 1000


def test_malformed_messages_are_kept_aside(spark, folder, small):
    partly = '{"trip_id":5000,"payment_type":"cash"}'
    bad = spark.createDataFrame([("bad",), ('{"trip_id":',), (partly,)], "value string")
    land_batch(encode_json(small).unionByName(bad), f"{folder}/landed", "b", FIELDS)
    assert landed(spark, folder).count() == 1001
    assert landed(spark, folder).filter("trip_id = 5000").count() == 1
    kept = sorted(r[0] for r in spark.read.text(f"{folder}/landed/_malformed/b").collect())
    assert kept == sorted(["bad", '{"trip_id":', partly])
    land_batch(encode_json(small), f"{folder}/landed", "c", FIELDS)
    assert Storage(spark, folder).names(f"{folder}/landed/_malformed") == ["b"]


# The whole way, by command line

WIRE = list(TRIP_FIELDS)


def test_from_files_to_statistics(spark, folder, small, capsys):
    def run(*words):
        command.run(spark, command.parser().parse_args([w.format(folder) for w in words]))

    # fare_amount carries the trip's number, so that no two trips are equal.
    full = small.withColumn("fare_amount", F.col("trip_id").cast("double")).withColumn(
        "total_amount", F.col("total_amount").cast("double")
    )
    for name in WIRE:
        if name not in full.columns:
            full = full.withColumn(name, F.lit(None).cast("string"))
    full = full.select(*WIRE)
    full.withColumnsRenamed({"vendorid": "VendorID", "pulocationid": "PULocationID"}).write.csv(
        f"{folder}/raw", header=True
    )
    for again in range(2):
        run("publish", "--csv", "{}/raw", "--text", "{}/messages")
        run("land", "--text", "{}/messages", "--out", "{}/landed", "--checkpoint", "{}/c1")
        for _ in range(2):
            run("batch", "passengers", "revenue-per-day", "revenue-per-week", "distance",
                "--trips", "{}/landed", "--tables", "{}/tables", "--checkpoint", "{}/c2",
                "--copy-to", "parquet", "--option", "path={}/copy")
            run("store", "--csv", "{}/landed", "--out", "{}/store", "--checkpoint", "{}/c5")
            run("batch", "distance", "passengers", "--trips", "{}/store", "--kind", "parquet",
                "--tables", "{}/from-store", "--checkpoint", "{}/c6")
        once = full if not again else full.union(full)
        for name in ("passengers", "revenue-per-day", "revenue-per-week", "distance"):
            statistic = STATISTICS[name]
            assert rows(latest(spark, f"{folder}/tables", statistic)) == rows(
                statistic.present(statistic.totals(once, batch=True))
            ), name
        for name in ("passengers", "distance"):
            statistic = STATISTICS[name]
            assert rows(latest(spark, f"{folder}/from-store", statistic)) == rows(
                statistic.present(statistic.totals(once))
            ), name
    run("stream", "pickup-hour", "--text", "{}/messages", "--tables", "{}/tables",
        "--checkpoint", "{}/c3")
    run("running", "payment-type", "--text", "{}/messages", "--tables", "{}/tables",
        "--checkpoint", "{}/c4")
    run("show", "pickup-hour", "payment-type", "--tables", "{}/tables")
    run("report", "--tables", "{}/tables")
    run("stages", "--trips", "{}/store", "--kind", "parquet", "--tables", "{}/tables")
    run("preview", "--store", "{}/store", "--rows", "5")
    shown = capsys.readouterr().out
    assert "23:00" in shown and "Credit card" in shown and "published" in shown
    assert spark.read.parquet(f"{folder}/store").select("id").distinct().count() == 2000

    zone = "LocationID,Borough,Zone,service_zone,latitude,longitude\n3,B,Z,S,40.5,-74.5\n"
    with open(f"{folder.removeprefix('file://')}/zones.csv", "w") as file:
        file.write(zone)
    run("heat", "pickup", "--trips", "{}/raw", "--zones", "{}/zones.csv", "--out", "{}/heat")
    visits = small.filter("pulocationid = 3").count()
    assert rows(spark.read.parquet(f"{folder}/heat")) == [(40.5, -74.5, visits)]
    run("locations", "dropoff", "--trips", "{}/raw", "--zones", "{}/zones.csv", "--out", "{}/where")
    assert spark.read.parquet(f"{folder}/where").count() == 26
