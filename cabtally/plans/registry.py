"""The registered queries, each over the whole of the given tables.

Queries over stored state split the trips at a fixed time: the earlier ones make up the
stored totals, the later ones arrive on top. What a query has to write (snapshots,
checkpoints, landed files) goes below the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.operators import geo, reports
from cabtally.operators.statistics import (
    DISTANCE,
    DURATION,
    PASSENGERS,
    PAYMENT_TYPE,
    PICKUP_HOUR,
    REVENUE_PER_DAY,
    REVENUE_PER_WEEK,
    Statistic,
    fields_of,
)
from cabtally.plans.fixtures import (
    FIELDS,
    trip_stream,
    trips,
    with_copies,
    with_end_markers,
    zones,
)
from cabtally.plans.jobs import observed_revenue, stages_of, update_from_files, update_trip_store
from cabtally.sources.files import read_trips
from cabtally.sources.keyed import KeyedTable, delete, insert, update
from cabtally.sources.records import decode_trips, encode_json
from cabtally.sources.storage import scratch_folder
from cabtally.sources.streams import open_stream, publish
from cabtally.streaming.landing import land_batch, land_stream
from cabtally.streaming.queries import finish, state_of
from cabtally.streaming.statistics import (
    add_to_tables,
    combined_report,
    latest,
    merge_stream,
    running_totals_stream,
    state_value,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Files of messages that make as many micro-batches.
STREAM_FILES = 4
#: Fields that trips have ids of, and those of the table by trip.
ID_FIELDS = ["trip_id", "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "total_amount"]
TRIP_TABLE = {"trip_id": "bigint", "passenger_count": "int", "total_amount": "decimal(18,2)", "trip_duration": "double"}
STREAMED = [PASSENGERS, PAYMENT_TYPE, REVENUE_PER_DAY, PICKUP_HOUR]


# Files


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark, 'csv')}/trips"
    trips(spark, sf_dir).write.csv(folder, header=True)
    return read_trips(spark, folder, FIELDS).select("trip_id", "passenger_count", "total_amount")


def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark, 'publish')}/messages"
    publish(trips(spark, sf_dir), "text", folder)
    return decode_trips(spark.read.text(folder), FIELDS).select("trip_id", "total_amount")


def land_csv_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark, 'landing')}/landed"
    messages = with_end_markers(encode_json(with_copies(trips(spark, sf_dir))))
    land_batch(messages, folder, "batch", FIELDS)
    return read_trips(spark, folder, FIELDS)


# Statistics


def merged(statistic: Statistic) -> Query:
    """Later trips added to the totals of the earlier ones."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = statistic.totals(trips(spark, sf_dir, "stored"), batch=True)
        new = trips(spark, sf_dir, "new")
        return statistic.present(statistic.totals(new, stored, batch=True))

    return query


def totals(statistic: Statistic) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return statistic.present(statistic.totals(trips(spark, sf_dir), batch=True))

    return query


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.with_duration(trips(spark, sf_dir)).select("trip_id", "trip_duration")


def trip_id_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the trip store, as they were written: CSV files to stored trips."""
    folder = scratch_folder(spark, "store")
    trips(spark, sf_dir).write.csv(f"{folder}/csv", header=True)
    finish(update_trip_store(spark, f"{folder}/csv", f"{folder}/store", f"{folder}/checkpoint"))
    return reports.id_audit(spark.read.parquet(f"{folder}/store"))


def trip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from what trips hold, of which every twentieth is there twice."""
    return reports.identified(with_copies(trips(spark, sf_dir)).select(*ID_FIELDS)).select("trip_id", "id")


def _trip_table(spark: SparkSession, sf_dir: str, folder: str) -> KeyedTable:
    """All trips with their duration, in a table by trip."""
    rows = reports.with_duration(trips(spark, sf_dir)).select(*TRIP_TABLE)
    schema = ", ".join(f"{name} {kind}" for name, kind in TRIP_TABLE.items())
    table = KeyedTable(spark, folder, schema, ["trip_id"], buckets=16)
    table.upsert(rows, "load")
    return table


def trip_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the stored trips changes, in three batches of which the second comes twice."""
    table = _trip_table(spark, sf_dir, f"{scratch_folder(spark, 'keyed')}/trips")
    rows = reports.with_duration(trips(spark, sf_dir)).select(*TRIP_TABLE)
    for batch, part in enumerate((0, 1, 1, 2)):
        changed = rows.where(F.col("trip_id") % 10 == 3).where(F.floor(F.col("trip_id") / 10) % 3 == part)
        more = F.col("total_amount") + F.lit(part + 1).cast("int")
        table.upsert(changed.withColumn("total_amount", more), "changes", part)
        if batch == 1:
            table.compact(most=1)
    return table.read()


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a fifth of the trips: some go, some take another amount, new ones come."""
    table = _trip_table(spark, sf_dir, f"{scratch_folder(spark, 'merged')}/trips")
    number = F.col("trip_id")
    changes = trips(spark, sf_dir).where(number % 5 == 0).select(
        F.when(number % 20 == 15, -1 - number).otherwise(number).alias("trip_id"),
        "passenger_count",
        (number % 100).cast("int").alias("fee"),
    )
    table.merge(
        changes,
        [
            delete(F.expr("s.fee = 0")),
            update({"total_amount": "t.total_amount + s.fee", "passenger_count": "s.passenger_count"}, F.expr("s.fee < 60")),
            insert({"passenger_count": "s.passenger_count", "total_amount": "s.fee"}, F.expr("s.fee <> 35")),
        ],
    )
    return table.read()


def batch_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over CSV files that arrive in two parts; its third run finds no file."""
    folder = scratch_folder(spark, "batch")
    for part in ("stored", "new", None):
        if part:
            trips(spark, sf_dir, part).write.csv(f"{folder}/csv/{part}", header=True)
        finish(
            update_from_files(
                spark, STREAMED, f"{folder}/csv", f"{folder}/tables", f"{folder}/checkpoint"
            )
        )
    return combined_report(spark, f"{folder}/tables", STREAMED)


# Zones


def heat_points(location: str) -> Query:
    return lambda spark, sf_dir: geo.heat_points(
        trips(spark, sf_dir), zones(spark, sf_dir), location
    )


def location_table(location: str) -> Query:
    return lambda spark, sf_dir: geo.location_table(
        trips(spark, sf_dir), zones(spark, sf_dir), location
    )


# Streams. Each follows the files of the events table, as JSON messages.


def _merge_stream(spark: SparkSession, sf_dir: str, statistics: list[Statistic]) -> str:
    """Store the totals of the earlier trips, then stream the later ones on top."""
    folder = scratch_folder(spark, "stream")
    add_to_tables(trips(spark, sf_dir, "stored"), statistics, folder)
    messages = encode_json(trip_stream(spark, sf_dir, "new"))
    rows = decode_trips(messages, fields_of(statistics, FIELDS))
    finish(merge_stream(rows, statistics, folder, f"{folder}/checkpoint"))
    return folder


def streamed(statistic: Statistic) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return latest(spark, _merge_stream(spark, sf_dir, [statistic]), statistic)

    return query


def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four streamed statistics from one read of the messages."""
    return combined_report(spark, _merge_stream(spark, sf_dir, STREAMED), STREAMED)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed statistics in several micro-batches, one for each file of messages."""
    folder = scratch_folder(spark, "batches")
    messages = encode_json(trips(spark, sf_dir)).repartition(STREAM_FILES)
    messages.write.text(f"{folder}/messages")
    stream = open_stream(
        spark, "text", f"{folder}/messages", options={"maxFilesPerTrigger": "1"}
    )
    rows = decode_trips(stream, fields_of(STREAMED, FIELDS))
    finish(merge_stream(rows, STREAMED, f"{folder}/tables", f"{folder}/checkpoint"))
    return combined_report(spark, f"{folder}/tables", STREAMED)


def stream_passenger_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "stateful")
    messages = encode_json(trip_stream(spark, sf_dir))
    rows = decode_trips(messages, fields_of([PASSENGERS], FIELDS))
    finish(running_totals_stream(rows, PASSENGERS, folder, f"{folder}/checkpoint"))
    return latest(spark, folder, PASSENGERS).select("passenger_number", "count")


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "landing")
    messages = with_end_markers(encode_json(with_copies(trip_stream(spark, sf_dir))))
    finish(land_stream(messages, f"{folder}/landed", f"{folder}/checkpoint", FIELDS))
    return read_trips(spark, f"{folder}/landed", FIELDS)


def state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that the running totals have after a restart, read from the state store, and
    whether the table has the same rows."""
    folder = scratch_folder(spark, "audit")
    for part in ("stored", "new"):
        encode_json(trips(spark, sf_dir, part)).write.text(f"{folder}/messages/{part}")
        stream = open_stream(spark, "text", f"{folder}/messages")
        rows = decode_trips(stream, fields_of([PASSENGERS], FIELDS))
        finish(running_totals_stream(rows, PASSENGERS, folder, f"{folder}/checkpoint"))
    state = state_of(spark, f"{folder}/checkpoint")
    kept = state.select(F.col("key.passenger_number"), state_value(state).alias("count"))
    table = latest(spark, folder, PASSENGERS).select("passenger_number", F.col("count").alias("shown"))
    both = kept.join(table, "passenger_number", "full")
    return both.select("passenger_number", "count", F.col("count").eqNullSafe(F.col("shown")).alias("agrees"))


def stream_landing_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies in other micro-batches than their originals are removed as well."""
    folder = scratch_folder(spark, "landing")
    for part in ("first", "second"):
        rows = trips(spark, sf_dir)
        rows = rows if part == "first" else rows.where(F.col("trip_id") % 3 == 0)
        with_end_markers(encode_json(rows)).coalesce(2).write.text(f"{folder}/messages/{part}")
    stream = open_stream(spark, "text", f"{folder}/messages", options={"maxFilesPerTrigger": "1"})
    finish(land_stream(stream, f"{folder}/landed", f"{folder}/checkpoint", FIELDS, across="30 days", partitions=8))
    return read_trips(spark, f"{folder}/landed", FIELDS)


# Reports


def report_total_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ordered_report(totals(REVENUE_PER_DAY)(spark, sf_dir))


def preview_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.preview(trips(spark, sf_dir), "trip_id")


def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = REVENUE_PER_DAY.totals(trips(spark, sf_dir, "stored"), batch=True)
    new = REVENUE_PER_DAY.totals(trips(spark, sf_dir, "new"), batch=True)
    return stages_of(new, stored)


def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that writing the revenue per day makes on its way: one read of the trips."""
    return observed_revenue(trips(spark, sf_dir), f"{scratch_folder(spark, 'observed')}/revenue")


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "passenger_merge": merged(PASSENGERS),
    "payment_merge": merged(PAYMENT_TYPE),
    "peak_hour_merge": merged(PICKUP_HOUR),
    "total_amount_day_merge": merged(REVENUE_PER_DAY),
    "total_amount_week": totals(REVENUE_PER_WEEK),
    "trip_distance_merge": merged(DISTANCE),
    "trip_duration": trip_duration,
    "trip_id_audit": trip_id_audit,
    "trip_duration_class": totals(DURATION),
    "trip_ids": trip_ids,
    "trip_store_upsert": trip_store_upsert,
    "merge_actions": merge_actions,
    "batch_statistics": batch_statistics,
    "heat_points_pickup": heat_points("pulocationid"),
    "heat_points_dropoff": heat_points("dolocationid"),
    "location_pickup": location_table("pulocationid"),
    "location_dropoff": location_table("dolocationid"),
    "publish_json": publish_json,
    "land_csv_dedup": land_csv_dedup,
    "stream_landing": stream_landing,
    "stream_landing_dedup": stream_landing_dedup,
    "state_audit": state_audit,
    "stream_passenger": streamed(PASSENGERS),
    "stream_payment": streamed(PAYMENT_TYPE),
    "stream_total_amount": streamed(REVENUE_PER_DAY),
    "stream_peak_hour": streamed(PICKUP_HOUR),
    "stream_statistics": stream_statistics,
    "stream_batches": stream_batches,
    "stream_passenger_stateful": stream_passenger_stateful,
    "report_total_amount": report_total_amount,
    "preview_trips": preview_trips,
    "stage_row_counts": stage_row_counts,
    "stage_metrics": stage_metrics,
}
