"""The jobs a user runs, from landed files and message streams to stored statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cabtally.fixed_values import TRIP_FIELDS
from cabtally.functions.trips import unusable
from cabtally.operators import geo, reports
from cabtally.operators.statistics import REVENUE_PER_DAY, Statistic, fields_of, with_date
from cabtally.sources.files import layout_schema, layouts, read_csv, read_trips, read_zones
from cabtally.sources.records import decode_trips, lower_case, typed, wire_fields
from cabtally.sources.storage import Storage
from cabtally.sources.streams import open_stream, publish
from cabtally.sources.tables import SnapshotTable, read_keyed, upsert_keyed
from cabtally.streaming.statistics import Committed, merge_stream, open_table

LOCATIONS = {"pickup": "pulocationid", "dropoff": "dolocationid"}


def publish_files(
    spark: SparkSession, csv: str, kind: str, path: str | None, options: dict[str, str]
) -> None:
    """CSV files to messages, as they are: numbers and texts, names in lower case, columns
    that are no trip fields as well."""
    publish(read_csv(spark, csv, others=True), kind, path, options)


def read_stored(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """All trips of landed CSV files, or of a Parquet trip store.

    The store has the trip's own types, so filters and columns reach its scan.
    """
    return read_trips(spark, path) if kind == "csv" else spark.read.parquet(path)


def follow_stored(
    spark: SparkSession,
    path: str,
    kind: str = "csv",
    fields: Mapping[str, str] = TRIP_FIELDS,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The same trips as an unbounded frame that takes up new files.

    A stream has one layout of CSV files, that of the files found at its start; a file with
    another one fails it, so files of several layouts need a folder and a stream each.
    """
    if kind == "csv":
        rows = lower_case(open_stream(spark, "csv", path, _one_layout(spark, path), options))
        missing = [name for name in TRIP_FIELDS if name not in rows.columns]
        wire = wire_fields(TRIP_FIELDS)
        rows = rows.withColumns({name: F.lit(None).cast(wire[name]) for name in missing})
        return typed(rows, fields)
    # Not recursive: the store is written by a stream, whose log names its files.
    options = {"recursiveFileLookup": "false"} | (options or {})
    schema = spark.read.parquet(path).schema
    return open_stream(spark, kind, path, schema, options).select(*fields)


def _one_layout(spark: SparkSession, path: str) -> StructType:
    exists = "*" in path or Storage(spark, path).exists(path)
    found = list(layouts(spark, path)) if exists else []
    if len(found) > 1:
        raise ValueError(f"{path} has files with {len(found)} different headers; see read_csv")
    return layout_schema(found[0] if found else tuple(TRIP_FIELDS), TRIP_FIELDS)


def update_trip_store(
    spark: SparkSession,
    csv: str,
    store: str,
    checkpoint: str,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append new CSV files to the Parquet trip store, with duration and id.

    The sink's log makes this exact also after a failure, and each id is drawn once.
    """
    trips = reports.trip_store(follow_stored(spark, csv, options=options))
    writer = trips.writeStream.format("parquet").option("path", store)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def update_from_files(
    spark: SparkSession,
    statistics: list[Statistic],
    path: str,
    tables: str,
    checkpoint: str,
    kind: str = "csv",
    committed: Committed | None = None,
    file_options: dict[str, str] | None = None,
    **options,
) -> StreamingQuery:
    """The batch job: add the trips that arrived as files since the last run.

    The checkpoint remembers the files, so running the job again counts none twice.
    """
    fields = fields_of(statistics, TRIP_FIELDS)
    rows = follow_stored(spark, path, kind, fields, file_options)
    return merge_stream(
        rows, statistics, tables, checkpoint, batch=True, committed=committed, **options
    )


def update_from_messages(
    messages: DataFrame,
    statistics: list[Statistic],
    tables: str,
    checkpoint: str,
    committed: Committed | None = None,
    **options,
) -> StreamingQuery:
    """The streaming job: one read of the messages for all ``statistics``."""
    rows = decode_trips(messages, fields_of(statistics, TRIP_FIELDS))
    return merge_stream(rows, statistics, tables, checkpoint, committed=committed, **options)


def copy_to(format: str, **options: str) -> Committed:
    """Copies a statistic to the connector table of its name after each update."""

    def copy(statistic: Statistic, table: SnapshotTable) -> None:
        upsert_keyed(statistic.present(table.read()), format, **({"table": statistic.name} | options))

    return copy


def seed_from(
    spark: SparkSession, statistic: Statistic, tables: str, format: str, **options: str
) -> None:
    """Take over the totals of a connector table, whatever the types of its columns."""
    rows = read_keyed(spark, format, **({"table": statistic.name} | options))
    columns = StructType.fromDDL(statistic.schema)
    totals = rows.select(*[F.col(c.name).try_cast(c.dataType).alias(c.name) for c in columns])
    open_table(spark, tables, statistic).update(lambda stored: totals)


def heat_points(trips: DataFrame, zones: str, place: str) -> DataFrame:
    return geo.heat_points(trips, read_zones(trips.sparkSession, zones), LOCATIONS[place])


def location_table(trips: DataFrame, zones: str, place: str) -> DataFrame:
    return geo.location_table(trips, read_zones(trips.sparkSession, zones), LOCATIONS[place])


def revenue_stages(trips: DataFrame, tables: str) -> DataFrame:
    """Row counts after each stage of adding trips to the revenue per day; writes nothing."""
    stored = open_table(trips.sparkSession, tables, REVENUE_PER_DAY).read()
    return stages_of(REVENUE_PER_DAY.totals(trips, batch=True), stored)


def observed_revenue(trips: DataFrame, path: str) -> DataFrame:
    """Write the revenue per day to ``path``; ``(stage, rows)`` as they were counted by that."""
    counts = reports.StageCounts()
    dropoff, amount = F.col("tpep_dropoff_datetime"), F.col("total_amount")
    rows = counts.at("read", trips, unusable_amounts=unusable(amount), missing_amounts=amount.isNull())
    rows = counts.at("with_day", rows.filter(dropoff.isNotNull()))
    rows = counts.at("counted", rows.filter(REVENUE_PER_DAY.batch_filter()))
    totals = counts.at("days", REVENUE_PER_DAY.totals(rows))
    counts.at("published", REVENUE_PER_DAY.present(totals)).write.parquet(path)
    return counts.report(trips.sparkSession)


def stages_of(new: DataFrame, stored: DataFrame) -> DataFrame:
    both = REVENUE_PER_DAY.add(new, stored)
    return reports.stage_row_counts(
        {
            "new": new,
            "stored": stored,
            "merged": both,
            "dated": with_date(both),
            "published": REVENUE_PER_DAY.present(both),
        }
    )
