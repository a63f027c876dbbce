"""Trips and zones as views of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.fixed_values import END_MARKER
from cabtally.sources.files import read_zones
from cabtally.sources.storage import scratch_folder
from cabtally.sources.streams import open_stream

# Trips before this pickup time are the stored ones, the rest arrive later.
SPLIT = "2024-01-16 00:00:00"

FIELDS = {
    "trip_id": "bigint",
    "vendorid": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "payment_type": "int",
    "pulocationid": "int",
    "dolocationid": "int",
    "total_amount": "decimal(18,2)",
}


def trips(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """Trips from ``events``: ``all``, ``stored`` (before the split) or ``new`` (all others)."""
    return _trips_of(spark.read.parquet(_events(sf_dir)), part)


def trip_stream(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """The same trips as an unbounded frame that follows the files of ``events``."""
    schema = spark.read.parquet(_events(sf_dir)).schema
    return _trips_of(open_stream(spark, "parquet", _events(sf_dir), schema), part)


def _events(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def _trips_of(events: DataFrame, part: str) -> DataFrame:
    # The split is a filter on the raw time, so it reaches the Parquet scan; it equals one
    # on the pickup time, which is cut to a whole second, as the split is.
    split = F.lit(SPLIT).cast("timestamp_ntz")
    if part != "all":
        before = F.col("ts") < split
        # A trip without a time is in one part as well, among the later ones.
        later = (F.col("ts") >= split) | F.col("ts").isNull()
        events = events.filter(before if part == "stored" else later)
    number = F.col("event_id")
    second = F.unix_timestamp("ts")

    def at(seconds: Column) -> Column:
        """Wall-clock time by its seconds; does not go through the session time zone."""
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return start + F.expr("INTERVAL '1' SECOND") * seconds

    return events.select(
        number.alias("trip_id"),
        (number % 2 + 1).cast("int").alias("vendorid"),
        at(second).alias("tpep_pickup_datetime"),
        at(second + (number * 37) % 3600).alias("tpep_dropoff_datetime"),
        F.when(number % 50 != 0, (F.col("user_id") % 7).cast("int")).alias("passenger_count"),
        (F.col("value") / 10).alias("trip_distance"),
        F.when(number % 8 != 0, (number % 8).cast("int")).alias("payment_type"),
        (F.col("user_id") % 27).cast("int").alias("pulocationid"),
        (number % 26).cast("int").alias("dolocationid"),
        F.col("value").cast("decimal(18,2)").alias("total_amount"),
    )


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from ``nation``, three of them with unusable coordinates."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key = F.col("n_nationkey")

    def hundredths(start: int, step: float) -> Column:
        return (F.lit(start) + key * F.lit(step)).cast("decimal(9,2)").cast("string")

    return nation.select(
        key.alias("LocationID"),
        F.concat(F.lit("B"), F.col("n_regionkey").cast("string")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(key >= 23, "N/A").otherwise("Boro Zone").alias("service_zone"),
        F.when(key >= 23, "#N/A")
        .when(key == 22, "90.7")
        .otherwise(hundredths(40, 0.01))
        .alias("latitude"),
        F.when(key == 24, "#N/A").otherwise(hundredths(-74, -0.01)).alias("longitude"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones by way of a lookup file, which is how they are given.

    As a file, their coordinates are data. As expressions over the zone id, Spark would
    infer the coordinate filter for the trips too and work it out for each trip.
    """
    path = f"{scratch_folder(spark, 'zones')}/lookup"
    zone_rows(spark, sf_dir).write.csv(path, header=True)
    return read_zones(spark, path)


def with_copies(rows: DataFrame, every: int = 20) -> DataFrame:
    """Adds an exact copy of every ``every``-th trip, in the same task as its original."""
    copies = F.when(F.col("trip_id") % every == 0, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def with_end_markers(messages: DataFrame, every: int = 500) -> DataFrame:
    """Adds an end marker after every ``every``-th message, wherever its task stands."""
    marker = F.lit(f'{{"{END_MARKER}":true}}')
    marked = F.xxhash64("value") % every == 0
    values = F.when(marked, F.array("value", marker)).otherwise(F.array("value"))
    return messages.select(F.explode(values).alias("value"))
