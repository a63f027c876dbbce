"""Zone tables and hot-spots.

Trips are counted per location first, so only one row per location meets the zones.
There is no forced broadcast: Spark broadcasts the zones when their size is below
``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabtally.fixed_values import LATITUDE_RANGE, LONGITUDE_RANGE, PARTITION_KEY


def _coordinate(text: Column) -> Column:
    return text.try_cast("double")


def heat_points(trips: DataFrame, zones: DataFrame, location: str) -> DataFrame:
    """(latitude, longitude, weight): trips per point, for the valid points only.

    ``location`` is the trip column that holds the zone id. Text that is no number,
    and numbers outside the globe, are no points.
    """
    visits = (
        trips.select(F.col(location).alias("locationid"))
        .na.drop()
        .groupBy("locationid")
        .agg(F.count(F.lit(1)).alias("visits"))
    )
    points = zones.select(
        "locationid",
        _coordinate(F.col("latitude")).alias("latitude"),
        _coordinate(F.col("longitude")).alias("longitude"),
    ).filter(
        F.col("latitude").between(*LATITUDE_RANGE) & F.col("longitude").between(*LONGITUDE_RANGE)
    )
    return (
        visits.join(points, "locationid")
        .groupBy("latitude", "longitude")
        .agg(F.sum("visits").alias("weight"))
    )


def location_table(trips: DataFrame, zones: DataFrame, location: str) -> DataFrame:
    """The zones that occur in ``location``; an id without a zone has nulls."""
    visited = trips.select(F.col(location).alias("locationid")).na.drop().distinct()
    return visited.join(
        zones.select("locationid", "borough", "zone", "service_zone"), "locationid", "left"
    ).withColumn("partition_key", F.lit(PARTITION_KEY))
