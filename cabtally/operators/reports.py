"""Reports over stored tables and trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabtally.fixed_values import PREVIEW_ROWS
from cabtally.functions.trips import content_id, row_id, trip_minutes


def with_duration(trips: DataFrame) -> DataFrame:
    """Adds ``trip_duration`` in minutes."""
    return trips.withColumn(
        "trip_duration",
        trip_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")),
    )


def trip_store(trips: DataFrame) -> DataFrame:
    """Trips with ``trip_duration`` and a random ``id``, ready to be written once."""
    return with_duration(trips).withColumn("id", row_id())


def identified(trips: DataFrame, *position: Column) -> DataFrame:
    """Trips with an ``id`` from what they hold, ``position`` (for example their file), and a
    number among equal trips there: the same trips have the same ids in each run.

    Equal trips are counted, not gathered: they are one row until they get their numbers.
    """
    places = {f"_position_{i}": column for i, column in enumerate(position)}
    rows = trips.withColumns(places) if places else trips
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    named = content_id(*[F.col(name) for name in [*rows.columns, "_copy"]]).alias("id")
    return numbered.select(*trips.columns, named)


def id_audit(store: DataFrame) -> DataFrame:
    """(rows, distinct_ids, id_length) of a trip store.

    The distinct count is exact, so it shuffles every id; as 16 bytes, not 36 characters.
    """
    packed = F.unhex(F.replace("id", F.lit("-"), F.lit("")))
    return store.select(F.length("id").alias("length"), packed.alias("packed")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("packed").alias("distinct_ids"),
        F.max("length").alias("id_length"),
    )


def ordered_report(totals: DataFrame) -> DataFrame:
    """Revenue by day in calendar order; keys are numbers, so month 2 precedes month 10."""
    return totals.select("year", "month", "day", "total_amount").orderBy("year", "month", "day")


def preview(trips: DataFrame, order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First ``rows`` trips by ``order``: each task keeps only its own first rows."""
    return trips.orderBy(order).limit(rows)


class StageCounts:
    """Counts that a job's own run makes as rows pass its stages; nothing is read twice."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def at(self, stage: str, frame: DataFrame, **conditions: Column) -> DataFrame:
        """``frame``, whose rows count as ``stage``, and those that meet a condition as its name."""
        self._seen[stage] = Observation()
        more = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
        return frame.observe(self._seen[stage], F.count(F.lit(1)).alias("rows"), *more)

    def report(self, spark: SparkSession) -> DataFrame:
        """``(stage, rows)``: a handful of numbers. Waits for the run, which has to be a write
        or another action on the frames themselves."""
        found = []
        for stage, seen in self._seen.items():
            found += [(stage if name == "rows" else name, count) for name, count in seen.get.items()]
        rows = [F.struct(F.lit(stage).alias("stage"), F.lit(n).cast("bigint").alias("rows")) for stage, n in found]
        return spark.range(1).select(F.inline(F.array(*rows)))


def stage_row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) of the named stages of a job."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, frame in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)
