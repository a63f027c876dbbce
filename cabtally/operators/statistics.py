"""The keyed trip statistics, each a parameterisation of the keyed merge."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabtally.fixed_values import PARTITION_KEY, PAYMENT_TYPES, REVENUE_STARTS_AFTER
from cabtally.functions.trips import (
    distance_class,
    duration_class,
    hour_label,
    money,
    trip_minutes,
)
from cabtally.operators.merge import merge_totals

COUNT = {"count": "bigint"}
#: The column of :func:`combine` that names a row's statistic.
SET = "_statistic"
#: As wide as a sum of amounts can be.
REVENUE = {"total_amount": "decimal(38,2)"}


@dataclass(frozen=True)
class Statistic:
    """Trips summed up by key.

    ``needs`` names the trip columns the keys are made of; a trip without one of them
    has no key and does not count. ``keys`` gives the type and the expression of each
    key column, ``value`` what one trip adds to the measure. ``batch_filter`` selects
    the trips that count when files are processed as a batch. ``also_reads`` names the
    trip columns these two use. ``present`` turns stored totals into the published table.
    """

    name: str
    needs: tuple[str, ...]
    keys: dict[str, tuple[str, Callable[[], Column]]]
    measures: dict[str, str]
    value: Callable[[], Column]
    present: Callable[[DataFrame], DataFrame]
    batch_filter: Callable[[], Column] | None = None
    also_reads: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        """The trip columns the statistic is made of; a decoder need not read others."""
        return self.needs + self.also_reads

    @property
    def measure(self) -> str:
        (name,) = self.measures
        return name

    @property
    def schema(self) -> str:
        """DDL of the stored totals."""
        columns = {key: kind for key, (kind, _) in self.keys.items()} | self.measures
        return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())

    def contributions(self, trips: DataFrame, batch: bool = False) -> DataFrame:
        """What each trip adds, as (keys, measure)."""
        # Nulls are tested on the trip's columns, not on the keys: the test then reaches
        # the scan, and the keys are worked out once.
        for column in self.needs:
            trips = trips.filter(F.col(column).isNotNull())
        if batch and self.batch_filter is not None:
            trips = trips.filter(self.batch_filter())
        return trips.select(*self._key_columns(), self.value().alias(self.measure))

    def totals(
        self, trips: DataFrame, stored: DataFrame | None = None, batch: bool = False
    ) -> DataFrame:
        """Totals of ``trips`` added to ``stored``."""
        return self.add(self.contributions(trips, batch), stored)

    def add(self, contributions: DataFrame, stored: DataFrame | None = None) -> DataFrame:
        return merge_totals(stored, contributions, list(self.keys), self.measures)

    def from_combined(self, combined: DataFrame) -> DataFrame:
        """The (keys, measure) rows of this statistic in the result of :func:`combine`."""
        return combined.filter(F.col(SET) == self.name).select(
            *[F.col(f"`{self.name}.{key}`").alias(key) for key in self.keys], self.measure
        ).na.drop(subset=list(self.keys))

    def _key_columns(self, prefix: str = "", only_if: Column | None = None) -> list[Column]:
        return [
            (column() if only_if is None else F.when(only_if, column()))
            .cast(kind)
            .alias(prefix + key)
            for key, (kind, column) in self.keys.items()
        ]


def combine(trips: DataFrame, statistics: Iterable[Statistic], batch: bool = False) -> DataFrame:
    """One pass for several statistics: trips summed up by the keys of each, side by side.

    Grouping sets, one for each statistic, so the rows that are shuffled and kept follow the
    sum of the numbers of keys, not their product, also where a code has very many values.
    ``Statistic.from_combined`` takes each statistic out of it; a trip that does not count
    for a statistic has null keys there.
    """
    statistics = list(statistics)
    keys: list[Column] = []
    sums: dict[str, Column] = {}
    for statistic in statistics:
        only_if = statistic.batch_filter() if batch and statistic.batch_filter else None
        keys += statistic._key_columns(f"{statistic.name}.", only_if)
        sums[statistic.measure] = statistic.value().alias(f"_{statistic.measure}")
    rows = trips.select(*keys, *sums.values())
    own = [[F.col(f"`{s.name}.{key}`") for key in s.keys] for s in statistics]
    grouped = rows.groupingSets(own, *[column for columns in own for column in columns]).agg(
        F.grouping_id().alias(SET), *[F.sum(f"_{name}").alias(name) for name in sums]
    )
    # A bit is set for each key that a set leaves out, the first key's is the highest.
    total, at, names = sum(map(len, own)), 0, []
    for statistic, columns in zip(statistics, own, strict=True):
        bits = sum(1 << (total - 1 - i) for i in range(total) if not at <= i < at + len(columns))
        names += [F.lit(bits).cast("long"), F.lit(statistic.name)]
        at += len(columns)
    return grouped.withColumn(SET, F.create_map(*names)[F.col(SET).cast("long")])


def fields_of(statistics: Iterable[Statistic], fields: Mapping[str, str]) -> dict[str, str]:
    """The part of ``fields`` that ``statistics`` are made of."""
    wanted = {column for statistic in statistics for column in statistic.columns}
    return {name: kind for name, kind in fields.items() if name in wanted}


def payment_labels(totals: DataFrame) -> DataFrame:
    """(payment_type, payment_type_name): a constant of six rows."""
    rows = ", ".join(f"({code}, '{label}')" for code, label in PAYMENT_TYPES.items())
    return totals.sparkSession.sql(
        f"SELECT * FROM VALUES {rows} AS labels(payment_type, payment_type_name)"
    )


def _keyed(totals: DataFrame) -> DataFrame:
    return totals.withColumn("partition_key", F.lit(PARTITION_KEY))


def _label_payment(totals: DataFrame) -> DataFrame:
    return _keyed(
        totals.join(payment_labels(totals), "payment_type", "left").select(
            "payment_type", "count", "payment_type_name"
        )
    )


def _as_double(totals: DataFrame) -> DataFrame:
    return totals.withColumn("total_amount", F.col("total_amount").cast("double"))


def with_date(totals: DataFrame) -> DataFrame:
    """Adds the calendar day of (year, month, day) as ``timestamp``."""
    return totals.withColumn("timestamp", F.make_date("year", "month", "day"))


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _revenue() -> Column:
    return money(F.col("total_amount"))


def _dropoff() -> Column:
    return F.col("tpep_dropoff_datetime")


def _after_start() -> Column:
    return F.col("tpep_pickup_datetime") > F.lit(REVENUE_STARTS_AFTER).cast("timestamp_ntz")


PASSENGERS = Statistic(
    name="passenger_number_statistics",
    needs=("passenger_count",),
    keys={"passenger_number": ("int", lambda: F.col("passenger_count"))},
    measures=COUNT,
    value=_one,
    present=_keyed,
)

PAYMENT_TYPE = Statistic(
    name="payment_type_statistics",
    needs=("payment_type",),
    keys={"payment_type": ("int", lambda: F.col("payment_type"))},
    measures=COUNT,
    value=_one,
    present=_label_payment,
)

PICKUP_HOUR = Statistic(
    name="pickup_hour_statistics",
    needs=("tpep_pickup_datetime",),
    keys={"pickup_hour": ("string", lambda: hour_label(F.col("tpep_pickup_datetime")))},
    measures=COUNT,
    value=_one,
    present=lambda totals: _keyed(totals).orderBy("pickup_hour"),
)

REVENUE_PER_DAY = Statistic(
    name="total_amount_statistics",
    needs=("tpep_dropoff_datetime",),
    keys={
        "year": ("int", lambda: F.year(_dropoff())),
        "month": ("int", lambda: F.month(_dropoff())),
        "day": ("int", lambda: F.dayofmonth(_dropoff())),
    },
    measures=REVENUE,
    value=_revenue,
    present=lambda totals: _keyed(with_date(_as_double(totals))),
    batch_filter=_after_start,
    also_reads=("tpep_pickup_datetime", "total_amount"),
)

# ISO weeks: the week number belongs to the year of the week, not of the date.
REVENUE_PER_WEEK = Statistic(
    name="total_amount_week_statistics",
    needs=("tpep_dropoff_datetime",),
    keys={
        "year": ("int", lambda: F.extract(F.lit("YEAROFWEEK"), _dropoff())),
        "week": ("int", lambda: F.weekofyear(_dropoff())),
    },
    measures=REVENUE,
    value=_revenue,
    present=lambda totals: _keyed(_as_double(totals)),
    batch_filter=_after_start,
    also_reads=("tpep_pickup_datetime", "total_amount"),
)

DISTANCE = Statistic(
    name="trip_distance_statistics",
    needs=("trip_distance",),
    keys={"trip_distance": ("string", lambda: distance_class(F.col("trip_distance")))},
    measures=COUNT,
    value=_one,
    present=lambda totals: totals,
)

DURATION = Statistic(
    name="trip_duration_statistics",
    needs=("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    keys={
        "duration_class": (
            "string",
            lambda: duration_class(trip_minutes(F.col("tpep_pickup_datetime"), _dropoff())),
        )
    },
    measures=COUNT,
    value=_one,
    present=lambda totals: totals,
)

STATISTICS = {
    "passengers": PASSENGERS,
    "payment-type": PAYMENT_TYPE,
    "pickup-hour": PICKUP_HOUR,
    "revenue-per-day": REVENUE_PER_DAY,
    "revenue-per-week": REVENUE_PER_WEEK,
    "distance": DISTANCE,
    "duration": DURATION,
}
