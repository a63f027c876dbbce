"""Statistics kept up to date by streams of trips."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabtally.functions.trips import unusable
from cabtally.operators.merge import upsert
from cabtally.operators.statistics import Statistic, combine
from cabtally.sources.tables import SnapshotTable
from cabtally.streaming.queries import start

# One row per key and few keys: a handful of state partitions, not one per core.
STATE_PARTITIONS = 8

Committed = Callable[[Statistic, SnapshotTable], None]


def open_table(spark: SparkSession, folder: str, statistic: Statistic) -> SnapshotTable:
    return SnapshotTable(spark, f"{folder.rstrip('/')}/{statistic.name}", statistic.schema)


def add_to_tables(
    trips: DataFrame,
    statistics: list[Statistic],
    folder: str,
    stream: str | None = None,
    batch_id: int = 0,
    batch: bool = False,
    committed: Committed | None = None,
) -> None:
    """Add ``trips``, read once, to the stored totals of all ``statistics``.

    With several statistics the trips are first summed up by all keys together, and
    that small result is kept while the tables are written from it, side by side.
    ``committed`` is then called for each, also for tables that had the batch already: when
    a batch is repeated, the failure may have come between a table's commit and the call.
    """
    tables = {s.name: open_table(trips.sparkSession, folder, s) for s in statistics}
    due = [s for s in statistics if stream is None or not tables[s.name].has(stream, batch_id)]
    combined = combine(trips, due, batch).persist() if len(due) > 1 else None

    def add(statistic: Statistic) -> None:
        table = tables[statistic.name]
        if combined is None:
            new = statistic.contributions(trips, batch)
        else:
            new = statistic.from_combined(combined)
        table.update(partial(statistic.add, new), stream, batch_id)

    try:
        if len(due) == 1:
            add(due[0])
        elif due:
            combined.count()  # once, before all tables ask for it
            run = inheritable_thread_target(trips.sparkSession)
            with ThreadPoolExecutor(len(due)) as pool:
                for done in [pool.submit(run(add), s) for s in due]:
                    done.result()
        if committed is not None:
            # One after the other: what they write to may be one place.
            for statistic in statistics:
                committed(statistic, tables[statistic.name])
    finally:
        if combined is not None:
            combined.unpersist()


def merge_stream(
    trips: DataFrame,
    statistics: list[Statistic],
    folder: str,
    checkpoint: str,
    batch: bool = False,
    committed: Committed | None = None,
    **options: str | None,
) -> StreamingQuery:
    """Add each micro-batch of ``trips`` to the stored totals of ``statistics``.

    The source is read once, however many statistics there are. With ``batch`` the
    batch filters apply, as for files. ``committed`` is called after each update, for
    example to copy the totals to a connector table, and again when a batch is repeated.
    A query's progress tells, as observed metrics ``trips``, how many trips there were and
    how many amounts nothing could be made of.
    """

    def merge(rows: DataFrame, batch_id: int, query_id: str) -> None:
        add_to_tables(rows, statistics, folder, query_id, batch_id, batch, committed)

    bad = unusable(F.col("total_amount")) if "total_amount" in trips.columns else F.lit(False)
    counts = F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("unusable_amounts")
    return start(trips.observe("trips", *counts), merge, checkpoint, **options)


def running_totals_stream(
    trips: DataFrame,
    statistic: Statistic,
    folder: str,
    checkpoint: str,
    partitions: int = STATE_PARTITIONS,
    **options: str | None,
) -> StreamingQuery:
    """Totals kept in Spark's state store; the table receives the keys that changed.

    Each change carries the whole running total, so repeating a batch is harmless. A
    table is fed either by this or by :func:`merge_stream`, since this replaces totals.
    The keys are few and never expire, hence no watermark.
    """
    table = open_table(trips.sparkSession, folder, statistic)
    keys = list(statistic.keys)

    def replace(changes: DataFrame, batch_id: int, query_id: str) -> None:
        table.update(lambda stored: upsert(stored, changes, keys), query_id, batch_id)

    totals = statistic.totals(trips)
    return start(totals, replace, checkpoint, mode="update", partitions=partitions, **options)


def state_value(state: DataFrame) -> Column:
    """The running total in the rows of :func:`state_of`: the state holds one sum per key."""
    (field,) = state.schema["value"].dataType.names[:1]
    return F.coalesce(F.col(f"value.`{field}`"), F.lit(0).cast("bigint"))


def latest(spark: SparkSession, folder: str, statistic: Statistic) -> DataFrame:
    """The published form of a stored statistic."""
    return statistic.present(open_table(spark, folder, statistic).read())


def combined_report(spark: SparkSession, folder: str, statistics: list[Statistic]) -> DataFrame:
    """(statistic, key, total) over several stored tables, keys as text."""
    report = None
    for statistic in statistics:
        rows = open_table(spark, folder, statistic).read()
        rows = rows.select(
            F.lit(statistic.name).alias("statistic"),
            F.concat_ws("-", *[F.col(key).cast("string") for key in statistic.keys]).alias("key"),
            F.col(statistic.measure).cast("double").alias("total"),
        )
        report = rows if report is None else report.unionByName(rows)
    return report
