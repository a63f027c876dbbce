"""Keyed incremental merge: stored totals plus new contributions, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_totals(
    stored: DataFrame | None,
    contributions: DataFrame,
    keys: Sequence[str],
    measures: dict[str, str],
) -> DataFrame:
    """Add ``contributions`` to ``stored`` by key; ``measures`` maps a column to its type.

    The result is that of a full outer join of the stored totals with the summed
    contributions, both sides defaulting to 0. Summing the union gives it with one
    shuffle and no join: each task first combines its own rows, so a key that holds
    most of the input still sends one row per task, and contributions need not be
    aggregated beforehand. A key whose measures are all null has a total of 0.
    """
    columns = [*keys, *measures]
    rows = contributions.select(*columns)
    if stored is not None:
        rows = rows.unionByName(stored.select(*columns))
    return rows.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(name).cast(kind), F.lit(0).cast(kind)).alias(name)
            for name, kind in measures.items()
        ]
    )


def upsert(stored: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace stored rows by key with ``changes`` and add the keys that are new.

    ``changes`` holds each key at most once.
    """
    columns, rest = stored.columns, [name for name in stored.columns if name not in keys]
    # Both sides are read once, which an anti-join would not do: behind ``changes`` can be
    # the state stage of a stream, which would run again.
    rows = stored.withColumn("_order", F.lit(0)).unionByName(
        changes.select(*columns).withColumn("_order", F.lit(1))
    )
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_order").alias("_last"))
    # Few rows come in as many tasks as the state has; written as they are, each would be
    # a file. Rebalancing makes files of the session's advisory size, however many rows.
    return last.select(*keys, "_last.*").select(*columns).hint("rebalance")
