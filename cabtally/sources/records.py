"""Trip records: column names, wire types, JSON encoding and decoding.

On the wire a whole number may read ``1.0``, a missing number ``NaN``, and column names
may have any case. Numbers are therefore taken as double and times as text, and
:func:`typed` converts them in one step.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabtally.fixed_values import END_MARKER, TRIP_FIELDS

MALFORMED = "_malformed"
REST = "rest"


def lower_case(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.lower() for name in frame.columns])


def ddl(fields: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


def wire_fields(fields: Mapping[str, str]) -> dict[str, str]:
    """How ``fields`` travel: numbers as double (exact integers as bigint), the rest as text."""

    def wire(kind: str) -> str:
        if kind in ("bigint", "boolean"):
            return kind
        return "string" if kind in ("string", "timestamp_ntz") else "double"

    return {name: wire(kind) for name, kind in fields.items()}


def _no_nan(name: str, wire: str) -> Column:
    column = F.col(name)
    return column if wire != "double" else F.nanvl(column, F.lit(None).cast("double"))


def typed(rows: DataFrame, fields: Mapping[str, str] = TRIP_FIELDS) -> DataFrame:
    """Wire values to the types of ``fields``; a value that does not convert is null."""
    wire = wire_fields(fields)
    return rows.select(
        *[_no_nan(name, wire[name]).try_cast(kind).alias(name) for name, kind in fields.items()]
    )


def encode_json(frame: DataFrame) -> DataFrame:
    """One JSON object per row, in the column ``value``; names in lower case."""
    return lower_case(frame).select(F.to_json(F.struct("*")).alias("value"))


def decode_json(
    messages: DataFrame,
    fields: Mapping[str, str] = TRIP_FIELDS,
    keep_malformed: bool = False,
    keep_rest: bool = False,
) -> DataFrame:
    """Messages (column ``value``, text or bytes) to wire values. End markers are dropped.

    A value of the wrong kind is null, and so is all of a message that is no JSON object.
    ``keep_malformed`` adds the text of either in ``_malformed``, which else is null.
    ``keep_rest`` adds what a message has besides the fields as JSON in ``rest``, null if
    there is nothing; that takes a second parse.
    """
    wanted = wire_fields(fields) | {END_MARKER: "boolean"}
    if keep_malformed:
        wanted[MALFORMED] = "string"
    record = F.from_json(
        F.col("value").cast("string"), ddl(wanted), {"columnNameOfCorruptRecord": MALFORMED}
    )
    # inline() holds the parser in a node of its own: a filter on the fields stays above it,
    # where a plain projection would be merged with the filter and parse each message twice.
    # Spark does not prune fields through it, so callers pass only those they need.
    if keep_rest:
        known = F.array(*map(F.lit, wanted))
        every = F.from_json(F.col("value").cast("string"), "map<string,string>")
        rest = F.map_filter(every, lambda name, _: ~F.array_contains(known, name))
        rest = F.when(F.size(rest) > 0, F.to_json(rest))
        rows = messages.select(rest.alias(REST), F.inline(F.array(record)))
    else:
        rows = messages.select(F.inline(F.array(record)))
    return rows.filter(~F.coalesce(F.col(END_MARKER), F.lit(False))).drop(END_MARKER)


def decode_trips(messages: DataFrame, fields: Mapping[str, str] = TRIP_FIELDS) -> DataFrame:
    """Messages to typed trips."""
    return typed(decode_json(messages, fields), fields)
