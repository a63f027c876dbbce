"""Column expressions over a trip. All are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabtally.fixed_values import DISTANCE_CLASSES, DURATION_CLASSES, ID_NAMESPACE, LAST_CLASS


def _class_of(value: Column, upper_bounds: dict[str, int]) -> Column:
    """First class whose bound lies above ``value``; null stays null."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for name, bound in upper_bounds.items():
        label = label.when(value < bound, name)
    return label.otherwise(LAST_CLASS)


def distance_class(distance: Column) -> Column:
    return _class_of(distance, DISTANCE_CLASSES)


def duration_class(minutes: Column) -> Column:
    return _class_of(minutes, DURATION_CLASSES)


def trip_minutes(pickup: Column, dropoff: Column) -> Column:
    """Fractional minutes between two wall-clock times."""
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / 60


def hour_label(at: Column) -> Column:
    """``HH:00``; null for a null time."""
    return F.concat(F.lpad(F.hour(at).cast("string"), 2, "0"), F.lit(":00"))


def money(amount: Column) -> Column:
    """Exact currency value, so sums do not depend on the order of rows.

    An amount that is no number, or has more than 26 digits before the point, becomes null
    and adds nothing; :func:`unusable` tells which do, so that jobs can count them.
    """
    return amount.try_cast("decimal(28,2)")


def unusable(amount: Column) -> Column:
    """Whether there is an amount that :func:`money` can make nothing of."""
    return amount.isNotNull() & money(amount).isNull()


def row_id() -> Column:
    """A random UUID per row.

    Apply it to a scan and write the result once: the values are not reproducible
    from one execution to the next.
    """
    return F.expr("uuid()")


def content_id(*parts: Column) -> Column:
    """A name-based UUID (version 5) of the text of ``parts``, the same in each run. Nulls
    and the bounds of parts count."""
    named = [F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    name = F.concat(F.unhex(F.lit(ID_NAMESPACE.replace("-", ""))), F.concat_ws("|", *named).cast("binary"))
    digest = F.sha1(name)
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
