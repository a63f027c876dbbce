"""CSV files and the JDBC import."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabtally.fixed_values import TRIP_FIELDS, ZONE_FIELDS
from cabtally.sources.records import ddl, lower_case, typed, wire_fields
from cabtally.sources.storage import Storage


#: Headers that are read at a time, each a small request to the file system.
HEADER_READERS = 16


def csv_options(inferred: bool = False) -> dict[str, str]:
    options = {"header": "true", "recursiveFileLookup": "true"}
    if inferred:
        return options | {"inferSchema": "true"}
    # With enforceSchema off, Spark compares each header with the schema and refuses a
    # file whose columns are in another order, instead of reading them by position.
    return options | {"enforceSchema": "false"}


def layouts(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Only first lines are read, by small requests."""
    files = spark.read.option("recursiveFileLookup", "true").text(paths).inputFiles()

    def header(file: str) -> tuple[str, ...]:
        line = Storage(spark, file).first_line(file).removeprefix("\ufeff")
        return tuple(next(csv.reader([line]), []))

    with ThreadPoolExecutor(HEADER_READERS) as pool:
        found: dict[tuple[str, ...], list[str]] = {}
        for file, names in zip(files, pool.map(header, files), strict=True):
            if names:
                found.setdefault(names, []).append(file)
    return found


def layout_schema(header: tuple[str, ...], fields: Mapping[str, str]) -> StructType:
    """What stands in a file's columns: wire values of known fields, or else text."""
    wire = wire_fields(fields)
    return StructType.fromDDL(
        ddl({name or f"_c{i}": wire.get(name.lower(), "string") for i, name in enumerate(header)})
    )


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    fields: Mapping[str, str] | None = TRIP_FIELDS,
    others: bool = False,
) -> DataFrame:
    """CSV files, folders or globs with a header, as wire values with lower-case names.

    Columns are matched by name, file by file: they may be in any order, a field that a
    file lacks is null. ``others`` keeps the columns that are no fields, as text.
    ``fields=None`` infers the columns, at the cost of one more pass over the files.
    """
    if fields is None:
        return lower_case(spark.read.options(**csv_options(inferred=True)).csv(paths))
    rows = None
    for header, files in layouts(spark, paths).items():
        reader = spark.read.schema(layout_schema(header, fields))
        # The schema has been made from these files' header, so positions are right.
        part = lower_case(reader.option("header", "true").csv(files))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None:
        rows = spark.range(0).select()
    wire = wire_fields(fields)
    missing = [name for name in fields if name not in rows.columns]
    rows = rows.withColumns({name: F.lit(None).cast(wire[name]) for name in missing})
    first = list(fields)
    return rows.select(*first, *[n for n in rows.columns if others and n not in first])


def read_trips(
    spark: SparkSession,
    paths: str | list[str],
    fields: Mapping[str, str] = TRIP_FIELDS,
) -> DataFrame:
    return typed(read_csv(spark, paths, fields), fields)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_csv(spark, path, ZONE_FIELDS), ZONE_FIELDS)


def jdbc_options(
    url: str,
    table: str,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC scan. More than one split needs a column and its value range."""
    options = {"url": url, "dbtable": table, **properties}
    if splits > 1:
        if split_by is None or bounds is None:
            raise ValueError("a split import needs split_by and bounds")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return options


def import_table(
    spark: SparkSession,
    options: Mapping[str, str],
    path: str | None = None,
    table: str | None = None,
) -> None:
    """Copy a JDBC table to Parquet files, or to a catalog table."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    writer = spark.read.format("jdbc").options(**options).load().write.mode("overwrite")
    if path is not None:
        writer.parquet(path)
    else:
        writer.format("parquet").saveAsTable(table)
