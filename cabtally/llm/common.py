"""What several operators share: tables, written intermediate results, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.sources.storage import scratch_folder

#: White space throughout the operators: ASCII blank, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
#: The session's number of cores that scans are split for.
CORES = "spark.sql.leafNodeDefaultParallelism"
#: The session's number of rows that Python gets at once.
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whether a query's shuffle files go as soon as it ends.
SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: cuts the lineage, and gives
    every later use the same rows even if executors are lost in between."""
    path = f"{scratch_folder(frame.sparkSession, purpose)}/data"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run meanwhile give Python at most so many rows at once: with long rows, Spark and
    the worker otherwise hold tens of megabytes of them, several times over."""
    before = spark.conf.get(ROWS_AT_ONCE, None)
    asked = int(before or 0)
    spark.conf.set(ROWS_AT_ONCE, str(min(asked, rows) if asked > 0 else rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ROWS_AT_ONCE)
        else:
            spark.conf.set(ROWS_AT_ONCE, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is written. Else they stay until
    the driver happens to collect its garbage, and a job of several steps holds them all."""
    before = spark.conf.get(SHUFFLES_FREED, None)
    spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_FREED)
        else:
            spark.conf.set(SHUFFLES_FREED, before)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, whose freed memory goes back to the system when a task
    ends, as the worker waits for other work with all it has."""

    def freed(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim is not None:
            trim(0)

    return freed


def numbered(frame: DataFrame, name: str) -> DataFrame:
    """A column that tells rows apart, repeated ones too. It is the same each time the
    frame is computed as long as its rows come in the same order: true of a file scan and
    of a sorted partition, so give other frames through ``stored``. Spark splits files anew
    for each action, by the number of cores there are; that number is held fixed in the
    session, so a later scan has the same partitions when executors have come or gone."""
    spark = frame.sparkSession
    if spark.conf.get(CORES, None) is None:
        spark.conf.set(CORES, str(spark.sparkContext.defaultParallelism))
    return frame.withColumn(name, F.monotonically_increasing_id())


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or it with underscores behind if ``frame`` has such a column."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``(node, root)`` of each node of the undirected edges ``(a, b)``, where root is the
    smallest node that can be reached. Nodes are longs; nodes without edges do not appear.

    Alternating large and small stars: every round hangs the neighbours of a node below
    its smallest neighbour. Only minima per node are aggregated, never neighbour lists, so
    a node with very many edges is no group in memory. A round's edges are written, so a
    lost executor repeats one round at most.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        purpose,
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours go below the smallest of a node and its neighbours.
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
            .join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        # Small star: smaller neighbours and the node itself go below the smallest of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(down.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, purpose)
        state = edges.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
