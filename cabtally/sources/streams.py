"""Message and record streams, and the sinks they are published to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cabtally.sources.files import csv_options
from cabtally.sources.records import encode_json

FILE_DEFAULTS = {
    "maxFilesPerTrigger": "1000",
    "recursiveFileLookup": "true",
    # Spark ignores files a week older than the newest one, except at the first start.
    # A job that runs once a month must not lose them.
    "maxFileAge": "36500d",
}


def kafka_source_options(
    servers: str, topic: str, starting: str = "latest", per_batch: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def open_stream(
    spark: SparkSession,
    kind: str,
    path: str | None = None,
    schema: str | StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """An unbounded frame from ``kafka``, ``text``, ``json``, ``csv`` or ``parquet``.

    ``kafka`` and ``text`` give messages in the column ``value``. File kinds take up
    new files below ``path``, also in nested folders.
    """
    reader = spark.readStream.format(kind)
    if kind == "kafka":
        return reader.options(**(options or {})).load()
    defaults = FILE_DEFAULTS | (csv_options() if kind == "csv" else {})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(defaults | (options or {}))).load(path)


def publish(
    frame: DataFrame,
    kind: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Append the rows as JSON messages to ``kafka`` or to ``text`` files.

    Every task publishes its own rows, so nothing is gathered.
    """
    encode_json(frame).write.format(kind).options(**(options or {})).mode("append").save(path)
