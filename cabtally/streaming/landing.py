"""Landing: JSON messages to de-duplicated CSV files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabtally.fixed_values import TRIP_FIELDS
from cabtally.sources.records import MALFORMED, REST, decode_json
from cabtally.sources.storage import Storage
from cabtally.streaming.queries import start


ARRIVED = "_arrived"


def land_batch(
    messages: DataFrame,
    folder: str,
    batch: str,
    fields: Mapping[str, str] = TRIP_FIELDS,
) -> bool:
    """Write the distinct records of one batch as CSV files below ``folder/batch``.

    The files are written aside and appear together, in one rename, so a reader never
    sees a part of a batch. A batch that is there already is left alone: false is
    returned. The text of messages that did not decode in full goes to
    ``folder/_malformed/batch``; what did decode of them is landed. What a message has
    besides the fields is landed too, as JSON in the column ``rest``.
    """
    decoded = decode_json(messages, fields, keep_malformed=True, keep_rest=True)
    return _land(decoded, folder, batch, fields)


def _land(decoded: DataFrame, folder: str, batch: str, fields: Mapping[str, str]) -> bool:
    folder = folder.rstrip("/")
    storage = Storage(decoded.sparkSession, folder)
    target = f"{folder}/{batch}"
    if storage.exists(target):
        return False

    seen = Observation()
    counted = decoded.observe(seen, F.count(F.col(MALFORMED)).alias("malformed"))
    decodes = reduce(or_, [F.col(name).isNotNull() for name in [*fields, REST]])
    records = counted.filter(F.col(MALFORMED).isNull() | decodes).select(*fields, REST)
    aside = f"{folder}/_writing/{batch}"
    records.dropDuplicates().write.mode("overwrite").csv(aside, header=True)
    if seen.get["malformed"]:
        malformed = decoded.select(MALFORMED).na.drop()
        malformed.write.mode("overwrite").text(f"{folder}/_malformed/{batch}")
    storage.rename(aside, target)
    return True


def land_stream(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    fields: Mapping[str, str] = TRIP_FIELDS,
    across: str | None = None,
    **options: str | int | None,
) -> StreamingQuery:
    """Land each micro-batch on its own; copies are removed within a micro-batch.

    With ``across``, a duration such as ``2 days``, copies that arrive up to that long after
    the first one are removed too, whichever micro-batches they are in. Spark's state then
    holds the records of that time, by their hash spread over ``partitions``.
    """

    def land(rows: DataFrame, batch_id: int, query_id: str) -> None:
        land_batch(rows, folder, f"{query_id}/batch-{batch_id:010d}", fields)

    if across is None:
        return start(messages, land, checkpoint, **options)

    def land_new(rows: DataFrame, batch_id: int, query_id: str) -> None:
        # What is malformed may be written by a second action, which must not run the state again.
        rows = rows.persist()
        try:
            _land(rows.drop(ARRIVED), folder, f"{query_id}/batch-{batch_id:010d}", fields)
        finally:
            rows.unpersist()

    decoded = decode_json(messages, fields, keep_malformed=True, keep_rest=True)
    arrived = decoded.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, across)
    new = arrived.dropDuplicatesWithinWatermark([*fields, REST, MALFORMED])
    return start(new, land_new, checkpoint, **options)
