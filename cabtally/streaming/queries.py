"""What every streaming query here shares: a checkpoint, a trigger and a name."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cabtally.sources.storage import Storage

BatchFunction = Callable[[DataFrame, int, str], None]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint. A query's own thread knows it too, but
    not where Python threads are not pinned to Java ones."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    found = json.loads(Storage(spark, path).read(path)).get("id")
    if not found:
        raise ValueError(f"{path} names no query: without it nothing guards against replays")
    return found


#: How queries keep their state: on the executors' disks, with a log of changes per batch, so
#: a batch writes what has changed however large the state is; compressed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "lz4",
}


def start(
    stream: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    mode: str = "append",
    partitions: int | None = None,
) -> StreamingQuery:
    """Run ``on_batch(rows, batch id, query id)`` for each micro-batch.

    Without ``every`` the query takes what is there and ends. The query id is kept in
    the checkpoint: it survives a restart and differs for every new checkpoint, so
    (query id, batch id) names a batch for good. ``partitions`` is the number of state
    partitions, which the checkpoint fixes at the first start.
    """

    def call(rows: DataFrame, batch: int) -> None:
        on_batch(rows, batch, query_id(rows.sparkSession, checkpoint))

    writer = stream.writeStream.foreachBatch(call).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = (
        writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    )
    # The query copies the session's settings when it starts.
    conf = stream.sparkSession.conf
    wanted = STATE_STORE | ({} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)})
    before = {name: conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        return writer.start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows of a query's state, ``key`` and ``value``, as of its last batch."""
    return spark.read.format("statestore").load(checkpoint)


def finish(query: StreamingQuery) -> None:
    """Wait for the end of a query that takes what is there; raises if it failed."""
    query.awaitTermination()
