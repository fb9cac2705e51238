"""New files in, rows appended once, however often a run is repeated."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tideline.functions.names import resolve
from tideline.functions.text import NULL_TOKENS, blank_to_null
from tideline.operators.reconcile import CHECK_SCHEMA, FAILED, PASSED
from tideline.sinks.history import append_history
from tideline.sources.union import with_source_file

BATCH = "ingest_batch"
QUERY = "ingest_query"
STREAM_COUNT = "STREAM_COUNT"


def stream_files(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    sep: str = ",",
    header: bool = True,
    null_tokens: Sequence[str] = NULL_TOKENS,
    files_per_batch: int = 1,
) -> DataFrame:
    """A stream over the files of a folder, all columns text, with their path."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    stream = (
        spark.readStream.schema(schema).option("header", header).option("sep", sep).option("escape", '"')
        # A file whose header names other columns stops the stream instead of filling the wrong ones.
        .option("enforceSchema", not header)
        .option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )
    return blank_to_null(with_source_file(stream), null_tokens, list(names))


def append_stream(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None, name: str | None = None) -> None:
    """Process what is there, then stop.  The file sink's log makes appends exactly-once."""
    writer = stream.writeStream.queryName(name) if name else stream.writeStream
    query = (
        writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    _finish(query, timeout)


def for_each_batch(
    stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, timeout: int | None = None
) -> None:
    """Run a whole batch job (``step``) on every micro-batch and append its result.

    A batch writes its own partition folder, named after its checkpoint's query and
    its number, and replaces it when repeated after a failure: no file is loaded
    twice, and another checkpoint's batches stay.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path}/{QUERY}={query_id(batch)}/{BATCH}={batch_id}")

    query = (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    _finish(query, timeout)


def without_repeats(stream: DataFrame, keys: Sequence[str], event_time: str | None = None, within: str | None = None) -> DataFrame:
    """The first row of each key, also across restarts: the keys seen are the query's state.

    With ``event_time`` and ``within`` a key is forgotten that long after its time, so the state
    stays bounded; without them every key is remembered.
    """
    keys = resolve(keys, stream.columns, "key columns")
    if (event_time is None) != (within is None):
        raise ValueError("event_time and within go together")
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(keys)


class BatchCounts(StreamingQueryListener):
    """Collects what a query's micro-batches observed as ``read`` and ``written``."""

    def __init__(self, name: str):
        self.name = name
        self.counts: list[tuple[int, int, int]] = []  # batch, rows read, rows written
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics
        if event.progress.name == self.name and event.progress.numInputRows and "read" in seen:
            self.counts.append((event.progress.batchId, seen["read"]["rows"], seen["written"]["rows"]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def counted_append(
    stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, table: str, history_path: str, timeout: int | None = None
) -> int:
    """Append ``step``'s rows of a stream and one check row for each micro-batch to the history; the number of batches.

    Rows are counted as they pass, before and after the step; nothing is read again.  A step
    that is meant to drop rows has a smaller target count, and its checks still pass; one that
    writes more rows than it read fails them.
    """
    spark = stream.sparkSession
    counts = BatchCounts(f"counted-{uuid.uuid4().hex}")
    rows = F.count(F.lit(1)).alias("rows")
    spark.streams.addListener(counts)
    try:
        append_stream(step(stream.observe("read", rows)).observe("written", rows), path, checkpoint, timeout, counts.name)
        counts.ended.wait(60)
    finally:
        spark.streams.removeListener(counts)
    checks = [
        (STREAM_COUNT, table, read, written, None, None, round(100 * written / read, 2), PASSED if written <= read else FAILED, f"batch {batch}")
        for batch, read, written in sorted(counts.counts)
    ]
    if checks:
        append_history(spark.createDataFrame(checks, CHECK_SCHEMA), history_path)
    return len(checks)


def query_id(batch: DataFrame) -> str:
    """The id that a checkpoint gives its query, however often it restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _finish(query, timeout: int | None) -> None:
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"the stream did not finish within {timeout} seconds")
    finally:
        query.stop()
