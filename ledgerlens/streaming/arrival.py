"""Process files as they arrive in a landing folder.

Replaces a sleep-and-poll loop: a file source stream with a checkpoint
processes every new file exactly once. Each micro-batch is written to its own
``batch=<id>`` folder with overwrite, so a batch that is re-run after a
failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def on_arrival(spark: SparkSession, source_dir: str, schema: StructType,
               process: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
               fmt: str = "parquet", glob: str | None = None,
               max_files_per_trigger: int | None = None, once: bool = True):
    """Start the stream; with ``once`` process what has landed and stop
    (``availableNow``), else keep running and return the query handle."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if once:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()


def wait_for_arrival(spark: SparkSession, source_dir: str, schema: StructType,
                     process: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, budget_seconds: float,
                     fmt: str = "parquet", glob: str | None = None, poll: str = "1 second") -> bool:
    """Wait for a report and process it, or publish an empty result.

    The stream looks for new files every ``poll``. The first batch with rows
    ends the wait; when ``budget_seconds`` pass without one, ``process`` of no
    rows is written, so readers find the result's columns. Returns whether
    something came. The checkpoint remembers what was processed: a report that
    comes too late is taken by the next call. A batch repeated replaces its own
    output."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    arrived = threading.Event()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        process(batch).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        arrived.set()

    query = (reader.load(source_dir).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(processingTime=poll).start())
    deadline = time.monotonic() + budget_seconds
    try:
        # A failed stream ends the wait at once instead of using up the budget.
        while not arrived.wait(min(1.0, max(0.0, deadline - time.monotonic()))) and time.monotonic() < deadline:
            if query.exception():
                raise query.exception()
    finally:
        _stop_between_batches(query)
    if not arrived.is_set():
        process(spark.createDataFrame([], schema)).write.mode("overwrite").parquet(f"{sink}/batch=blank")
    return arrived.is_set()


def _stop_between_batches(query) -> None:
    """Stop when the running batch, if any, has finished: a batch that is cut
    off would be written again by the next run."""
    for _ in range(600):
        if not query.isActive or not query.status["isTriggerActive"]:
            break
        time.sleep(0.1)
    query.stop()
