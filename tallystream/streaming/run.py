"""Starting, draining and stopping streaming queries, and their sinks."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

# How often the file sink flushes and when an idle job ends.
FLUSH_ROWS = 100
FLUSH_SECONDS = 3
IDLE_SECONDS = 30


def flush_trigger(writer: DataStreamWriter, seconds: int = FLUSH_SECONDS) -> DataStreamWriter:
    """A micro-batch every ``seconds``."""
    return writer.trigger(processingTime=f"{seconds} seconds")


def flush_options(fmt: str, rows: int = FLUSH_ROWS) -> dict[str, str]:
    """Source options that bound one micro-batch: rows for a broker, files for a folder."""
    return {"maxOffsetsPerTrigger": str(rows)} if fmt == "kafka" else {"maxFilesPerTrigger": str(max(1, rows // FLUSH_ROWS))}


def write_json(df: DataFrame, path: str, checkpoint: str, seconds: int = FLUSH_SECONDS) -> StreamingQuery:
    """Append results as JSON lines; a failed write is retried with its task."""
    writer = df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return flush_trigger(writer, seconds).start()


def to_console(df: DataFrame, mode: str = "append") -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    return df.writeStream.format("console").outputMode(mode).start()


def to_table(df: DataFrame, name: str, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append to the table ``name``, whose files the tasks write below ``path``."""
    return df.writeStream.option("path", path).option("checkpointLocation", checkpoint).toTable(name, format=fmt)


def run_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write to files from the earliest input on; the checkpoint remembers what is done.

    With ``available_now`` the call returns when all present input has been processed.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not available_now:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_batch_once(df: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of one micro-batch under its number. A replay overwrites the same
    folder, so the output is the same however often the batch runs."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_tables_once(tables: Mapping[str, DataFrame], batch_id: int, path: str) -> None:
    """Write what one micro-batch adds to several tables, as one write with a partition for each.

    Its files appear when the write is committed: a failure before that leaves none of the
    tables behind, and a replay overwrites all of them.
    """
    whole = None
    for name, rows in tables.items():
        rows = rows.withColumn("table", F.lit(name))
        whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
    whole.write.mode("overwrite").partitionBy("table").parquet(f"{path}/batch={batch_id}")


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of ``write_tables_once``, over all micro-batches."""
    return spark.read.parquet(path).filter(F.col("table") == name).drop("table", "batch")


def resume(start: Callable[[], StreamingQuery], attempts: int = 3) -> StreamingQuery:
    """Run a query to its end; one that fails is started again and goes on from its checkpoint."""
    for left in range(attempts - 1, -1, -1):
        try:
            return start()
        except StreamingQueryException:
            if not left:
                raise
    raise ValueError("attempts must be at least 1")


def run_batches(
    df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stop_when_idle(query: StreamingQuery, seconds: float = IDLE_SECONDS, poll: float = 0.5) -> None:
    """Stop a running query once it has had no input for ``seconds``."""
    last_input, seen = time.monotonic(), -1
    while query.isActive:
        progress = query.lastProgress
        if progress is not None and progress["batchId"] != seen:
            seen = progress["batchId"]
            if progress["numInputRows"] > 0:
                last_input = time.monotonic()
        if time.monotonic() - last_input >= seconds and not query.status["isTriggerActive"]:
            query.stop()
            return
        time.sleep(poll)


class LateRows(StreamingQueryListener):
    """Counts the rows of each query that were dropped because they were older than its watermark.

    Add it with ``spark.streams.addListener`` before the query starts: it hears of every
    micro-batch, however many there are.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = defaultdict(int)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        now = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self._dropped[str(event.progress.runId)] += now

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait: float = 60) -> int:
        """Rows dropped by a run that has ended; reports come in order, its end last."""
        run = str(query.runId)
        if not self._ended[run].wait(wait):
            raise TimeoutError("the query has not reported its end")
        return self._dropped[run]
