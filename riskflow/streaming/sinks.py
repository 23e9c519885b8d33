"""Sinks that a replayed micro-batch cannot duplicate, and waiting for queries."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskflow.sources.tables import CODEC, write_table


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def start_table_sink(
    df: DataFrame, path: str, checkpoint: str, name: str,
    partition_by: Sequence[str] = ("event_date",), fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Append row-wise results with the file sink; its commit log makes a replayed batch a no-op.

    By default the query takes all input there is and ends; ``interval`` keeps it running.
    """
    writer = df.writeStream.outputMode("append").format(fmt).queryName(name)
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start(path)
    )


def start_batch_sink(
    df: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str, name: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Run ``write_batch`` on each micro-batch. An error in it fails the query, so that the batch
    is tried again on restart."""
    return (
        df.writeStream.outputMode("append").queryName(name)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def overwrite_batch_json(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the batch to a folder of its own; a replay replaces what it wrote before.

    While a replayed batch is written its folder is not whole: read such folders (reports, daily
    tables, the clear-text copy) when no run is writing them.
    """
    df.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def overwrite_batch_table(df: DataFrame, path: str, batch_id: int) -> None:
    write_table(df, f"{path}/batch_id={batch_id}", mode="overwrite")


def write_state(spark: SparkSession, path: str, **values: str | int) -> None:
    """Replace a small record of what a run has done: one JSON object of texts."""
    row = {name: str(value) for name, value in values.items()}
    spark.createDataFrame([row], ", ".join(f"{n} string" for n in row)).coalesce(1) \
        .write.mode("overwrite").json(path)


def read_state(spark: SparkSession, path: str, *names: str) -> dict[str, str]:
    """The record, empty if there is none."""
    try:
        rows = spark.read.schema(", ".join(f"{n} string" for n in names)).json(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return rows[0].asDict() if rows else {}


class Observed(StreamingQueryListener):
    """Batch id and the values of observed metrics for each batch of a query that is over.

    The first metric has to be there, others may be. Batches come as they end, however many the
    session remembers. Add it before the query starts.
    """

    def __init__(self, *metrics: str) -> None:
        self._metrics = metrics
        self._came: deque[tuple[str, dict]] = deque()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = [progress.observedMetrics.get(metric) for metric in self._metrics]
        if found[0]:
            row = {name: value for values in found if values for name, value in values.asDict().items()}
            self._came.append((str(progress.runId), {"batch_id": progress.batchId, **row}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def take(self, query: StreamingQuery) -> Iterator[dict]:
        """What has come of this query since the last call."""
        while self._came:
            run, row = self._came.popleft()
            if run == str(query.runId):
                yield row

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until a query that has ended has told of all its batches."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)
        return str(query.runId) in self._ended


def await_all(
    queries: Sequence[StreamingQuery], timeout: float | None = None,
    meanwhile: Callable[[], None] | None = None,
) -> None:
    """Wait until all queries end. On an error or at the time limit, stop all and raise.

    ``meanwhile`` is called about each second.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        for query in queries:
            while meanwhile and not query.awaitTermination(1):
                meanwhile()
                if deadline is not None and time.monotonic() >= deadline:
                    raise TimeoutError(f"stream {query.name} did not end within {timeout} s")
            if deadline is None:
                query.awaitTermination()
            elif not query.awaitTermination(max(1, int(deadline - time.monotonic()))):
                raise TimeoutError(f"stream {query.name} did not end within {timeout} s")
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
