"""Running streams: drain what is there, stop after some batches, read the progress."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.session import path_exists, write_text

#: Seconds to wait for the last updates of a query that has ended.
HEARD = 60.0

class Updates(StreamingQueryListener):
    """Every progress update of the queries it hears of, appended to a folder of JSON lines as they come.

    Spark keeps the last hundred updates of a query; here none is lost, and the driver holds at most ``held`` of them.
    A file is written when so many have come and when a query ends.
    """

    def __init__(self, spark: SparkSession, path: str, held: int = 50):
        self.spark, self.path, self.held = spark, path.rstrip("/"), held
        self.lines: list[str] = []
        self.count = 0
        self.with_input: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.changed:
            self.lines.append(event.progress.json)
            self.count += 1
            if event.progress.numInputRows > 0:
                run = str(event.progress.runId)
                self.with_input[run] = self.with_input.get(run, 0) + 1
            if len(self.lines) >= self.held:
                self._write()
            self.changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self._write()
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self) -> None:
        if self.lines:
            # A name that no other run uses, so that nothing is overwritten.
            write_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", "\n".join(" ".join(line.split("\n")) for line in self.lines) + "\n")
            self.lines = []

    def flush(self) -> None:
        with self.changed:
            self._write()

    def until(self, reached: Callable[[], bool], timeout: float | None = None) -> bool:
        """Wait until something is true after some update; whether it became so in time."""
        with self.changed:
            return self.changed.wait_for(reached, timeout)

    def table(self, run_id: str | None = None) -> DataFrame:
        """(run_id, batch_id, value): one row per update, the JSON text of each; of one run or of all."""
        self.flush()
        if not path_exists(self.spark, self.path):
            lines = self.spark.createDataFrame([], "value string")
        else:
            lines = self.spark.read.text(self.path)
        out = lines.select(F.get_json_object("value", "$.runId").alias("run_id"), F.get_json_object("value", "$.batchId").cast("bigint").alias("batch_id"), "value")
        return out if run_id is None else out.filter(F.col("run_id") == run_id)


@contextmanager
def recorded(spark: SparkSession, path: str):
    """Updates of all queries that run inside, appended to ``path``."""
    log = Updates(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """Settings of one flow, e.g. shuffle partitions; the old values come back after the start."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def trigger_of(interval: str | None) -> dict:
    """Drain once by default; with an interval such as ``6 hours`` run a batch at each."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def wait(query: StreamingQuery, timeout: float | None = None, log: Updates | None = None) -> StreamingQuery:
    """Wait for the end of a query, without a limit unless one is given, and for all its updates if they are recorded.

    A query that does not end in time is stopped and reported; one that fails raises its error.
    """
    try:
        ended = query.awaitTermination() if timeout is None else query.awaitTermination(timeout)
    finally:
        # Updates are heard of in order, so the end of a run comes after its last update.
        if log is not None and not query.isActive and not log.until(lambda: str(query.runId) in log.ended, HEARD):
            raise TimeoutError(f"the end of the run was not heard of within {HEARD} s")
    if ended is False:
        query.stop()
        raise TimeoutError(f"stream did not end within {timeout} s")
    if log is not None:
        query.log = log
    return query


class Running:
    """A query that goes on until it is stopped: its updates, metrics and error stay at hand.

        with Running(writer, checkpoint, "10 seconds") as run:
            run.after(2)
        run.updates(), run.error
    """

    def __init__(self, writer, checkpoint: str, interval: str):
        self.checkpoint, self.spark, self.error = checkpoint, writer._spark, None
        self.log = Updates(self.spark, f"{checkpoint.rstrip('/')}/updates")
        self.spark.streams.addListener(self.log)
        try:
            self.query = writer.option("checkpointLocation", checkpoint).trigger(**trigger_of(interval)).start()
        except Exception:
            self.spark.streams.removeListener(self.log)
            raise
        self.query.log = self.log

    def after(self, batches: int, timeout: float | None = None) -> bool:
        """Wait for so many batches with input; false when the time is over or the query has ended before."""
        run = str(self.query.runId)
        self.log.until(lambda: self.log.with_input.get(run, 0) >= batches or run in self.log.ended, timeout)
        return self.log.with_input.get(run, 0) >= batches

    def updates(self) -> DataFrame:
        return updates_of(self.query)

    def metrics(self, name: str) -> dict[str, int]:
        return observed(self.query, name)

    def stop(self) -> None:
        """Stop, hear the last updates, and keep the error of a query that has failed."""
        self.query.stop()
        run = str(self.query.runId)
        heard = self.log.until(lambda: run in self.log.ended, HEARD)
        failed = self.query.exception()
        self.error = None if failed is None else str(failed)
        self.spark.streams.removeListener(self.log)
        self.log.flush()
        if not heard:
            raise TimeoutError(f"the end of the run was not heard of within {HEARD} s")

    def __enter__(self) -> Running:
        return self

    def __exit__(self, *_) -> None:
        self.stop()


def updates_of(query: StreamingQuery) -> DataFrame:
    """(run_id, batch_id, value): the updates of a run that was recorded."""
    return query.log.table(str(query.runId))


def run_recorded(writer, checkpoint: str, timeout: float | None = None) -> StreamingQuery:
    """Start a writer, wait for its end, and record its updates beside the checkpoint."""
    with recorded(writer._spark, f"{checkpoint.rstrip('/')}/updates") as log:
        return wait(writer.option("checkpointLocation", checkpoint).start(), timeout, log)


def until_idle(query: StreamingQuery) -> None:
    """Let a query take all input present now, then stop it, whatever its trigger."""
    query.processAllAvailable()
    query.stop()


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str, timeout: float | None = None) -> StreamingQuery:
    """Process all available input into a parquet table, each input once."""
    writer = stream.writeStream.format("parquet").option("path", path)
    return run_recorded(writer.outputMode("append").trigger(availableNow=True), checkpoint, timeout)


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update",
    timeout: float | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to a function, which must give the same result when a batch is repeated."""
    return run_recorded(stream.writeStream.foreachBatch(handle).outputMode(mode).trigger(availableNow=True), checkpoint, timeout)


def to_console(stream: DataFrame, checkpoint: str, mode: str = "update", interval: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("console").option("checkpointLocation", checkpoint).outputMode(mode)
    return writer.trigger(**trigger_of(interval)).start()


def to_memory(stream: DataFrame, table: str, mode: str = "update") -> StreamingQuery:
    """Small results for a notebook: the rows are kept on the driver under the query name."""
    return stream.writeStream.format("memory").queryName(table).outputMode(mode).trigger(availableNow=True).start()


def to_broker(stream: DataFrame, options: Mapping[str, str], checkpoint: str, mode: str = "append", interval: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.outputMode(mode).trigger(**trigger_of(interval)).start()


def stop_after_batches(query: StreamingQuery, batches: int, log: Updates, timeout: float = 3600) -> DataFrame:
    """Stop a running query after that many batches with input; the first updates with input, as many as asked for."""
    run = str(query.runId)
    log.until(lambda: log.with_input.get(run, 0) >= batches or run in log.ended, timeout)
    query.stop()
    log.until(lambda: run in log.ended, HEARD)
    with_input = log.table(run).filter(F.get_json_object("value", "$.numInputRows").cast("bigint") > 0)
    return with_input.orderBy("batch_id").limit(batches)


def observed(query: StreamingQuery, name: str) -> dict[str, int]:
    """Counts of one observation, added over all batches of the run; as many rows as it has counts come to the driver."""
    metrics = F.from_json("value", "struct<observedMetrics: map<string, map<string, string>>>")["observedMetrics"]
    cells = updates_of(query).select(F.explode(F.element_at(metrics, name)))
    return {r.key: r.n for r in cells.groupBy("key").agg(F.sum(F.col("value").cast("bigint")).alias("n")).collect()}


PERCENTILES = ("P0", "P50", "P90", "P95", "P99")
_LATENCY = "struct<" + ", ".join(f"{p}: bigint" for p in PERCENTILES) + ">"
PROGRESS_SCHEMA = (
    "batchId bigint, numInputRows bigint, durationMs struct<triggerExecution: bigint, addBatch: bigint, walCommit: bigint>, "
    f"latencies struct<processingLatencyMs: {_LATENCY}, sourceQueuingLatencyMs: {_LATENCY}, e2eLatencyMs: {_LATENCY}>, "
    "stateOperators array<struct<operatorName: string, numRowsTotal: bigint, numRowsUpdated: bigint, "
    "numRowsRemoved: bigint, commitTimeMs: bigint, memoryUsedBytes: bigint>>"
)


def parse_progress(progress: DataFrame, column: str = "value") -> DataFrame:
    """Progress JSON to batch number, latency percentiles and state figures; missing parts are null."""
    parsed = progress.select(F.from_json(column, PROGRESS_SCHEMA).alias("p")).select("p.*")
    cells = [
        F.col(f"latencies.{field}.{p}").alias(f"{name}_{p.lower()}")
        for name, field in (("processing", "processingLatencyMs"), ("queueing", "sourceQueuingLatencyMs"), ("end_to_end", "e2eLatencyMs"))
        for p in PERCENTILES
    ]
    times = [F.col(f"durationMs.{c}").alias(name) for c, name in (("triggerExecution", "trigger_ms"), ("addBatch", "work_ms"), ("walCommit", "log_ms"))]
    return parsed.select("batchId", "numInputRows", *times, *cells, "stateOperators")


def state_operators(progress: DataFrame) -> DataFrame:
    """One row per batch and state operator."""
    return progress.select("batchId", F.inline("stateOperators"))
