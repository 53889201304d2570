"""Named datasets built from each other: tables fed by streams, views, sinks, quality rules.

A dataset is a function that returns a DataFrame and reads others by name.
Reading a name that was not refreshed in this run refreshes it first, so the
order of definition does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import Rule, enforce
from millrace.session import path_exists
from millrace.sinks.tables import KeyedTable
from millrace.sources.files import stream_table
from millrace.streaming.runs import Running, drain_batches, observed, run_recorded, settings

STREAMED, STORED, VIEW, CHANGES, SINK = "streaming table", "materialized view", "view", "change table", "sink"


@dataclass
class Dataset:
    name: str
    kind: str
    build: Callable[[], DataFrame] | None = None
    rules: Sequence[Rule] = ()
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    flows: list[tuple] = field(default_factory=list)
    change: dict = field(default_factory=dict)
    interval: str | None = None


class Datasets:
    """The datasets of one project, stored below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.defined: dict[str, Dataset] = {}
        self.done: set[str] = set()
        self.open: list[str] = []
        self.metrics: list[tuple] = []
        self.running: dict[str, tuple[Dataset, Running]] = {}

    # ---- definition -------------------------------------------------------
    def _add(self, kind: str, name: str | None, **options):
        def register(build: Callable[[], DataFrame]):
            label = name or build.__name__
            if label in self.defined:
                raise ValueError(f"dataset {label!r} is defined twice")
            self.defined[label] = Dataset(label, kind, build, **options)
            return build

        return register

    def table(self, name: str | None = None, **options):
        """Append-only table fed by a streaming DataFrame; each run takes only new input."""
        return self._add(STREAMED, name, **options)

    def materialized_view(self, name: str | None = None, **options):
        """Stored result of a batch query, computed anew in each run."""
        return self._add(STORED, name, **options)

    def view(self, name: str | None = None, **options):
        """A named step that is never stored."""
        return self._add(VIEW, name, **options)

    def streaming_table(self, name: str, **options) -> None:
        """A table without a query of its own, filled by append flows."""
        self.defined[name] = Dataset(name, STREAMED, None, **options)

    def sink(self, name: str, fmt: str, options: Mapping[str, str] | None = None, mode: str = "append", interval: str | None = None) -> None:
        """An external target, e.g. console or broker."""
        self.defined[name] = Dataset(name, SINK, change={"fmt": fmt, "options": dict(options or {}), "mode": mode}, interval=interval)

    def flow(self, target: str, name: str | None = None, conf: Mapping[str, str] | None = None):
        """A streaming query that writes into an existing table or sink."""
        def register(build: Callable[[], DataFrame]):
            self.defined[target].flows.append((name or build.__name__, build, dict(conf or {})))
            return build

        return register

    def apply_changes(
        self, target: str, source: str, keys: Sequence[str], sequence_by: Sequence[str], delete_when=None,
        except_columns: Sequence[str] = (), buckets: int = 64,
    ) -> None:
        """Keep ``target`` as the SCD type 1 state of the change rows in ``source``."""
        self.defined[target] = Dataset(target, CHANGES, change={
            "source": source, "keys": list(keys), "sequence_by": list(sequence_by), "delete_when": delete_when,
            "except_columns": list(except_columns), "buckets": buckets,
        })

    # ---- reading ----------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _checkpoint(self, flow: str) -> str:
        return f"{self.root}/_checkpoints/{flow}"

    def _flows(self, item: Dataset) -> list[tuple]:
        own = [(item.name, item.build, {})] if item.build else []
        return [*own, *item.flows]

    def _flow_paths(self, item: Dataset) -> list[str]:
        """One folder per flow: a file sink knows a batch by its number, and each flow counts for itself."""
        return [f"{self.path(item.name)}/{flow}" for flow, _, _ in self._flows(item)]

    def _keyed(self, item: Dataset) -> KeyedTable:
        return KeyedTable(self.spark, self.path(item.name), item.change["keys"], item.change["buckets"])

    def read(self, name: str) -> DataFrame:
        """The current rows of a dataset."""
        item = self._refreshed(name)
        if item.kind == VIEW:
            return enforce(item.build(), item.rules)
        if item.kind == CHANGES:
            return self._keyed(item).read()
        paths = self._flow_paths(item) if item.kind == STREAMED else [self.path(name)]
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(p) for p in paths])

    def read_stream(self, name: str) -> DataFrame:
        """Rows that are new since the last run of the reader; a view passes its own stream on."""
        item = self._refreshed(name)
        if item.kind == VIEW:
            return enforce(item.build(), item.rules)
        if item.kind != STREAMED:
            raise ValueError(f"{name!r} is no append-only table and cannot be streamed")
        return reduce(DataFrame.unionByName, [stream_table(self.spark, p) for p in self._flow_paths(item)])

    # ---- refreshing -------------------------------------------------------
    def refresh(self, *names: str) -> None:
        """Refresh the named datasets (all by default) and whatever they read, each once."""
        self.done, self.open, self.metrics = set(), [], []
        for name in names or list(self.defined):
            self._refreshed(name)
        self._store_metrics()

    def _store_metrics(self) -> None:
        if self.metrics:
            schema = "dataset string, rule string, action string, passed bigint, failed bigint"
            rows = self.spark.createDataFrame(self.metrics, schema).withColumn("refreshed_at", F.current_timestamp())
            rows.coalesce(1).write.mode("append").parquet(f"{self.root}/_metrics")
            self.metrics = []

    def _refreshed(self, name: str) -> Dataset:
        if name not in self.defined:
            raise KeyError(f"unknown dataset {name!r}")
        item = self.defined[name]
        if name in self.open:
            raise ValueError(f"{' -> '.join([*self.open, name])} is a circle")
        if name not in self.done:
            self.open.append(name)
            try:
                self._run(item)
            finally:
                self.open.pop()
            self.done.add(name)
        return item

    def _run(self, item: Dataset) -> None:
        if item.kind == STORED:
            observation = Observation(item.name) if item.rules else None
            enforce(item.build(), item.rules, observation).write.mode("overwrite").parquet(self.path(item.name))
            if observation:
                self._note(item, observation.get)
        elif item.kind == CHANGES:
            table, change = self._keyed(item), item.change
            drain_batches(
                self.read_stream(change["source"]),
                lambda batch, _: table.merge(batch, change["sequence_by"], change["delete_when"], change["except_columns"]),
                self._checkpoint(item.name), "append",
            )
        elif item.kind in (STREAMED, SINK):
            for flow, build, conf in self._flows(item):
                self._run_flow(item, flow, build, conf)

    def _run_flow(self, item: Dataset, flow: str, build: Callable[[], DataFrame], conf: Mapping[str, str]) -> None:
        stream = enforce(build(), item.rules, flow if item.rules else None)
        if item.kind == SINK:
            writer = stream.writeStream.format(item.change["fmt"]).options(**item.change["options"]).outputMode(item.change["mode"])
        else:
            writer = stream.writeStream.format("parquet").option("path", f"{self.path(item.name)}/{flow}").outputMode("append")
        checkpoint = self._checkpoint(f"{item.name}-{flow}")
        with settings(self.spark, conf):
            if item.interval:
                # Takes what is there, so that readers find it, and goes on by itself; ``stop`` ends it and notes its metrics.
                if flow not in self.running:
                    self.running[flow] = item, Running(writer, checkpoint, item.interval)
                self.running[flow][1].query.processAllAvailable()
                return
            query = run_recorded(writer.trigger(availableNow=True), checkpoint)
        if item.rules:
            self._note(item, observed(query, flow))

    def stop(self) -> None:
        """Ends the flows that run at an interval; an error of one of them is raised."""
        errors = []
        for flow, (item, run) in list(self.running.items()):
            run.stop()
            del self.running[flow]
            if run.error is not None:
                errors.append(f"{flow}: {run.error}")
            elif item.rules:
                self._note(item, run.metrics(flow))
        self._store_metrics()
        if errors:
            raise RuntimeError("; ".join(errors))

    def _note(self, item: Dataset, counts: Mapping[str, int]) -> None:
        for r in item.rules:
            failed = counts.get(f"failed: {r.name}", 0)
            self.metrics.append((item.name, r.name, r.action, counts.get("rows", 0) - failed, failed))

    def rule_metrics(self) -> DataFrame:
        """Passed and failed rows per dataset, rule and run."""
        if not path_exists(self.spark, f"{self.root}/_metrics"):
            raise ValueError("no run with rules yet")
        return self.spark.read.parquet(f"{self.root}/_metrics")
