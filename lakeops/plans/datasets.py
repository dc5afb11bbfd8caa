"""A declarative graph of datasets: live tables and streaming tables.

``CREATE OR REFRESH [STREAMING | LIVE] TABLE name (CONSTRAINT ... EXPECT ...)
AS SELECT ... FROM [STREAM(]live.other[)]`` becomes::

    g = DatasetGraph(spark, store)
    g.streaming_table("bronze", lambda g: spark.readStream...)
    g.streaming_table("silver", lambda g: g.read_stream("bronze").select(...),
                      expectations=[Expectation("valid_user", "user_id IS NOT NULL")])
    g.live_table("gold", lambda g: g.read("silver").join(g.read("dim"), ...))
    g.run()

Each definition names the datasets it reads (``depends_on``); datasets run
in topological order.  Live tables are recomputed and written as
a new table version; streaming tables process only new input (availableNow,
own checkpoint, exactly-once file sink) and are catalog entries too, with their
comment and a history row for each run.  Expectation counters are collected
with ``observe`` (per micro-batch for streams, summed by a listener).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.quality import Expectation, apply_expectations, enforce, violation_counters
from lakeops.plans.tables import TableStore
from lakeops.streaming.listener import metrics_listener, run_batches


@dataclass
class _Dataset:
    name: str
    fn: Callable
    streaming: bool
    expectations: list = field(default_factory=list)
    comment: str | None = None
    deps: set = field(default_factory=set)


class DatasetGraph:
    def __init__(self, spark: SparkSession, store: TableStore):
        self.spark = spark
        self.store = store
        self.datasets: dict[str, _Dataset] = {}
        self.done: set[str] = set()
        self.metrics: dict[str, dict] = {}

    # -- definitions ---------------------------------------------------------
    def live_table(self, name: str, fn: Callable, expectations: list[Expectation] | None = None,
                   comment: str | None = None, depends_on: list[str] | None = None):
        self.datasets[name] = _Dataset(name, fn, False, list(expectations or []), comment,
                                       set(depends_on or []))
        return self

    def streaming_table(self, name: str, fn: Callable, expectations: list[Expectation] | None = None,
                        comment: str | None = None, depends_on: list[str] | None = None):
        self.datasets[name] = _Dataset(name, fn, True, list(expectations or []), comment,
                                       set(depends_on or []))
        return self

    # -- reads inside definitions ------------------------------------------
    def _path(self, name: str) -> str:
        return f"{self.store.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """``live.name``: batch read of a dataset that has run."""
        ds = self.datasets[name]
        if ds.streaming:
            return self.spark.read.parquet(f"{self._path(name)}/data")
        return self.store.read(name)

    def read_stream(self, name: str) -> DataFrame:
        """``stream(live.name)``: new rows of a streaming table as a stream."""
        path = f"{self._path(name)}/data"
        schema = self.spark.read.parquet(path).schema
        return self.spark.readStream.schema(schema).parquet(path)

    # -- execution -------------------------------------------------------------
    def order(self) -> list[str]:
        """Topological order over the declared ``depends_on`` names."""
        deps = {}
        for name, ds in self.datasets.items():
            unknown = ds.deps - set(self.datasets)
            if unknown:
                raise KeyError(f"{name} reads undefined datasets {sorted(unknown)}")
            deps[name] = ds.deps
        order, state = [], {}

        def visit(n):
            if state.get(n) == 1:
                raise ValueError(f"cycle through {n}")
            if state.get(n) == 2:
                return
            state[n] = 1
            for d in sorted(deps[n]):
                visit(d)
            state[n] = 2
            order.append(n)

        for n in self.datasets:
            visit(n)
        return order

    def run(self, only: list[str] | None = None) -> dict[str, dict]:
        for name in self.order():
            if only and name not in only:
                continue
            ds = self.datasets[name]
            if ds.streaming:
                self._run_stream(ds)
            else:
                self._run_live(ds)
            self.done.add(name)
        return self.metrics

    def _run_live(self, ds: _Dataset) -> None:
        df = ds.fn(self)
        if ds.expectations:
            df, obs = apply_expectations(df, ds.expectations, f"{ds.name}-expect")
        else:
            obs = None
        sources = sorted(ds.deps) or None
        self.store.write(df, ds.name, comment=ds.comment, sources=sources,
                         operation="LIVE TABLE REFRESH")
        self.metrics[ds.name] = dict(obs.get) if obs is not None else {}

    def _run_stream(self, ds: _Dataset) -> None:
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        listener = metrics_listener(self.spark)
        obs_name = f"{ds.name}-expect-{id(self)}"
        stream = ds.fn(self)
        if ds.expectations:
            stream = stream.observe(obs_name, *violation_counters(ds.expectations))
            stream = enforce(stream, ds.expectations)
        q = (stream.writeStream.format("parquet")
             .option("path", f"{self._path(ds.name)}/data")
             .option("checkpointLocation", f"{self._path(ds.name)}/_checkpoint")
             .queryName(f"{ds.name}_{id(self)}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        batches = run_batches(self.spark, q, listener)
        data = f"{self._path(ds.name)}/data"
        self.store.register(ds.name, data, self.spark.read.parquet(data).schema, ds.comment)
        self.store.log_refresh(ds.name, "STREAMING UPDATE", data, sum(int(b["rows"]) for b in batches), started,
                               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        if ds.deps:
            self.store.record_lineage(sorted(ds.deps), ds.name)
        if all(b["observed"] is not None for b in batches):
            totals: dict[str, int] = {}
            for b in batches:
                for k, v in b["observed"].get(obs_name, {}).items():
                    totals[k] = totals.get(k, 0) + v
            self.metrics[ds.name] = totals
            return
        self.metrics[ds.name] = listener.metrics(obs_name)


def expectation_metrics_frame(spark: SparkSession, metrics: dict[str, dict]) -> DataFrame:
    """Flattens run metrics into rows (dataset, metric, value)."""
    rows = [(ds, k, int(v)) for ds, m in metrics.items() for k, v in m.items()]
    return spark.createDataFrame(rows, "dataset string, metric string, value long") \
        .withColumn("value", F.col("value"))
