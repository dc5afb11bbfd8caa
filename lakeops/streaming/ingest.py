"""Streaming tables: incremental, exactly-once file ingest with checkpoints.

A streaming table is a Parquet directory fed by a Structured Streaming query
with its own checkpoint.  ``refresh()`` runs ``trigger(availableNow=True)``:
every file not yet seen is processed (in several micro-batches when
``max_files_per_trigger`` is set), then the query stops.  The file sink's
commit log makes retries and restarts exactly-once.  Schemas are inferred
once from the existing files by a batch read, then fixed for the stream.
With a ``store`` and a ``name`` the table is a catalog entry over the sink's log:
batch reads by name see committed files only, ``describe`` shows its comment, every
refresh is a row of ``history``, and ``drop`` removes entry, data and checkpoint.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.plans.tables import remove_tree
from lakeops.sources.files import detect_format
from lakeops.streaming.listener import metrics_listener, run_batches


def infer_schema(spark: SparkSession, path: str, fmt: str, header: bool = True) -> StructType:
    """Batch schema inference (streaming inference is off by default).

    CSV columns stay text, as in a raw (bronze) layer."""
    if fmt == "csv":
        cols = spark.read.option("header", str(header).lower()).csv(path).columns
        return StructType([StructField(c, StringType()) for c in cols])
    return spark.read.format(fmt).load(path).schema


class StreamingTable:
    """``CREATE OR REFRESH STREAMING TABLE t AS SELECT ... FROM STREAM source``."""

    def __init__(self, spark: SparkSession, source: str, target: str, fmt: str | None = None,
                 schema: StructType | None = None, options: dict | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 max_files_per_trigger: int | None = None, partition_by: list[str] | None = None,
                 store=None, name: str | None = None, comment: str | None = None,
                 max_bytes_per_trigger: str | None = None):
        self.spark = spark
        self.source = source
        self.target = target.rstrip("/")
        self.fmt = fmt or detect_format(source)
        self.options = dict(options or {})
        if self.fmt == "csv":
            self.options.setdefault("header", "true")
        self.schema = schema or infer_schema(spark, source, self.fmt,
                                             self.options.get("header", "true") == "true")
        self.transform = transform
        self.max_files = max_files_per_trigger
        self.partition_by = partition_by
        self.store = store
        self.name = name
        self.comment = comment
        self.max_bytes = max_bytes_per_trigger
        self.progress: list[dict] = []

    @property
    def checkpoint(self) -> str:
        return f"{self.target}/_checkpoint"

    @property
    def data_path(self) -> str:
        return f"{self.target}/data"

    def stream(self) -> DataFrame:
        r = self.spark.readStream.format(self.fmt).schema(self.schema)
        for k, v in self.options.items():
            r = r.option(k, v)
        if self.max_files:
            r = r.option("maxFilesPerTrigger", str(self.max_files))
        if self.max_bytes:
            r = r.option("maxBytesPerTrigger", self.max_bytes)
        df = r.load(self.source)
        return self.transform(df) if self.transform else df

    def refresh(self, timeout_seconds: int | None = None) -> int:
        """Processes all new input; returns the number of rows ingested."""
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        listener = metrics_listener(self.spark)
        name = f"st_{uuid.uuid4().hex[:12]}"
        w = (self.stream().writeStream.format("parquet").option("path", self.data_path)
             .option("checkpointLocation", self.checkpoint).queryName(name)
             .trigger(availableNow=True))
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        q = w.start()
        if timeout_seconds is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_seconds):
            q.stop()
            raise TimeoutError(f"refresh not finished after {timeout_seconds} s; a later one resumes it")
        if q.exception():
            raise q.exception()
        seen = run_batches(self.spark, q, listener)
        self.progress.extend(seen)
        rows = sum(int(b["rows"]) for b in seen)
        if self.store is not None and self.name:
            ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            self.store.register(self.name, self.data_path, self._output_schema(), self.comment, self.partition_by)
            self.store.log_refresh(self.name, "STREAMING UPDATE", self.data_path, rows, started, ended)
        return rows

    def read(self) -> DataFrame:
        """Batch read of the table (only committed files, via the sink log)."""
        return self.spark.read.schema(self._output_schema()).parquet(self.data_path)

    def read_stream(self) -> DataFrame:
        """The table as a streaming source for downstream streaming tables."""
        return self.spark.readStream.schema(self._output_schema()).parquet(self.data_path)

    def drop(self) -> None:
        """``DROP TABLE``: the catalog entry, the data and the checkpoint (history stays)."""
        if self.store is not None and self.name:
            self.store.drop(self.name)
        remove_tree(self.spark, self.target)

    def _output_schema(self) -> StructType:
        return self.spark.read.parquet(self.data_path).schema


def land_files(df: DataFrame, path: str, fmt: str = "csv", n_files: int | None = None,
               header: bool = True) -> str:
    """Writes a DataFrame as raw files (e.g. to feed a streaming ingest)."""
    out = df.repartition(n_files) if n_files else df
    w = out.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    w.save(path)
    return path


def watermark_ts(df: DataFrame, col: str = "ts") -> DataFrame:
    """Event-time column usable by watermarks: a TIMESTAMP_NTZ wall clock is
    read as a UTC instant (independent of the session time zone)."""
    from lakeops.functions.timefeat import as_instant
    return df.withColumn(col, as_instant(df, col))
