"""Materialized views refreshed incrementally from a streaming source.

``SELECT keys, sum(x) ... GROUP BY ALL`` over an append-only table is kept up
to date without rebuilding: every micro-batch of new input is reduced to
*partial* aggregates per key (sum, count, min, max) and written to
``partials/batch_id=N`` with overwrite, so a retried batch replaces itself.
Reading the view merges the partials (one more aggregation over data that is
already reduced per batch).  ``avg`` is sum/count.  Aggregates that are not
mergeable (distinct counts, medians) need a full recompute and are refused.
``compact()`` merges the partials up to batch N into ``compacted/through=N``.
The directory counts once Spark has put its success marker there; readers,
whichever object they use, take the newest such one and only the partials of
later batches, so a batch replayed after a compaction isn't counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.plans.tables import remove_tree

MERGEABLE = ("sum", "count", "min", "max", "avg")


class IncrementalAggregateView:
    """``CREATE MATERIALIZED VIEW v AS SELECT keys, aggs FROM source GROUP BY ALL``."""

    def __init__(self, spark: SparkSession, source_path: str, schema: StructType, keys: list[str],
                 measures: dict[str, tuple[str, str]], root: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None):
        for name, (fn, _) in measures.items():
            if fn not in MERGEABLE:
                raise ValueError(f"{name}: {fn} is not incrementally maintainable")
        self.spark = spark
        self.source_path = source_path
        self.schema = schema
        self.keys = keys
        self.measures = measures
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.max_files = max_files_per_trigger
        self.partials = f"{self.root}/partials"

    @classmethod
    def over(cls, table, keys: list[str], measures: dict[str, tuple[str, str]], root: str) -> "IncrementalAggregateView":
        """The view over a ``StreamingTable``: its committed files are the input."""
        return cls(table.spark, table.data_path, table.read().schema, keys, measures, root)

    def drop(self) -> None:
        """``DROP MATERIALIZED VIEW``: partial aggregates and checkpoint."""
        remove_tree(self.spark, self.root)

    def _partial_columns(self):
        cols = []
        for name, (fn, col) in self.measures.items():
            c = F.col(col)
            if fn in ("sum", "avg"):
                cols.append(F.sum(c).alias(f"{name}__sum"))
            if fn in ("count", "avg"):
                cols.append(F.count(c).alias(f"{name}__count"))
            if fn == "min":
                cols.append(F.min(c).alias(f"{name}__min"))
            if fn == "max":
                cols.append(F.max(c).alias(f"{name}__max"))
        return cols

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(*self.keys).agg(*self._partial_columns())
        part.write.mode("overwrite").parquet(f"{self.partials}/batch_id={batch_id}")

    def refresh(self, timeout_seconds: int | None = None) -> None:
        r = self.spark.readStream.format(self.fmt).schema(self.schema)
        if self.max_files:
            r = r.option("maxFilesPerTrigger", str(self.max_files))
        q = (r.load(self.source_path).writeStream.foreachBatch(self._write_batch)
             .option("checkpointLocation", f"{self.root}/_checkpoint")
             .trigger(availableNow=True).start())
        if timeout_seconds is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_seconds):
            q.stop()
            raise TimeoutError(f"refresh not finished after {timeout_seconds} s; a later one resumes it")
        if q.exception():
            raise q.exception()

    def compacted_through(self) -> int | None:
        """The last batch that a finished compaction covers."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/compacted/through=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return max((int(s.getPath().getParent().getName().split("=")[1]) for s in found or []), default=None)

    def _merged_so_far(self) -> DataFrame:
        """(batch_id, keys, partial aggregates): the compacted batches as one."""
        p = self.spark.read.parquet(self.partials)
        through = self.compacted_through()
        if through is None:
            return p
        old = self.spark.read.parquet(f"{self.root}/compacted/through={through}")
        return p.filter(F.col("batch_id") > through).unionByName(old.withColumn("batch_id", F.lit(through)))

    def read(self) -> DataFrame:
        p = self._merged_so_far()
        merged = []
        for name, (fn, _) in self.measures.items():
            if fn == "sum":
                merged.append(F.sum(f"{name}__sum").alias(name))
            elif fn == "count":
                merged.append(F.sum(f"{name}__count").cast("long").alias(name))
            elif fn == "min":
                merged.append(F.min(f"{name}__min").alias(name))
            elif fn == "max":
                merged.append(F.max(f"{name}__max").alias(name))
            elif fn == "avg":
                merged.append(F.try_divide(F.sum(f"{name}__sum"), F.sum(f"{name}__count")).alias(name))
        return p.groupBy(*self.keys).agg(*merged)

    def compact(self) -> str:
        """Merges the partials of all batches so far into one directory; returns it."""
        through = self.spark.read.parquet(self.partials).agg(F.max("batch_id")).first()[0]
        path = f"{self.root}/compacted/through={through}"
        if through == self.compacted_through():
            return path
        p = self._merged_so_far().filter(F.col("batch_id") <= through)
        merged = []
        for c in p.columns:
            if c in self.keys or c == "batch_id":
                continue
            if c.endswith("__min"):
                merged.append(F.min(c).alias(c))
            elif c.endswith("__max"):
                merged.append(F.max(c).alias(c))
            else:
                merged.append(F.sum(c).alias(c))
        p.groupBy(*self.keys).agg(*merged).write.mode("overwrite").parquet(path)
        return path
