"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeops.plans.tables import remove_tree
from lakeops.session import work_dir

BATCH_ROWS = 256


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet below the shared checkpoint folder and returns
    the table read back: cuts lineage, survives lost executors, and gives the
    planner the true size of the table."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes a table of ``stored`` that nothing will read again."""
    files = table.inputFiles()
    if files:
        remove_tree(table.sparkSession, files[0].rsplit("/", 1)[0])


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keeps Arrow batches of whole texts small (a Python worker holds one)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def map_batches(df: DataFrame, make: Callable, schema: StructType) -> DataFrame:
    """``mapInArrow`` with ``make()`` called once a task; it returns a function
    from a record batch to the list of output columns."""
    bounded_batches(df.sparkSession)
    out = to_arrow_schema(schema)

    def run(batches):
        step = make()
        for batch in batches:
            cols = step(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, out)],
                schema=out)

    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, make: Callable, schema: StructType, rows: int) -> DataFrame:
    """As ``map_batches``, ``rows`` rows at a time; the batches that hold them keep
    the session's bounds (``spark.sql.execution.arrow.maxBytesPerBatch``)."""
    out = to_arrow_schema(schema)

    def run(batches):
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                cols = step(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return df.mapInArrow(run, schema)


def side(table: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A stored, narrow table as a join side: broadcast when its counted rows
    are at most ``max_rows``, else left to a shuffle join (same result)."""
    return F.broadcast(table) if table.count() <= max_rows else table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
