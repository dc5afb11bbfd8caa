"""Tables in the shared folder: overwrite with atomic switch, refresh ledger,
lineage records, feature tables with key metadata.

A table is a Parquet directory per version plus a catalog entry pointing at
the current version.  Overwrite writes a new version directory and then moves
the table's location, so a table can be rebuilt from itself and readers never
see a half-written directory.  Where the new version has other columns or
either one is partitioned, the catalog entry is replaced instead (a reader that
resolves the name between the two statements finds no table); properties stay.
Appended partitions are registered.  Row counts come from ``observe`` on the
write itself (no second pass over the data).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType, TimestampType)

from lakeops.plans.lineage import column_sources, table_sources
from lakeops.session import work_dir

LEDGER_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("operation", StringType()),
    StructField("version", StringType()), StructField("num_output_rows", LongType()),
    StructField("started_at", TimestampType()), StructField("ended_at", TimestampType()),
])
LINEAGE_SCHEMA = StructType([
    StructField("source_table_schema", StringType()), StructField("source_table_name", StringType()),
    StructField("entity_type", StringType()), StructField("target_table_full_name", StringType()),
    StructField("recorded_at", TimestampType()),
])
COLUMN_LINEAGE_SCHEMA = StructType([
    StructField("target_table_full_name", StringType()), StructField("target_column_name", StringType()),
    StructField("source_table_schema", StringType()), StructField("source_table_name", StringType()),
    StructField("source_column_name", StringType()), StructField("recorded_at", TimestampType()),
])


class TableStore:
    """Tables of one schema, stored below a shared root folder."""

    def __init__(self, spark: SparkSession, schema: str = "lakeops", root: str | None = None):
        self.spark = spark
        self.schema = schema
        self.root = (root or work_dir(spark, f"tables-{schema}")).rstrip("/")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{self.root}/_schema'")

    # -- naming -----------------------------------------------------------
    def full_name(self, name: str) -> str:
        return name if "." in name else f"{self.schema}.{name}"

    def _short(self, name: str) -> str:
        return name.split(".")[-1]

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    # -- writes -----------------------------------------------------------
    def write(self, df: DataFrame, name: str, mode: str = "overwrite", comment: str | None = None,
              properties: dict | None = None, sources: list[str] | None = None,
              operation: str | None = None, partition_by: list[str] | None = None,
              cluster_by: list[str] | None = None) -> str:
        """Writes ``df`` as table ``name``; returns the version directory.

        ``cluster_by`` lays rows out by range of those columns and sorts them
        within files, so Parquet min/max statistics skip files on filters.
        Lineage is read off the plan of ``df``; ``sources`` names them instead where
        the plan cannot show them (rows the driver gave, a cut lineage).
        """
        if mode not in ("overwrite", "append"):
            raise ValueError("mode must be overwrite or append")
        full = self.full_name(name)
        found = [] if sources else table_sources(df)
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        obs = Observation(f"write-{uuid.uuid4().hex[:8]}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        old_parts = self.partition_columns(name) if self.exists(name) else []
        if mode == "append" and self.exists(name):
            if partition_by and list(partition_by) != old_parts:
                raise ValueError(f"{full} is partitioned by {old_parts}, not by {list(partition_by)}")
            have, new = _columns(self.read(name).schema), _columns(df.schema)
            if have != new:
                raise ValueError(f"appended columns {new} differ from those of {full}: {have}")
            version = self.current_location(name)
            w = observed.write.mode("append")
            if old_parts:
                w = w.partitionBy(*old_parts)
            w.parquet(version)
            if old_parts:
                self.spark.sql(f"MSCK REPAIR TABLE {full}")
            self.spark.sql(f"REFRESH TABLE {full}")
        else:
            version = f"{self.root}/{self._short(name)}/v-{uuid.uuid4().hex[:12]}"
            w = observed.write.mode("errorifexists")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(version)
            if (self.exists(name) and not partition_by and not old_parts
                    and self.read(name).schema.simpleString() == df.schema.simpleString()):
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{version}'")
                self.spark.sql(f"REFRESH TABLE {full}")
            else:
                kept = self._user_properties(name) if self.exists(name) else {}
                self.spark.sql(f"DROP TABLE IF EXISTS {full}")
                cols = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
                by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
                self.spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet{by} LOCATION '{version}'")
                properties = {**kept, **(properties or {})}
            if partition_by:
                self.spark.sql(f"MSCK REPAIR TABLE {full}")
        props = dict(properties or {})
        if comment is not None:
            props["comment"] = comment
        if props:
            kv = ", ".join(f"'{k}' = '{_esc(v)}'" for k, v in props.items())
            self.spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({kv})")
        ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = obs.get.get("rows", 0) if obs.get else 0
        self._append_ledger(full, operation or ("WRITE" if mode == "append" else "CREATE OR REPLACE"),
                            version, rows, started, ended)
        if sources:
            self.record_lineage(sources, full)
        elif found:
            self._append_lineage([(*s, full) for s in found])
        return version

    def partition_columns(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.full_name(name)) if c.isPartition]

    def _user_properties(self, name: str) -> dict:
        return {k: v for k, v in self.properties(name).items()
                if not k.startswith(("transient_", "spark.sql."))}

    def current_location(self, name: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}").collect()
        for r in rows:
            if r.col_name == "Location":
                return r.data_type
        raise KeyError(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def register(self, name: str, path: str, schema: StructType, comment: str | None = None,
                 partition_by: list[str] | None = None) -> None:
        """A catalog entry over a directory that something else writes (a stream's sink:
        batch reads then see the files its log has committed); moves with its comment."""
        full = self.full_name(name)
        if not self.exists(name):
            cols = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
            by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
            self.spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet{by} LOCATION '{path}'")
        if comment is not None:
            self.spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('comment' = '{_esc(comment)}')")
        self.spark.sql(f"REFRESH TABLE {full}")

    def drop(self, name: str, purge: list[str] | None = None) -> None:
        """``DROP TABLE IF EXISTS``; the files of all versions stay, but for the
        directories in ``purge``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(name)}")
        for path in purge or []:
            remove_tree(self.spark, path)

    def properties(self, name: str) -> dict:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(name)}").collect()
        return {r.key: r.value for r in rows}

    def comment(self, name: str) -> str | None:
        return next((r.data_type for r in self.describe(name).collect() if r.col_name == "Comment"), None)

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}")

    # -- ledger (describe history) -----------------------------------------
    def _append_ledger(self, table: str, operation: str, version: str, rows: int,
                       started, ended) -> None:
        df = self.spark.createDataFrame([(table, operation, version, int(rows), started, ended)],
                                        LEDGER_SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/_ledger")

    def history(self, name: str | None = None) -> DataFrame:
        """Refresh ledger: one row per write/refresh (``describe history``)."""
        try:
            led = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.root}/_ledger")
        except Exception:  # noqa: BLE001 - nothing written yet
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        if name:
            led = led.filter(F.col("table_name") == self.full_name(name))
        return led

    def log_refresh(self, table: str, operation: str, version: str, rows: int, started, ended):
        self._append_ledger(self.full_name(table), operation, version, rows, started, ended)

    # -- lineage -------------------------------------------------------------
    def record_lineage(self, sources: list[str], target: str, entity_type: str = "TABLE") -> None:
        parts = [s.rpartition(".") for s in sources]
        self._append_lineage([(schema or None, name, entity_type, self.full_name(target)) for schema, _, name in parts])

    def _append_lineage(self, rows: list[tuple]) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.spark.createDataFrame([(*r, now) for r in rows], LINEAGE_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/_lineage")

    def record_column_lineage(self, df: DataFrame, target: str) -> None:
        """Column lineage of ``df``, written as ``target``: one plan a column, no data read."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(self.full_name(target), name, *s, now) for name, found in column_sources(df).items() for s in found]
        self.spark.createDataFrame(rows, COLUMN_LINEAGE_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/_column_lineage")

    def column_lineage(self, target: str) -> DataFrame:
        """Recorded rows of a target."""
        return (self.spark.read.schema(COLUMN_LINEAGE_SCHEMA).parquet(f"{self.root}/_column_lineage")
                .filter(F.col("target_table_full_name") == self.full_name(target)))

    def lineage(self) -> DataFrame:
        try:
            return self.spark.read.schema(LINEAGE_SCHEMA).parquet(f"{self.root}/_lineage")
        except Exception:  # noqa: BLE001
            return self.spark.createDataFrame([], LINEAGE_SCHEMA)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Deletes a directory through the file system of its path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def lineage_lookup(store: TableStore, target: str) -> DataFrame:
    """Rows whose target is ``target``: chosen columns first, then all
    (duplicate names renamed so the result can be saved)."""
    lin = store.lineage().filter(F.col("target_table_full_name") == store.full_name(target))
    first = ["source_table_schema", "source_table_name", "entity_type"]
    return lin.select(*first, *[F.col(c).alias(f"{c}_all") if c in first else F.col(c)
                                for c in lin.columns])


def _columns(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _esc(v) -> str:
    s = v if isinstance(v, str) else json.dumps(v)
    return s.replace("\\", "\\\\").replace("'", "\\'")
