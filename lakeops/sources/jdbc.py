"""Reads from external databases over JDBC (federation).

These are thin, standard Spark reader configurations.  Large tables are read
in parallel by splitting a numeric/date column into ``num_partitions`` ranges
(one connection per task); filters and aggregates are pushed to the database
by Spark's JDBC v2 source where it can.

No registered query uses them: the test environment may not start a
database, not even an embedded one, so these paths are not exercised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(spark: SparkSession, url: str, table: str, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetch_size: int = 10000,
               extra: dict | None = None) -> DataFrame:
    """``spark.read.format("jdbc")`` with parallel range partitioning."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need bounds and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load()


def remote_tables(spark: SparkSession, url: str, schema: str, **kw) -> DataFrame:
    """``information_schema.tables`` of one remote schema (filter pushed down)."""
    t = jdbc_table(spark, url, "information_schema.tables", **kw)
    return t.filter(F.col("table_schema") == schema).select("table_schema", "table_name")


def register_foreign_catalog(spark: SparkSession, name: str, url: str, driver: str | None = None,
                             user: str | None = None, password: str | None = None) -> None:
    """``CREATE FOREIGN CATALOG name USING CONNECTION ...``: a JDBC table
    catalog, after which ``SHOW TABLES IN name.schema`` and three-part names
    ``SELECT * FROM name.schema.table`` work (with predicate pushdown)."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set(f"{prefix}.url", url)
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v is not None:
            spark.conf.set(f"{prefix}.{k}", v)


def create_jdbc_table(spark: SparkSession, name: str, url: str, dbtable: str,
                      driver: str | None = None) -> None:
    """Single JDBC-backed table in the session catalog."""
    opts = f"url '{url}', dbtable '{dbtable}'" + (f", driver '{driver}'" if driver else "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING jdbc OPTIONS ({opts})")
