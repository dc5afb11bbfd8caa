"""Registration of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB statement over the test tables that must return the
    same rows; omit it for operators SQL cannot express (rows-only check).
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def round_floats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounds float/double columns so that summation order does not matter."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])
