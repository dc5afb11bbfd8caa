"""Scalar functions exposed to SQL.

``previous_sales`` recovers last period's value from the current value and a
percentage change: ``bigint(current / (1 + pct / 100))``.  The native form stays
inside whole-stage codegen; the Arrow-batched pandas form is what a Python
function registered for SQL looks like when it must be Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType


def previous_sales_expr(current: str | Column, pct: str | Column) -> Column:
    cur = F.col(current) if isinstance(current, str) else current
    p = F.col(pct) if isinstance(pct, str) else pct
    return F.try_divide(cur.cast("double"), 1 + p / 100).cast("bigint")


@pandas_udf(LongType())
def previous_sales_pandas(current: pd.Series, pct: pd.Series) -> pd.Series:
    prev = current.astype("float64") / (1.0 + pct.astype("float64") / 100.0)
    prev = prev.where(np.isfinite(prev))        # a -100 % change has no previous value
    # truncation toward zero, NULL stays NULL
    return np.trunc(prev).astype("Int64")


def register_previous_sales(spark: SparkSession, name: str = "previous_sales") -> None:
    spark.udf.register(name, previous_sales_pandas)
