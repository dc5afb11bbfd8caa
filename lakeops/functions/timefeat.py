"""Time expressions: epoch seconds and cyclic calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole seconds since 1970-01-01 for a TIMESTAMP or TIMESTAMP_NTZ column.

    ``ts.cast("long")`` is what the feature code uses; NTZ values cannot be cast
    to BIGINT, so they are measured against the NTZ epoch (no time zone used).
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampNTZType):
        return _ntz_minutes(col) * 60 + F.second(F.col(col)).cast("long")
    if isinstance(dtype, TimestampType):
        return F.unix_seconds(F.col(col))
    return F.col(col).cast("long")


def _ntz_minutes(col: str) -> Column:
    """Whole minutes since the epoch of an NTZ wall clock, from calendar fields
    only (no time zone, so no daylight-saving shifts)."""
    c = F.col(col)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(c).cast("long") * 60 + F.minute(c).cast("long")


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 (exact order key for either timestamp type)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampNTZType):
        micros_in_minute = (F.expr(f"date_part('SECOND', `{col}`)") * 1000000).cast("long")
        return _ntz_minutes(col) * 60000000 + micros_in_minute
    if isinstance(dtype, TimestampType):
        return F.unix_micros(F.col(col))
    return F.unix_micros(F.col(col).cast("timestamp"))


# The three cycles used by the time features (days per week,
# days per month, hours per day).
CYCLES = (("day_of_week", 7), ("day_of_month", 30), ("hour", 24))


def cyclic_time_columns(ts: str = "ts") -> dict[str, Column]:
    """sin/cos of weekday (Monday=0), day of month and hour over their cycles."""
    parts = {
        "day_of_week": F.weekday(F.col(ts)),
        "day_of_month": F.dayofmonth(F.col(ts)),
        "hour": F.hour(F.col(ts)),
    }
    out: dict[str, Column] = {}
    for name, period in CYCLES:
        angle = parts[name] * (2 * math.pi / period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def add_cyclic_time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds the six cyclic columns in one projection (no pandas round trip)."""
    return df.withColumns(cyclic_time_columns(ts))


def as_instant(df: DataFrame, col: str) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC instant (TIMESTAMP), independent of
    the session time zone; event-time windows and watermarks need TIMESTAMP."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_micros(epoch_micros(df, col))
    return F.col(col)


def as_wall_clock(c: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ in UTC (inverse of ``as_instant``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c),
                           F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
