"""Stateful streaming operators: chained event-time windows, per-key running
state in Python, de-duplication within a watermark.

State lives in the streaming state store (checkpointed, partitioned by key
across executors).  Python state functions receive a key's rows as an
iterator of Arrow batches, so even a hot key never materialises at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def chained_window_counts(stream: DataFrame, ts: str, key: str, inner: str = "1 hour",
                          outer: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Two stateful aggregations in one query: counts per inner window, then
    those counts summed per outer window (append mode: a window is emitted
    once the watermark has passed its end)."""
    s = stream.withWatermark(ts, watermark)
    inner_counts = s.groupBy(F.window(ts, inner).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    outer_counts = (inner_counts.groupBy(F.window(F.window_time("w"), outer).alias("w"), key)
                    .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_inner_windows")))
    return outer_counts.select(F.col("w.start").alias("window_start"),
                               F.col("w.end").alias("window_end"), key, "n", "n_inner_windows")


RUNNING_OUTPUT = "key long, n_events long, total_value double"
RUNNING_STATE = "n_events long, total_value double"


def _running_totals(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, total = (state.get if state.exists else (0, 0.0))
    for pdf in batches:
        n += len(pdf)
        total += float(pdf["value"].fillna(0.0).sum())
    state.update((n, total))
    yield pd.DataFrame({"key": [key[0]], "n_events": [n], "total_value": [total]})


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: events so far and running sum, emitted for every key that
    received rows in a micro-batch (``applyInPandasWithState``)."""
    return (stream.select(F.col(key).cast("long").alias("key"), F.col(value).cast("double").alias("value"))
            .groupBy("key")
            .applyInPandasWithState(_running_totals, RUNNING_OUTPUT, RUNNING_STATE, "update",
                                    GroupStateTimeout.NoTimeout))


def dedup_within_watermark(stream: DataFrame, keys: list[str], ts: str,
                           delay: str = "1 hour") -> DataFrame:
    """Keeps the first row per key among rows whose event times lie within
    the watermark delay of each other."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
