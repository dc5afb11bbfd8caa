"""User and destination feature groups over a purchase/click log.

Input columns: user_id, destination_id, ts, price, purchased, clicked,
user_latitude, user_longitude.  One output row per input row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.timefeat import cyclic_time_columns, epoch_seconds
from lakeops.operators.rolling import count_frame, rolling_aggregate, sum_frame

DAY = 86400
# Frame lengths of the feature definitions (7 days; 6 x 30 days).
WEEK_SECONDS = 7 * DAY
HALF_YEAR_SECONDS = 6 * 30 * DAY


def user_features(log: DataFrame, leak_free: bool = False,
                  bucket_seconds: int | None = None) -> DataFrame:
    """7-day mean price, 6-month purchase count and cyclic time features.

    ``mean_price_7d`` is sum(price) / count(rows): the sum skips NULL prices but
    the count does not, exactly as specified.  Frames end at the current row;
    ``leak_free=True`` ends them one second earlier so that the outcome at a
    label's own time is not part of its features.
    """
    end = 1 if leak_free else 0
    staged = log.select("user_id", "ts", "price", "user_longitude", "user_latitude",
                        F.col("purchased").cast("int").alias("__purchased"),
                        epoch_seconds(log, "ts").alias("__sec"))
    frames = [
        sum_frame("__price_7d", "price", WEEK_SECONDS, end),
        count_frame("__rows_7d", WEEK_SECONDS, end),
        sum_frame("last_6m_purchases", "__purchased", HALF_YEAR_SECONDS, end),
    ]
    rolled = rolling_aggregate(staged, ["user_id"], "__sec", frames, bucket_seconds)
    return rolled.select(
        "user_id", "ts",
        F.try_divide(F.col("__price_7d"), F.col("__rows_7d")).alias("mean_price_7d"),
        "last_6m_purchases", "user_longitude", "user_latitude",
        *[c.alias(n) for n, c in cyclic_time_columns("ts").items()],
    )


def destination_features(log: DataFrame, bucket_seconds: int | None = None) -> DataFrame:
    """7-day clicks and impressions (rows) per destination."""
    staged = log.select("destination_id", "ts", F.col("clicked").cast("int").alias("__clicked"),
                        epoch_seconds(log, "ts").alias("__sec"))
    frames = [
        sum_frame("sum_clicks_7d", "__clicked", WEEK_SECONDS),
        count_frame("sum_impressions_7d", WEEK_SECONDS),
    ]
    rolled = rolling_aggregate(staged, ["destination_id"], "__sec", frames, bucket_seconds)
    return rolled.select("destination_id", "ts", "sum_clicks_7d", "sum_impressions_7d")
