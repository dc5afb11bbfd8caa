"""Travel demo: rolling-window features, cyclic time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.timefeat import add_cyclic_time_features, epoch_seconds
from lakeops.operators.rolling import count_frame, rolling_aggregate, sum_frame
from lakeops.operators.travel_features import (WEEK_SECONDS, destination_features,
                                               user_features)
from lakeops.registry._base import query, round_floats
from lakeops.sources.testdata import TRAVEL_CTE, travel_log

_SEC = "epoch_us(ts) // 1000000"
_W7 = f"(PARTITION BY user_id ORDER BY {_SEC} RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)"
_CYCLIC_SQL = (
    "round(sin((isodow(ts) - 1) * (2 * pi() / 7)), 6) AS day_of_week_sin, "
    "round(cos((isodow(ts) - 1) * (2 * pi() / 7)), 6) AS day_of_week_cos, "
    "round(sin(day(ts) * (2 * pi() / 30)), 6) AS day_of_month_sin, "
    "round(cos(day(ts) * (2 * pi() / 30)), 6) AS day_of_month_cos, "
    "round(sin(hour(ts) * (2 * pi() / 24)), 6) AS hour_sin, "
    "round(cos(hour(ts) * (2 * pi() / 24)), 6) AS hour_cos"
)


@query("rolling_sum_7d", f"""
WITH {TRAVEL_CTE}
SELECT event_id, user_id, ts, round(sum(price) OVER {_W7}, 6) AS price_7d_sum FROM travel
""")
def rolling_sum_7d(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    staged = log.select("event_id", "user_id", "ts", "price",
                        epoch_seconds(log, "ts").alias("sec"))
    out = rolling_aggregate(staged, ["user_id"], "sec",
                            [sum_frame("price_7d_sum", "price", WEEK_SECONDS)])
    return round_floats(out.select("event_id", "user_id", "ts", "price_7d_sum"))


@query("rolling_count_7d", f"""
WITH {TRAVEL_CTE}
SELECT event_id, user_id, ts, count(*) OVER {_W7} AS rows_7d FROM travel
""")
def rolling_count_7d(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    staged = log.select("event_id", "user_id", "ts", epoch_seconds(log, "ts").alias("sec"))
    # the halo strategy (time buckets with copied frame edges) on purpose,
    # so both exact strategies stay covered by the oracle
    out = rolling_aggregate(staged, ["user_id"], "sec",
                            [count_frame("rows_7d", WEEK_SECONDS)], strategy="halo")
    return out.select("event_id", "user_id", "ts", "rows_7d")


USER_FEAT_BODY = f"""
SELECT user_id, ts,
  round(sum(price) OVER {_W7} / count(*) OVER {_W7}, 6) AS mean_price_7d,
  CAST(sum(CAST(purchased AS INTEGER)) OVER (PARTITION BY user_id ORDER BY {_SEC}
       RANGE BETWEEN 15552000 PRECEDING AND CURRENT ROW) AS BIGINT) AS last_6m_purchases,
  user_longitude, user_latitude, {_CYCLIC_SQL}
FROM travel
"""
DEST_FEAT_BODY = f"""
SELECT destination_id, ts,
  CAST(sum(CAST(clicked AS INTEGER)) OVER w AS BIGINT) AS sum_clicks_7d,
  count(*) OVER w AS sum_impressions_7d
FROM travel
WINDOW w AS (PARTITION BY destination_id ORDER BY {_SEC} RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)
"""


@query("user_features", f"WITH {TRAVEL_CTE} {USER_FEAT_BODY}")
def user_features_q(spark, sf_dir):
    return round_floats(user_features(travel_log(spark, sf_dir)))


@query("destination_features", f"WITH {TRAVEL_CTE} {DEST_FEAT_BODY}")
def destination_features_q(spark, sf_dir):
    return destination_features(travel_log(spark, sf_dir))


@query("cyclic_time_features", f"""
WITH {TRAVEL_CTE}
SELECT event_id, ts, {_CYCLIC_SQL} FROM travel
""")
def cyclic_time_features(spark, sf_dir):
    log = travel_log(spark, sf_dir).select("event_id", "ts")
    return round_floats(add_cyclic_time_features(log))
