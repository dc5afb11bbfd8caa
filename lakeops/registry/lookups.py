"""Point-in-time lookups, training sets, exact-key lookups, time split."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators.asof import FeatureLookup, asof_join, create_training_set, time_split
from lakeops.operators.travel_features import destination_features, user_features
from lakeops.registry._base import query, round_floats
from lakeops.registry.travel import DEST_FEAT_BODY, USER_FEAT_BODY
from lakeops.sources.testdata import TRAVEL_CTE, travel_log

# Fixed value: the train/test cutoff inside the 30-day event range.
CUTOFF = "2024-01-23"
USER_SUBSET = ["mean_price_7d", "last_6m_purchases", "day_of_week_sin", "day_of_week_cos",
               "day_of_month_sin", "day_of_month_cos", "hour_sin", "hour_cos"]

_LABELS = "labels AS (SELECT event_id, user_id, destination_id, ts, purchased FROM travel WHERE purchased)"
_BROWSE = "browse AS (SELECT * FROM travel WHERE NOT purchased)"


def _labels(log):
    return log.filter("purchased").select("event_id", "user_id", "destination_id", "ts", "purchased")


def _browse(log):
    # every row that is no purchase: a feature source that differs from the label
    # rows, so matches are genuinely earlier rows
    return log.filter(~F.col("purchased"))


@query("asof_lookup", f"""
WITH {TRAVEL_CTE}, {_LABELS}, {_BROWSE},
dfeat AS ({DEST_FEAT_BODY.replace('FROM travel', 'FROM browse')})
SELECT l.event_id, l.user_id, l.destination_id, l.ts, l.purchased, f.sum_clicks_7d, f.sum_impressions_7d
FROM labels l ASOF LEFT JOIN dfeat f ON l.destination_id = f.destination_id AND l.ts >= f.ts
""")
def asof_lookup(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    feats = destination_features(_browse(log))
    return asof_join(_labels(log), feats, ["destination_id"])


@query("asof_lookup_subset", f"""
WITH {TRAVEL_CTE}, {_LABELS}, {_BROWSE},
ufeat AS ({USER_FEAT_BODY.replace('FROM travel', 'FROM browse')})
SELECT l.event_id, l.user_id, l.destination_id, l.ts, l.purchased,
  f.mean_price_7d, f.day_of_week_sin, f.hour_cos
FROM labels l ASOF LEFT JOIN ufeat f ON l.user_id = f.user_id AND l.ts >= f.ts
""")
def asof_lookup_subset(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    feats = user_features(_browse(log))
    return round_floats(asof_join(_labels(log), feats, ["user_id"],
                                  features=["mean_price_7d", "day_of_week_sin", "hour_cos"]))


@query("training_set", f"""
WITH {TRAVEL_CTE},
gt AS (SELECT user_id, destination_id, purchased, ts FROM travel WHERE ts < TIMESTAMP '{CUTOFF}'),
dfeat AS ({DEST_FEAT_BODY}),
ufeat AS ({USER_FEAT_BODY})
SELECT d.sum_clicks_7d, d.sum_impressions_7d,
  u.{', u.'.join(USER_SUBSET)}, g.purchased
FROM gt g
ASOF LEFT JOIN dfeat d ON g.destination_id = d.destination_id AND g.ts >= d.ts
ASOF LEFT JOIN ufeat u ON g.user_id = u.user_id AND g.ts >= u.ts
""")
def training_set(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    ground_truth = log.select("user_id", "destination_id", "purchased", "ts")
    train, _ = time_split(ground_truth, CUTOFF)
    lookups = [
        FeatureLookup(destination_features(log), "destination_id", timestamp_lookup_key="ts"),
        FeatureLookup(user_features(log), "user_id", timestamp_lookup_key="ts",
                      feature_names=USER_SUBSET),
    ]
    ts = create_training_set(train, lookups, exclude_columns=["ts", "destination_id", "user_id"],
                             label="purchased")
    return round_floats(ts)


@query("time_split", f"""
WITH {TRAVEL_CTE}
SELECT user_id, destination_id, purchased, ts,
  CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
FROM travel
""")
def time_split_q(spark, sf_dir):
    gt = travel_log(spark, sf_dir).select("user_id", "destination_id", "purchased", "ts")
    train, test = time_split(gt, CUTOFF)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


def _daily(log):
    return log.withColumn("day", F.to_date("ts"))


@query("feature_lookup_exact", f"""
WITH {TRAVEL_CTE}, d AS (SELECT *, CAST(ts AS DATE) AS day FROM travel),
lab AS (SELECT user_id, day, count(*) AS n_purchases FROM d WHERE purchased GROUP BY ALL),
f1 AS (SELECT user_id, day, count(*) AS n_clicks FROM d WHERE clicked GROUP BY ALL),
f2 AS (SELECT user_id, day, count(*) AS n_events, round(sum(price), 6) AS total_value FROM d GROUP BY ALL),
f3 AS (SELECT user_id, day, round(max(price), 6) AS max_value FROM d WHERE NOT purchased GROUP BY ALL)
SELECT * FROM lab LEFT JOIN f1 USING (user_id, day) LEFT JOIN f2 USING (user_id, day)
  LEFT JOIN f3 USING (user_id, day)
""")
def feature_lookup_exact(spark, sf_dir):
    d = _daily(travel_log(spark, sf_dir))
    keys = ["user_id", "day"]
    lab = d.filter("purchased").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_purchases"))
    f1 = d.filter("clicked").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_clicks"))
    f2 = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"),
                              F.round(F.sum("price"), 6).alias("total_value"))
    f3 = d.filter(~F.col("purchased")).groupBy(*keys).agg(F.round(F.max("price"), 6).alias("max_value"))
    return create_training_set(lab, [FeatureLookup(f, keys) for f in (f1, f2, f3)])
