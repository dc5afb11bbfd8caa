"""Model search and batch scoring (rows-only checks: training has no SQL form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import models
from lakeops.operators import players as P
from lakeops.operators.asof import FeatureLookup, create_training_set, time_split
from lakeops.operators.travel_features import destination_features, user_features
from lakeops.registry._base import query
from lakeops.registry.lookups import CUTOFF, USER_SUBSET
from lakeops.sources.testdata import player_bronze, travel_log

#: rows from here to the cutoff pick the model
PICK_FROM = "2024-01-17"
TRAVEL_FEATURES = ["sum_clicks_7d", "sum_impressions_7d"] + USER_SUBSET


def _travel_training(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    gt = log.select("user_id", "destination_id", "purchased", "ts")
    lookups = [
        FeatureLookup(destination_features(log), "destination_id", timestamp_lookup_key="ts"),
        FeatureLookup(user_features(log, leak_free=True), "user_id", timestamp_lookup_key="ts",
                      feature_names=USER_SUBSET),
    ]
    full = create_training_set(gt, lookups, label="purchased")
    return time_split(full, CUTOFF)


@query("train_classify")
def train_classify(spark, sf_dir):
    train, valid = _travel_training(spark, sf_dir)
    trials, _ = models.search(train, valid, TRAVEL_FEATURES, "purchased", "classification")
    return trials.select("model", "params", "status", F.round("metric", 4).alias("log_loss"))


@query("score_batch")
def score_batch(spark, sf_dir):
    """Models fitted on the rows before ``PICK_FROM``, the best picked on those from there
    to the cutoff, and the rows after the cutoff, which neither saw, scored.  If no row lies
    before ``PICK_FROM``, the best is picked on the rows that the models are fitted on."""
    known, test = _travel_training(spark, sf_dir)
    train, valid = time_split(known, PICK_FROM)
    if train.isEmpty():
        train = valid = known
    trials, fitted = models.search(train, valid, TRAVEL_FEATURES, "purchased", "classification")
    failed = [r["model"] for r in trials.filter("status <> 'FINISHED'").collect()]
    if failed:
        raise RuntimeError(f"trials failed: {failed}")
    best = models.pick_best(trials).collect()[0]      # one row: the best trial
    model = fitted[best.run_id]
    batch = test.select("user_id", "destination_id", "ts", "purchased", *TRAVEL_FEATURES)
    return models.score_batch(model, batch, TRAVEL_FEATURES, result_type="boolean")


PLAYER_FEATURES = ["Age_Group_Young", "High_Reputation", "Work_Rate_Score", "Offensive_Score",
                   "Defensive_Score", "Special_Skill", "Goalkeeper_Skill_Score", "Skill_Variance",
                   "BMI", "Speed_Score", "Mobility_Score", "Endurance_Score", "Physical_Variance",
                   "Contract_Duration"]


@query("train_regress")
def train_regress(spark, sf_dir):
    silver = P.clean_players(player_bronze(spark, sf_dir))
    keys = ["id", "year"]
    labels = silver.select(*keys, "value")
    demo = P.demographic_features(silver).select(
        *keys, (F.col("Age_Group") == "Young").cast("int").alias("Age_Group_Young"),
        "High_Reputation", "Work_Rate_Score")
    skill = P.skill_features(silver).select(*keys, "Offensive_Score", "Defensive_Score",
                                            "Special_Skill", "Goalkeeper_Skill_Score", "Skill_Variance")
    phys = P.physical_features(silver).select(*keys, "BMI", "Speed_Score", "Mobility_Score",
                                              "Endurance_Score", "Physical_Variance")
    contract = P.contract_features(silver).select(*keys, "Contract_Duration")
    ts = create_training_set(labels, [FeatureLookup(t, keys) for t in (demo, skill, phys, contract)],
                             label="value").filter(F.col("value").isNotNull())
    train = ts.filter(F.col("year") < 2022)
    valid = ts.filter(F.col("year") >= 2022)
    trials, _ = models.search(train, valid, PLAYER_FEATURES, "value", "regression")
    return trials.select("model", "params", "status", F.round("metric", 2).alias("rmse"))
