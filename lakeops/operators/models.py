"""Model search, batch scoring and model persistence with ``pyspark.ml``.

Training is distributed by Spark ML (tree aggregation / per-partition
statistics); the search is a small fixed grid evaluated on a hold-out split.
Trials come back as a DataFrame so the best one is chosen with the same
top-1 operator as any other table.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ranking import best_trial
from lakeops.session import cut_lineage, work_dir

TRIAL_SCHEMA = "run_id string, model string, params string, status string, metric double, seconds double"

# The search grid (model family -> parameter sets).
CLASSIFIER_GRID = [
    ("logistic_regression", LogisticRegression, {"regParam": 0.0, "maxIter": 50}),
    ("logistic_regression", LogisticRegression, {"regParam": 0.1, "maxIter": 50}),
    ("random_forest", RandomForestClassifier, {"numTrees": 20, "maxDepth": 5, "seed": 7}),
    ("gbt", GBTClassifier, {"maxIter": 10, "maxDepth": 3, "seed": 7}),
]
REGRESSOR_GRID = [
    ("linear_regression", LinearRegression, {"regParam": 0.0}),
    ("linear_regression", LinearRegression, {"regParam": 0.1, "elasticNetParam": 0.5}),
    ("random_forest", RandomForestRegressor, {"numTrees": 20, "maxDepth": 5, "seed": 7}),
    ("gbt", GBTRegressor, {"maxIter": 10, "maxDepth": 3, "seed": 7}),
]


def _prepare(df: DataFrame, features: list[str], label: str | None) -> DataFrame:
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    if label:
        cols.append(F.col(label).cast("double").alias("label"))
    return df.select(*cols)


def search(train: DataFrame, valid: DataFrame, features: list[str], label: str,
           task: str = "classification", grid=None, budget_seconds: float | None = None):
    """Fits each grid entry, scores it on ``valid``; returns (trials, models).

    Classification metric: log loss (lower is better); regression: RMSE.
    Entries not started before ``budget_seconds`` are recorded as SKIPPED.
    """
    grid = grid or (CLASSIFIER_GRID if task == "classification" else REGRESSOR_GRID)
    # iterative fits re-read their input many times: materialise the prepared
    # frames once (reliable checkpoint in the shared folder, lineage cut)
    tr = cut_lineage(_prepare(train, features, label))
    va = cut_lineage(_prepare(valid, features, label))
    if task == "classification":
        evaluator = MulticlassClassificationEvaluator(metricName="logLoss")
    else:
        evaluator = RegressionEvaluator(metricName="rmse")
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    trials, models = [], {}
    model_root = work_dir(train.sparkSession, "models")
    started = time.time()
    for i, (name, cls, params) in enumerate(grid):
        run_id = f"run-{i:02d}-{uuid.uuid4().hex[:6]}"
        if budget_seconds is not None and time.time() - started > budget_seconds:
            trials.append((run_id, name, json.dumps(params), "SKIPPED", None, 0.0))
            continue
        t0 = time.time()
        try:
            fitted = Pipeline(stages=[assembler, cls(**params)]).fit(tr)
            # persist every trial model in the shared folder and continue with
            # the reloaded copy: it carries no training summary, whose session
            # reference cannot be serialised once the session has used
            # observations (expectation counters)
            path = f"{model_root}/{run_id}"
            fitted.write().overwrite().save(path)
            model = PipelineModel.load(path)
            metric = float(evaluator.evaluate(model.transform(va)))
            trials.append((run_id, name, json.dumps(params, sort_keys=True), "FINISHED", metric,
                           time.time() - t0))
            models[run_id] = model
        except Exception as e:  # noqa: BLE001 - a failed trial is a result, not a crash
            trials.append((run_id, name, json.dumps({"error": str(e)[:1500]}), "FAILED", None,
                           time.time() - t0))
    spark = train.sparkSession
    return spark.createDataFrame(trials, TRIAL_SCHEMA), models


def pick_best(trials: DataFrame, lower_is_better: bool = True) -> DataFrame:
    return best_trial(trials, "metric", higher_is_better=not lower_is_better)


def score_batch(model: PipelineModel, df: DataFrame, features: list[str],
                result_type: str = "double") -> DataFrame:
    """Input columns unchanged plus ``prediction`` cast to ``result_type``
    (features are NULL-filled for the model only)."""
    prepared = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__orig"),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    scored = model.transform(prepared)
    return scored.select("__orig.*", F.col("prediction").cast(result_type).alias("prediction"))


def save_model(model: PipelineModel, path: str, input_schema=None) -> None:
    """Saves the pipeline; the input schema is kept as JSON next to it."""
    model.write().overwrite().save(path)
    if input_schema is not None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(input_schema.json(),)], "schema string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/input_schema")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_inferences(store, scored: DataFrame, table: str, model_name: str) -> str:
    """Appends scored rows to an inference table with request time, model
    and a request id per row (the request/response log)."""
    out = scored.select(F.expr("uuid()").alias("request_id"),
                        F.current_timestamp().alias("request_time"),
                        F.lit(model_name).alias("model"), "*")
    return store.write(out, table, mode="append", operation="INFERENCE LOG")
