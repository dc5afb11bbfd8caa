"""Model search, persistence, scoring and the inference log."""

from pyspark.sql import functions as F

from lakeops.operators import models
from lakeops.operators.quality import Expectation, apply_expectations
from lakeops.plans.tables import TableStore
from lakeops.session import work_dir
from tests.conftest import rows


def _data(spark):
    df = spark.range(0, 400).select(
        (F.col("id") % 7).cast("double").alias("x1"), (F.col("id") % 5).cast("double").alias("x2"),
        F.col("id"))
    return df.withColumn("y", ((F.col("x1") + F.col("x2")) > 5).cast("int"))


def test_search_after_observations_and_persistence(spark):
    df = _data(spark)
    # a session that has used observations (expectation counters) first
    checked, obs = apply_expectations(df, [Expectation("pos", "x1 >= 0")])
    checked.count()
    assert obs.get["pos_violations"] == 0
    train, valid = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    trials, fitted = models.search(train, valid, ["x1", "x2"], "y", "classification",
                                   grid=models.CLASSIFIER_GRID[:2])
    assert [r.status for r in trials.collect()] == ["FINISHED", "FINISHED"]
    best = models.pick_best(trials).first()
    assert best.metric == min(r.metric for r in trials.collect())
    path = work_dir(spark, "saved-model")
    models.save_model(fitted[best.run_id], path, input_schema=df.schema)
    loaded = models.load_model(path)
    scored = models.score_batch(loaded, valid.select("id", "x1", "x2"), ["x1", "x2"], "boolean")
    assert scored.columns == ["id", "x1", "x2", "prediction"]
    assert dict(scored.dtypes)["prediction"] == "boolean" and scored.count() == 100
    store = TableStore(spark, "inference_t")
    models.log_inferences(store, scored, "inference_log", best.model)
    models.log_inferences(store, scored, "inference_log", best.model)
    log = store.read("inference_log")
    assert log.count() == 200 and log.select("request_id").distinct().count() == 200
    assert rows(store.history("inference_log").select("num_output_rows")) == [(100,), (100,)]


def test_regression_search(spark):
    df = _data(spark).withColumn("target", F.col("x1") * 2 + F.col("x2"))
    trials, _ = models.search(df.filter("id % 4 <> 0"), df.filter("id % 4 = 0"), ["x1", "x2"],
                              "target", "regression", grid=models.REGRESSOR_GRID[:1])
    r = trials.first()
    assert r.status == "FINISHED" and r.metric < 1e-6


def test_score_batch_searches_the_whole_grid(spark, monkeypatch):
    from lakeops.registry import ml
    df = _data(spark)
    travel = df.select("id", F.col("y").alias("purchased"), F.lit(1).alias("user_id"), F.lit(2).alias("destination_id"),
                       F.lit("t").alias("ts"), *[(F.col("x1") + i).alias(c) for i, c in enumerate(ml.TRAVEL_FEATURES)])
    monkeypatch.setattr(ml, "_travel_training", lambda spark, sf_dir: (travel.filter("id % 4 <> 0"), travel.filter("id % 4 = 0")))
    seen, search = [], models.search

    def spy(*args, **named):
        found = search(*args, **named)
        seen.append(found[0].select("model", "status").collect())
        return found

    monkeypatch.setattr(models, "search", spy)
    assert ml.score_batch(spark, "").count() == 100
    assert [tuple(r) for r in seen[0]] == [(m, "FINISHED") for m, *_ in models.CLASSIFIER_GRID]
