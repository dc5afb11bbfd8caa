"""A key holding a third of all rows: results stay exact and the hot key is
split across many groups."""

from pyspark.sql import functions as F

from lakeops.functions.timefeat import epoch_seconds
from lakeops.operators.asof import asof_join, asof_join_plain
from lakeops.operators.rolling import (count_frame, rolling_aggregate, rolling_aggregate_plain,
                                       sum_frame)
from lakeops.operators.travel_features import WEEK_SECONDS
from lakeops.sources.testdata import table
from tests.conftest import SF01


def _skewed(spark):
    e = table(spark, SF01, "events")
    # every third event belongs to one hot user
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_hot_key_rolling_exact_and_split(spark):
    e = _skewed(spark)
    df = e.select("event_id", "user_id", "value", epoch_seconds(e, "ts").alias("sec"))
    frames = [sum_frame("s", "value", WEEK_SECONDS), count_frame("n", WEEK_SECONDS)]
    got = rolling_aggregate(df, ["user_id"], "sec", frames)
    want = rolling_aggregate_plain(df, ["user_id"], "sec", frames)
    norm = lambda d: sorted((r.event_id, round(r.s, 6), r.n) for r in d.collect())
    assert norm(got) == norm(want)
    hot_rows = df.filter("user_id = 0").count()
    # the cells strategy's largest window group: key-seconds of one (key, day)
    per_day = (df.groupBy("user_id", "sec").count()
               .groupBy("user_id", F.floor(F.col("sec") / 86400).alias("d")).count()
               .agg(F.max("count")).first()[0])
    assert hot_rows > df.count() / 4 and per_day * 20 < hot_rows


def test_hot_key_asof_exact(spark):
    e = _skewed(spark)
    labels = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    feats = e.filter("event_type = 'click'").select("user_id", "ts", F.col("value").alias("click_value"))
    got = asof_join(labels, feats, ["user_id"])
    want = asof_join_plain(labels, feats, ["user_id"])
    norm = lambda d: sorted((r.event_id, r.click_value) for r in d.collect())
    assert norm(got) == norm(want)


def test_graph_rejects_cycles_and_unknown_inputs(spark):
    import pytest
    from lakeops.plans.datasets import DatasetGraph
    from lakeops.plans.tables import TableStore
    g = DatasetGraph(spark, TableStore(spark, "graph_err"))
    g.live_table("a", lambda g: g.read("b"), depends_on=["b"])
    g.live_table("b", lambda g: g.read("a"), depends_on=["a"])
    with pytest.raises(ValueError):
        g.order()
    g2 = DatasetGraph(spark, TableStore(spark, "graph_err2"))
    g2.live_table("a", lambda g: g.read("zzz"), depends_on=["zzz"])
    with pytest.raises(KeyError):
        g2.order()
