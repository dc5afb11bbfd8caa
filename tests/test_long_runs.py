"""Streaming runs of more batches than Spark keeps; edge answers of small operators."""

import pytest

from lakeops.operators import changes, ranking
from lakeops.streaming.ingest import StreamingTable


def test_counts_past_the_progress_limit(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(15).repartition(15).write.parquet(src)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        t = StreamingTable(spark, src, str(tmp_path / "out"), "parquet", spark.read.parquet(src).schema,
                           max_files_per_trigger=1)
        assert t.refresh() == 15
    finally:
        spark.conf.set(key, old)


def test_top_k_keeps_null_and_others_apart(spark):
    df = spark.createDataFrame([(None, 100), ("a", 50), ("others", 20), ("c", 1)], "k string, v long")
    got = sorted(map(tuple, ranking.top_k_with_others(df, "k", "v", 3).collect()), key=str)
    assert got == sorted([(None, 100), ("a", 50), ("others", 20), ("others", 1)], key=str)


def test_latest_of_null_orders_and_unique_updates(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 1, "a"), (2, 2, "b")], "k int, o int, v string")
    assert sorted(map(tuple, changes.latest_per_key(df, ["k"], "o").collect())) == [(1, None, "x"), (2, 2, "b")]
    with pytest.raises(Exception, match="several updates for one key"):
        changes.merge_upsert(df.select("k", "v"), df.select("k", "v"), ["k"]).collect()
    nulls = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k int, v string")
    got = changes.merge_upsert(nulls, nulls.filter("k IS NULL"), ["k"]).collect()      # NULL keys match nothing
    assert sorted(map(tuple, got), key=str) == sorted([(1, "z"), (None, "x"), (None, "x"), (None, "y"), (None, "y")], key=str)
    feed = changes.snapshot_changes(nulls, nulls, ["k"]).collect()
    assert sorted(r["_change_type"] for r in feed) == ["delete", "delete", "insert", "insert"]
