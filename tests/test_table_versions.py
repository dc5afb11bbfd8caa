"""Table versions with other columns or partitions, compaction seen by new
objects, failing streams, refused lookups, odd vectors."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators.quality import Expectation
from lakeops.operators.search import vector_topk
from lakeops.plans.datasets import DatasetGraph
from lakeops.plans.features import FeatureStore
from lakeops.plans.tables import TableStore
from lakeops.plans.views import IncrementalAggregateView
from lakeops.session import work_dir
from tests.conftest import rows


def test_overwrite_with_other_columns_keeps_properties(spark):
    store = TableStore(spark, "t_versions")
    store.write(spark.createDataFrame([(1, "x")], "id int, a string"), "t", properties={"team": "me"})
    store.write(spark.createDataFrame([(2, 5)], "id int, b long"), "t")
    assert store.read("t").columns == ["id", "b"] and rows(store.read("t")) == [(2, 5)]
    assert store.properties("t")["team"] == "me"
    store.write(store.read("t").withColumn("c", F.lit("z")), "t")
    assert rows(store.read("t")) == [(2, 5, "z")]
    with pytest.raises(ValueError):
        store.write(spark.createDataFrame([(2,)], "id int"), "t", mode="append")


def test_partitioned_overwrite_and_append(spark):
    store = TableStore(spark, "t_parts")
    store.write(spark.createDataFrame([(1, "1"), (2, "2")], "id int, p string"), "t", partition_by=["p"])
    store.write(spark.createDataFrame([(10, "1"), (30, "3")], "id int, p string"), "t", partition_by=["p"])
    assert sorted(rows(store.read("t"))) == [(10, "1"), (30, "3")]
    store.write(spark.createDataFrame([(40, "4")], "id int, p string"), "t", mode="append")
    assert sorted(rows(store.read("t"))) == [(10, "1"), (30, "3"), (40, "4")]
    store.write(spark.createDataFrame([(5, "x")], "id int, p string"), "t")
    assert rows(store.read("t")) == [(5, "x")] and store.partition_columns("t") == []


def test_feature_table_takes_a_new_column(spark):
    fs = FeatureStore(TableStore(spark, "fs_versions"))
    fs.create_table("f", "id", spark.createDataFrame([(1, 2.0)], "id int, x double"))
    fs.write_table("f", spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double"))
    assert rows(fs.read_table("f")) == [(1, 2.0, 3.0)]
    assert fs.get_table("f").features == ["x", "y"]


def test_lookup_of_a_time_keyed_table_needs_the_time(spark):
    fs = FeatureStore(TableStore(spark, "fs_time"))
    fs.create_table("f", "id", spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "id int, ts int, x double"),
                    timestamp_keys="ts")
    with pytest.raises(ValueError):
        fs.lookup("f", "id")
    with pytest.raises(ValueError):
        fs.lookup("f", ["id", "other"], timestamp_lookup_key="ts")


def test_compaction_holds_for_new_objects_and_replayed_batches(spark, tmp_path):
    src = str(tmp_path / "src")

    def view():
        return IncrementalAggregateView(spark, src, data.schema, ["k"], {"s": ("sum", "v"), "m": ("min", "v")},
                                        str(tmp_path / "mv"), max_files_per_trigger=1)

    data = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 4.0)], "k string, v double")
    data.coalesce(1).write.parquet(f"{src}/part=1")
    one = view()
    one.refresh()
    one.compact()
    assert one.compact() == one.compact()
    data.coalesce(1).write.parquet(f"{src}/part=2")
    one.refresh()
    want = sorted([("a", 2.0, 1.0), ("b", 4.0, 2.0), (None, 8.0, 4.0)], key=str)
    assert sorted(map(tuple, one.read().collect()), key=str) == want
    assert sorted(map(tuple, view().read().collect()), key=str) == want
    view()._write_batch(data, 0)                     # a replay of a batch that is compacted
    assert sorted(map(tuple, view().read().collect()), key=str) == want
    view().compact()
    assert sorted(map(tuple, one.read().collect()), key=str) == want


def test_fail_expectation_stops_a_stream(spark):
    src = work_dir(spark, "fail-src")
    spark.createDataFrame([("1", "10"), ("2", "-5")], "u string, price string").write.option("header", "true").csv(src)
    g = DatasetGraph(spark, TableStore(spark, "t_fail"))
    schema = spark.createDataFrame([], "u string, price string").schema

    g.streaming_table("raw", lambda _: spark.readStream.schema(schema).option("header", "true").csv(src),
                      [Expectation("positive", "price > 0", "fail")])
    with pytest.raises(Exception, match="positive"):
        g.run()


def test_odd_vectors_take_no_part_and_ids_are_unique(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (None, [1.0, 0.0]), (4, [0.0, 1.0])],
                              "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id long, query array<double>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in vector_topk(v, q, 5).orderBy("rank").collect()] == [
        (7, 1, 1), (7, 2, 4)]
    with pytest.raises(ValueError):
        vector_topk(v, q.union(q), 5)


def test_streaming_table_is_a_catalog_object(spark):
    """By name: committed files only, comment, history, drop of data and checkpoint."""
    import os
    import uuid

    from lakeops.plans.tables import TableStore
    from lakeops.session import work_dir
    from lakeops.streaming.ingest import StreamingTable
    src, target = work_dir(spark, "st-src"), work_dir(spark, "st-obj")
    store = TableStore(spark, f"stobj_{uuid.uuid4().hex[:8]}")
    spark.range(10).write.parquet(src)
    st = StreamingTable(spark, src, target, fmt="parquet", store=store, name="t", comment="it's a table")
    assert st.refresh() == 10 and store.read("t").count() == 10 and store.comment("t") == "it's a table"
    spark.range(5).write.mode("append").parquet(st.data_path)           # files that the sink's log doesn't have
    spark.range(10, 13).write.mode("append").parquet(src)
    assert st.refresh() == 3 and sorted(r.id for r in store.read("t").collect()) == list(range(13))
    assert [r.num_output_rows for r in store.history("t").orderBy("started_at").collect()] == [10, 3]
    st.drop()
    path = target.removeprefix("file:")
    assert not store.exists("t") and not os.path.exists(path)
