"""Tables, keyed changes, files, streaming tables, incremental views, graphs."""

import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from lakeops.operators import changes
from lakeops.operators.quality import Expectation
from lakeops.operators.search import vector_topk
from lakeops.plans.datasets import DatasetGraph
from lakeops.plans.tables import TableStore, lineage_lookup
from lakeops.plans.views import IncrementalAggregateView
from lakeops.session import work_dir
from lakeops.sources import files
from lakeops.sources.testdata import table
from lakeops.streaming.ingest import StreamingTable, land_files
from tests.conftest import SF001, rows


def test_table_store_overwrite_from_itself_and_history(spark):
    store = TableStore(spark, "t_store")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.write(df, "t", comment="demo", properties={"primary_keys": "k"}, sources=["src.raw"])
    store.write(store.read("t").filter("k = 1"), "t", sources=["t"])
    assert rows(store.read("t")) == [(1, "a")]
    hist = store.history("t").orderBy("ended_at").collect()
    assert [h.num_output_rows for h in hist] == [2, 1]
    assert store.properties("t")["primary_keys"] == "k"
    lin = lineage_lookup(store, "t").collect()
    assert {r.source_table_name for r in lin} == {"raw", "t"}
    store.drop("t")
    assert not store.exists("t")


def test_lineage_comes_from_the_plan(spark, tmp_path):
    store = TableStore(spark, "lin_plan")
    path = f"{tmp_path}/raw"
    spark.range(5).selectExpr("id AS k", "id * 2 AS v", "id AS unused").write.parquet(path)
    store.write(spark.read.parquet(path), "a")
    store.write(store.read("a").withColumnRenamed("v", "w"), "b")
    spark.sql("CREATE OR REPLACE VIEW lin_plan.seen AS SELECT k, v FROM lin_plan.a WHERE v > (SELECT min(w) FROM lin_plan.b)")
    store.write(store.read("seen").join(store.read("b"), "k").select("k", (F.col("v") + 1).alias("v1"), "w"), "c")

    def found(name):
        return {(r.source_table_schema, r.source_table_name, r.entity_type) for r in lineage_lookup(store, name).collect()}

    assert {(s, e, n.endswith("/raw")) for s, n, e in found("a")} == {(None, "PATH", True)}
    assert found("b") == {("lin_plan", "a", "TABLE")}
    assert found("c") == {("lin_plan", "a", "TABLE"), ("lin_plan", "b", "TABLE"), ("lin_plan", "seen", "VIEW")}
    frame = store.read("a").filter("k > 1").select("v", "unused")
    store.record_column_lineage(frame, "d")
    got = {(r.target_column_name, r.source_table_name, r.source_column_name) for r in store.column_lineage("d").collect()}
    assert got == {("v", "a", "v"), ("v", "a", "k"), ("unused", "a", "unused"), ("unused", "a", "k")}
    store.write(spark.createDataFrame([(1,)], "x int"), "e")
    assert found("e") == set()


def test_merge_delete_changes(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (4, "d"), (3, None)], "k int, v string")
    assert rows(changes.merge_upsert(t, u, ["k"])) == [(1, "a"), (2, "B"), (3, None), (4, "d")]
    assert rows(changes.delete_by_key(t, u, ["k"])) == [(1, "a")]
    cf = rows(changes.snapshot_changes(t, u, ["k"]))
    assert cf == sorted([(1, "a", "delete"), (2, "b", "update_preimage"), (2, "B", "update_postimage"),
                         (4, "d", "insert")], key=lambda r: tuple((x is None, str(x)) for x in r))
    ups = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, seq int, v string")
    assert rows(changes.latest_per_key(ups, ["k"], "seq")) == [(1, 2, "y")]


def test_read_csv_files_by_header(spark):
    root = tempfile.mkdtemp(prefix="lakeops-csv-")
    with open(os.path.join(root, "FIFA21_official_data.csv"), "w") as f:
        f.write("ID,Name,Value\n1,a,€1K\n2,b,nan\n")
    with open(os.path.join(root, "FIFA22_official_data.csv"), "w") as f:
        f.write("ID,Value,Club\n3,€2M,x\n")
    paths = [os.path.join(root, n) for n in sorted(os.listdir(root))]
    df = files.read_csv_files_by_header(spark, paths, "nan", r"FIFA(\d+)_official_data\.csv", 2000)
    got = sorted((r.ID, r.Name, r.Value, r.Club, r.year) for r in df.collect())
    assert got == [("1", "a", "€1K", None, 2021), ("2", "b", None, None, 2021),
                   ("3", None, "€2M", "x", 2022)]


def test_zip_and_records(spark):
    root = tempfile.mkdtemp(prefix="lakeops-zip-")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.csv", "x\n1\n")
        z.writestr("b.csv", "y\n22\n")
    with open(os.path.join(root, "data.zip"), "wb") as f:
        f.write(buf.getvalue())
    members = sorted((r.member, r.size) for r in files.expand_zip_archives(spark, root).collect())
    assert members == [("a.csv", 4), ("b.csv", 5)]
    body = spark.createDataFrame([('{"dataframe_records": [{"user_id": 1, "ts": "2024-01-01"}, '
                                   '{"user_id": 2, "ts": null}]}',)], "body string")
    out = files.records_to_rows(body, "body", spark.createDataFrame([], "user_id long, ts string").schema)
    assert rows(out) == [(1, "2024-01-01"), (2, None)]


def test_streaming_table_equals_batch_for_any_split(spark):
    li = table(spark, SF001, "lineitem")
    want = li.count()
    for n_files, per_trigger in ((1, None), (3, 1), (5, 2)):
        src = land_files(li, work_dir(spark, "land"), "parquet", n_files=n_files)
        st = StreamingTable(spark, src, work_dir(spark, "st"), "parquet", li.schema,
                            max_files_per_trigger=per_trigger)
        assert st.refresh() == want
        assert st.refresh() == 0                     # restart: nothing re-ingested
        assert st.read().count() == want
        assert st.read().exceptAll(li).count() == 0


def test_incremental_view_refresh_twice_equals_once(spark):
    li = table(spark, SF001, "lineitem")
    first = li.filter("l_orderkey % 2 = 0")
    second = li.filter("l_orderkey % 2 = 1")
    src = work_dir(spark, "mv-src")
    first.write.parquet(f"{src}/part=1")
    mv = IncrementalAggregateView(spark, src, first.schema, ["l_returnflag"],
                                  {"s": ("sum", "l_quantity"), "n": ("count", "l_quantity"),
                                   "a": ("avg", "l_quantity"), "mx": ("max", "l_quantity")},
                                  work_dir(spark, "mv"), max_files_per_trigger=1)
    mv.refresh()
    second.write.parquet(f"{src}/part=2")
    mv.refresh()
    mv.refresh()
    full = li.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("s"), F.count("l_quantity").alias("n"),
                                          F.avg("l_quantity").alias("a"), F.max("l_quantity").alias("mx"))
    norm = lambda d: sorted((r.l_returnflag, round(r.s, 6), r.n, round(r.a, 6), r.mx)
                            for r in d.collect())
    assert norm(mv.read()) == norm(full)
    mv.compact()
    assert norm(mv.read()) == norm(full)


def test_dataset_graph_order_and_metrics(spark):
    src = work_dir(spark, "graph-src")
    spark.createDataFrame([("1", "10"), (None, "5"), ("2", "x")], "user_id string, price string") \
        .write.option("header", "true").csv(src)
    store = TableStore(spark, "graph_t")
    schema = spark.createDataFrame([], "user_id string, price string").schema
    g = DatasetGraph(spark, store)
    g.live_table("gold", lambda g: g.read("silver").filter("price > 0"), depends_on=["silver"])
    g.streaming_table("silver", lambda g: g.read_stream("bronze").select(
        F.col("user_id").try_cast("int").alias("user_id"), F.col("price").try_cast("double").alias("price")),
        expectations=[Expectation("valid_user", "user_id IS NOT NULL")], depends_on=["bronze"])
    g.streaming_table("bronze", lambda g: spark.readStream.schema(schema).option("header", "true").csv(src))
    assert g.order() == ["bronze", "silver", "gold"]
    m = g.run()
    assert m["silver"]["valid_user_violations"] == 1 and m["silver"]["total_rows"] == 3
    assert rows(g.read("gold")) == [(1, 10.0), (None, 5.0)]


def test_vector_topk_matches_numpy_and_chunks(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(60, 8)).astype("float32")
    qs = rng.normal(size=(7, 8))
    V = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    Q = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(qs)], "query_id long, query array<double>")
    vn = vecs.astype(float) / np.linalg.norm(vecs.astype(float), axis=1, keepdims=True)
    qn = qs / np.linalg.norm(qs, axis=1, keepdims=True)
    want = {(qi, r, int(vi)) for qi in range(7)
            for r, vi in enumerate(np.lexsort((np.arange(60), -(vn @ qn[qi])))[:5], start=1)}
    for limit in (100, 3):                              # one pass / several passes
        got = {(r.query_id, r.rank, r.vec_id) for r in
               vector_topk(V.repartition(4), Q, k=5, max_broadcast_queries=limit).collect()}
        assert got == want


def test_feature_store_keys_and_lookups(spark):
    import pytest
    from lakeops.plans.features import FeatureStore, KeyViolation
    fs = FeatureStore(TableStore(spark, "fs_t"))
    feats = spark.createDataFrame([(1, 2020, 0.5), (2, 2020, 0.7)], "id long, year long, score double")
    info = fs.create_table("skills", ["id", "year"], feats, description="skill scores")
    assert info.primary_keys == ["id", "year"] and info.features == ["score"]
    with pytest.raises(KeyViolation):
        fs.write_table("skills", feats.unionByName(feats))
    fs.write_table("skills", spark.createDataFrame([(2, 2020, 0.9), (3, 2020, 0.1)],
                                                   "id long, year long, score double"), mode="merge")
    assert rows(fs.read_table("skills")) == [(1, 2020, 0.5), (2, 2020, 0.9), (3, 2020, 0.1)]
    labels = spark.createDataFrame([(1, 2020, 10.0), (4, 2020, 1.0)], "id long, year long, value double")
    ts = fs.create_training_set(labels, [fs.lookup("skills", ["id", "year"])], label="value")
    assert rows(ts) == [(1, 2020, 0.5, 10.0), (4, 2020, None, 1.0)]
    empty = fs.create_table("later", "id", schema=feats.schema, timestamp_keys="year")
    assert empty.timestamp_keys == ["year"]
    fs.drop_table("later")
