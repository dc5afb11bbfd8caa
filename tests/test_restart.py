"""Interrupted and retried work: checkpoints make results exactly-once."""

import time

from pyspark.sql import functions as F

from lakeops.plans.views import IncrementalAggregateView
from lakeops.session import work_dir
from lakeops.sources.testdata import table
from lakeops.streaming.ingest import StreamingTable, land_files
from tests.conftest import SF001


def test_streaming_table_resumes_after_stop(spark):
    li = table(spark, SF001, "lineitem")
    src = land_files(li, work_dir(spark, "r-src"), "parquet", n_files=4)
    st = StreamingTable(spark, src, work_dir(spark, "r-st"), "parquet", li.schema, max_files_per_trigger=1)
    # a run that dies after its first micro-batch
    q = (st.stream().writeStream.format("parquet").option("path", st.data_path)
         .option("checkpointLocation", st.checkpoint).trigger(processingTime="2 seconds").start())
    for _ in range(600):
        if q.lastProgress and q.lastProgress["numInputRows"] > 0:
            break
        time.sleep(0.05)
    q.stop()
    partial = spark.read.parquet(st.data_path).count()
    assert 0 < partial < li.count()
    st.refresh()                                   # restart from the checkpoint
    out = st.read()
    assert out.count() == li.count()
    assert out.exceptAll(li).count() == 0 and li.exceptAll(out).count() == 0


def test_incremental_view_batch_retry_replaces_itself(spark):
    li = table(spark, SF001, "lineitem")
    src = land_files(li, work_dir(spark, "r-mv-src"), "parquet", n_files=2)
    mv = IncrementalAggregateView(spark, src, li.schema, ["l_returnflag"],
                                  {"s": ("sum", "l_quantity"), "n": ("count", "l_quantity")},
                                  work_dir(spark, "r-mv"))
    batch = li.filter("l_linenumber = 1")
    mv._write_batch(batch, 0)
    mv._write_batch(batch, 0)                      # the same batch retried
    got = {r.l_returnflag: (round(r.s, 6), r.n) for r in mv.read().collect()}
    want = {r.l_returnflag: (round(r.s, 6), r.n) for r in batch.groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("s"), F.count("l_quantity").alias("n")).collect()}
    assert got == want
