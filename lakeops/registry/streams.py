"""Stateful streaming queries and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.timefeat import as_instant, as_wall_clock
from lakeops.operators.search import label_centroids, vector_topk
from lakeops.registry._base import query
from lakeops.session import work_dir
from lakeops.sources.testdata import table
from lakeops.streaming.ingest import land_files
from lakeops.streaming.stateful import chained_window_counts, dedup_within_watermark, running_totals


def _events_stream(spark, sf_dir, path=None, max_files=None):
    schema = table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema)
    if path is None:
        r = r.option("pathGlobFilter", "events.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    s = r.parquet(path or sf_dir)
    return s.withColumn("ts", as_instant(s, "ts"))


def _run_to_parquet(df, name, spark, mode="append"):
    root = work_dir(spark, name)
    q = (df.writeStream.format("parquet").option("path", f"{root}/data")
         .option("checkpointLocation", f"{root}/_checkpoint").outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(f"{root}/data")


@query("stream_chained_windows", """
WITH d AS (SELECT date_trunc('day', ts) AS window_start, event_type, date_trunc('hour', ts) AS h FROM events)
SELECT window_start, window_start + INTERVAL 1 day AS window_end, event_type, count(*) AS n,
  count(DISTINCT h) AS n_inner_windows
FROM d
WHERE window_start + INTERVAL 1 day <= (SELECT max(ts) FROM events) - INTERVAL 1 hour
GROUP BY ALL
""")
def stream_chained_windows(spark, sf_dir):
    s = _events_stream(spark, sf_dir)
    out = chained_window_counts(s, "ts", "event_type", "1 hour", "1 day", "1 hour")
    res = _run_to_parquet(out, "chained-windows", spark)
    return res.select(as_wall_clock(F.col("window_start")).alias("window_start"),
                      as_wall_clock(F.col("window_end")).alias("window_end"),
                      "event_type", "n", "n_inner_windows")


@query("stream_user_running_count", """
SELECT user_id, count(*) AS n_events, round(sum(value), 4) AS total_value FROM events GROUP BY 1
""")
def stream_user_running_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    landed = land_files(events, work_dir(spark, "events-landing"), "parquet")
    s = _events_stream(spark, sf_dir, path=landed)
    root = work_dir(spark, "running-totals")

    def write_batch(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .parquet(f"{root}/data/batch={batch_id}")

    q = (running_totals(s, "user_id", "value").writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", f"{root}/_checkpoint").outputMode("update")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    emitted = spark.read.parquet(f"{root}/data")
    latest = emitted.groupBy("key").agg(F.max_by(F.struct("n_events", "total_value"), "batch_id").alias("s"))
    return latest.select(F.col("key").alias("user_id"), F.col("s.n_events").alias("n_events"),
                         F.round("s.total_value", 4).alias("total_value"))


@query("stream_dedup_watermark", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup_watermark(spark, sf_dir):
    first = _events_stream(spark, sf_dir)
    replay = _events_stream(spark, sf_dir)          # the same files delivered twice
    both = first.unionByName(replay)
    out = dedup_within_watermark(both, ["event_id"], "ts", "1 hour")
    res = _run_to_parquet(out.select("event_id", "user_id", "event_type", "ts"), "dedup", spark)
    return res.select("event_id", "user_id", "event_type")


@query("vector_topk", """
WITH u AS (SELECT label, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS x
           FROM embeddings),
c AS (SELECT label AS query_id, list(ax ORDER BY i) AS q
      FROM (SELECT label, i, avg(x) AS ax FROM u GROUP BY ALL) GROUP BY label),
s AS (SELECT c.query_id, e.vec_id,
        list_cosine_similarity(c.q, CAST(e.embedding AS DOUBLE[])) AS score FROM c, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, vec_id,
  round(score, 6) AS score FROM r WHERE rank <= 10
""")
def vector_topk_q(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    queries = label_centroids(e).select(F.col("label").cast("long").alias("query_id"), "query")
    out = vector_topk(e, queries, k=10)
    return out.withColumn("score", F.round("score", 6))
