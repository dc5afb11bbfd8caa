"""File sources, tables, keyed changes, streaming tables, incremental views and
the bronze/silver/gold dataset graph.

Raw input files are first landed by Spark from the test tables (the stand-in
for files arriving in cloud storage); every query then runs the operator over
them end to end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakeops.functions.clean import try_cast_columns
from lakeops.operators import changes
from lakeops.operators.quality import Expectation
from lakeops.plans.datasets import DatasetGraph
from lakeops.plans.tables import TableStore, lineage_lookup
from lakeops.plans.views import IncrementalAggregateView
from lakeops.registry._base import query, round_floats
from lakeops.session import work_dir
from lakeops.sources import files
from lakeops.sources.testdata import (DEST_CTE, TRAVEL_CTE, destinations, player_bronze,
                                      player_bronze_cte, table, travel_log)
from lakeops.streaming.ingest import StreamingTable, land_files


def _sf_file(sf_dir, name):
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# ---------------------------------------------------------------- file reads
@query("read_files_preview", "SELECT * FROM orders")
def read_files_preview(spark, sf_dir):
    return files.read_files(spark, _sf_file(sf_dir, "orders"))


@query("read_files_pruned", "SELECT l_orderkey, l_shipdate FROM lineitem")
def read_files_pruned(spark, sf_dir):
    return files.read_files(spark, _sf_file(sf_dir, "lineitem")).select("l_orderkey", "l_shipdate")


@query("list_files")
def list_files(spark, sf_dir):
    lst = files.list_files(spark, sf_dir, glob="*.parquet")
    return lst.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length")


@query("binary_files")
def binary_files(spark, sf_dir):
    return files.file_digests(spark, sf_dir, glob="*.parquet")


@query("csv_headerless", """
SELECT c_name AS name, c_custkey AS custkey, c_acctbal AS acctbal, c_nationkey AS nationkey
FROM customer
""")
def csv_headerless(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_acctbal", "c_nationkey")
    path = land_files(c, work_dir(spark, "customer-csv"), "csv", header=False)
    raw = files.read_csv_headerless(spark, path)
    renamed = raw.select(F.col("_c0").alias("name"), F.col("_c1").alias("custkey"),
                         F.col("_c2").alias("acctbal"), F.col("_c3").alias("nationkey"))
    return try_cast_columns(renamed, {"custkey": "bigint", "acctbal": "double", "nationkey": "int"})


@query("csv_year_from_filename", f"""
WITH {player_bronze_cte()}
SELECT id, name, value, CASE WHEN CAST(year AS INTEGER) % 2 = 0 THEN loaned_from END AS loaned_from,
  CASE WHEN CAST(year AS INTEGER) % 2 = 1 THEN wage END AS wage, CAST(year AS INTEGER) AS year
FROM bronze
""")
def csv_year_from_filename(spark, sf_dir):
    b = player_bronze(spark, sf_dir).withColumn(
        "file", F.format_string("FIFA%02d_official_data.csv", F.col("year").cast("int") - 2000))
    root = work_dir(spark, "player-csv")
    even = b.filter(F.col("year").cast("int") % 2 == 0).select("file", "id", "name", "value", "loaned_from")
    odd = b.filter(F.col("year").cast("int") % 2 == 1).select("file", "id", "wage", "name", "value")
    for sub, part in (("even", even), ("odd", odd)):
        # one directory per write and no appends: a retried job cannot duplicate files
        (part.repartition("file").write.mode("errorifexists").partitionBy("file")
         .option("header", "true").option("nullValue", "nan").csv(f"{root}/{sub}"))
    paths = [r.path for r in files.list_files(spark, root, glob="*.csv", recursive=True)
             .select("path").collect()]
    df = files.read_csv_files_by_header(spark, paths, null_value="nan",
                                        year_pattern=r"FIFA(\d+)_official_data\.csv", year_offset=2000)
    return df.select("id", "name", "value", "loaned_from", "wage", "year")


_RECORD = StructType([StructField("user_id", LongType()), StructField("ts", StringType()),
                      StructField("booking_date", StringType()), StructField("destination_id", LongType()),
                      StructField("user_latitude", DoubleType()), StructField("user_longitude", DoubleType())])


@query("json_records", f"""
WITH {TRAVEL_CTE}
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  strftime(CAST(ts AS DATE) + 14, '%Y-%m-%d') AS booking_date, CAST(destination_id AS BIGINT) AS destination_id,
  user_latitude, user_longitude FROM travel
""")
def json_records(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    rec = F.struct(F.col("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                   F.date_format(F.date_add(F.to_date("ts"), 14), "yyyy-MM-dd").alias("booking_date"),
                   F.col("destination_id").cast("bigint").alias("destination_id"),
                   "user_latitude", "user_longitude")
    # request bodies of at most two records (event ids are unique, so the
    # grouping key bounds every group to two rows)
    bodies = (log.groupBy(F.floor(F.col("event_id") / 2).alias("request_id"))
              .agg(F.to_json(F.struct(F.collect_list(rec).alias("dataframe_records"))).alias("body")))
    return files.records_to_rows(bodies, "body", _RECORD)


_RAW_TRAVEL = [("ts", "string"), ("user_id", "string"), ("destination_id", "string"),
               ("user_latitude", "string"), ("user_longitude", "string"), ("clicked", "string"),
               ("purchased", "string"), ("booking_date", "string"), ("price", "string")]
SILVER_TYPES = {"ts": "timestamp_ntz", "user_id": "int", "destination_id": "int",
                "user_latitude": "double", "user_longitude": "double", "clicked": "boolean",
                "purchased": "boolean", "booking_date": "date", "price": "double"}


def _raw_travel(log):
    """Raw purchase-log text, with malformed values mixed in."""
    bad = F.col("event_id") % 97 == 0
    return log.select(
        F.col("ts").cast("string").alias("ts"),
        F.when(F.col("event_id") % 89 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.col("destination_id").cast("string").alias("destination_id"),
        F.col("user_latitude").cast("string").alias("user_latitude"),
        F.col("user_longitude").cast("string").alias("user_longitude"),
        F.col("clicked").cast("string").alias("clicked"),
        F.when(bad, F.lit("maybe")).otherwise(F.col("purchased").cast("string")).alias("purchased"),
        F.when(bad, F.lit("someday")).otherwise(F.date_add(F.to_date("ts"), 14).cast("string"))
        .alias("booking_date"),
        F.when(bad, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"))


_SILVER_SQL = f"""WITH {TRAVEL_CTE},
silver AS (SELECT ts,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id,
  destination_id, user_latitude, user_longitude, clicked,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE purchased END AS purchased,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) + 14 END AS booking_date,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE round(price, 6) END AS price FROM travel)"""


@query("silver_cast", f"{_SILVER_SQL} SELECT * FROM silver")
def silver_cast(spark, sf_dir):
    raw = _raw_travel(travel_log(spark, sf_dir))
    return round_floats(try_cast_columns(raw, SILVER_TYPES))


# ------------------------------------------------------------- tables / DDL
@query("ctas", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'
""")
def ctas(spark, sf_dir):
    store = TableStore(spark, f"ctas_{uuid.uuid4().hex[:8]}")
    o = table(spark, sf_dir, "orders")
    src = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice",
                                                        "o_orderdate")
    # clustered layout: files hold ranges of o_orderdate, sorted within files,
    # so Parquet min/max statistics skip files on date filters
    store.write(src, "finished_orders", comment="orders with status F", cluster_by=["o_orderdate"])
    # rebuild the table from itself: the new version is written before the switch
    store.write(store.read("finished_orders"), "finished_orders")
    return store.read("finished_orders")


def _lineage_store(spark, sf_dir) -> TableStore:
    """Tables of the given orders, customers and nations, a view over two of them, and a
    table over the view and the third."""
    name = f"lineage_{uuid.uuid4().hex[:8]}"
    store = TableStore(spark, name)
    for t in ("orders", "customer", "nation"):
        store.write(table(spark, sf_dir, t), t)
    spark.sql(f"CREATE VIEW {name}.bought AS SELECT c_nationkey, o_totalprice, o_orderdate "
              f"FROM {name}.orders JOIN {name}.customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'")
    totals = store.read("bought").join(store.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .groupBy("n_name").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderdate").alias("last"))
    store.write(totals, "totals")
    store.record_column_lineage(totals, "totals")
    return store


@query("lineage_lookup", """
SELECT * FROM (
  SELECT 'customer' AS source_table_name, 'TABLE' AS entity_type, count(*) AS source_rows FROM customer
  UNION ALL SELECT 'nation', 'TABLE', count(*) FROM nation
  UNION ALL SELECT 'orders', 'TABLE', count(*) FROM orders
  UNION ALL SELECT 'bought', 'VIEW', NULL),
  (SELECT count(DISTINCT c_nationkey) AS target_rows FROM orders JOIN customer ON o_custkey = c_custkey
   WHERE o_orderstatus <> 'P')
""")
def lineage_lookup_q(spark, sf_dir):
    """The sources of a table, with the rows that the ledger holds for them and for it."""
    store = _lineage_store(spark, sf_dir)
    written = store.history().select(F.col("table_name").alias("t"), F.col("num_output_rows").alias("n"))
    of = F.concat_ws(".", "source_table_schema", "source_table_name")
    return (lineage_lookup(store, "totals")
            .join(written.withColumnsRenamed({"t": "s", "n": "source_rows"}), of == F.col("s"), "left")
            .join(written.withColumnRenamed("n", "target_rows"), F.col("target_table_full_name") == F.col("t"))
            .select("source_table_name", "entity_type", "source_rows", "target_rows"))


@query("lineage_columns", """
SELECT t.column_name AS target_column_name, c.table_name AS source_table_name, c.column_name AS source_column_name
FROM (VALUES ('n_name'), ('total'), ('last')) AS t(column_name), (
  SELECT DISTINCT table_name, column_name FROM information_schema.columns
  WHERE table_name IN ('orders', 'customer', 'nation')) c
WHERE c.column_name IN ('o_custkey', 'o_orderstatus', 'c_custkey', 'c_nationkey', 'n_nationkey', 'n_name')
  OR (t.column_name = 'total' AND c.column_name = 'o_totalprice')
  OR (t.column_name = 'last' AND c.column_name = 'o_orderdate')
""")
def lineage_columns(spark, sf_dir):
    """For each column of a table, the source columns it depends on."""
    return _lineage_store(spark, sf_dir).column_lineage("totals").select(
        "target_column_name", "source_table_name", "source_column_name")


# ------------------------------------------------------------- keyed changes
_OLD = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"
_NEW = ("SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' "
        "THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders "
        "WHERE o_orderdate >= TIMESTAMP '1996-01-01'")


def _old(o):
    return o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _new(o):
    return o.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"))


@query("merge_upsert", f"""
WITH t AS ({_OLD}), u AS ({_NEW})
SELECT coalesce(u.o_orderkey, t.o_orderkey) AS o_orderkey,
  CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey
""")
def merge_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return changes.merge_upsert(_old(o), _new(o), ["o_orderkey"])


@query("delete_by_key", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)
""")
def delete_by_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = table(spark, sf_dir, "lineitem")
    doomed = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return changes.delete_by_key(o, doomed, ["o_orderkey"])


@query("snapshot_changes", f"""
WITH o AS ({_OLD}), n AS ({_NEW})
SELECT o.*, 'delete' AS _change_type FROM o ANTI JOIN n USING (o_orderkey)
UNION ALL SELECT n.*, 'insert' FROM n ANTI JOIN o USING (o_orderkey)
UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n USING (o_orderkey)
  WHERE o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
     OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n USING (o_orderkey)
  WHERE o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
     OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
""")
def snapshot_changes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return changes.snapshot_changes(_old(o), _new(o), ["o_orderkey"])


@query("schema_evolve_union", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL AS o_orderpriority FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def schema_evolve_union(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    v1 = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    v2 = o.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", F.col("o_totalprice").alias("total_price"), "o_orderpriority", "o_custkey")
    return changes.union_schema_versions([v1, v2], renames={"total_price": "o_totalprice"})


# --------------------------------------------------- streaming tables / views
# Bytes of input of one micro-batch, at most.
_TRIGGER_BYTES = str(256 << 20)


def _landed_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return land_files(li, work_dir(spark, "lineitem-landing"), "parquet"), li.schema


@query("stream_table_ingest", "SELECT * FROM lineitem")
def stream_table_ingest(spark, sf_dir):
    src, schema = _landed_lineitem(spark, sf_dir)
    st = StreamingTable(spark, src, work_dir(spark, "st-lineitem"), fmt="parquet", schema=schema,
                        max_bytes_per_trigger=_TRIGGER_BYTES)
    st.refresh()
    st.refresh()            # a second refresh finds nothing new
    return st.read()


@query("mv_incremental_sum", """
SELECT l_suppkey, round(sum(l_extendedprice), 4) AS total_price, count(l_orderkey) AS n_lines,
  round(min(l_discount), 4) AS min_discount, round(avg(l_quantity), 6) AS avg_quantity
FROM lineitem GROUP BY ALL
""")
def mv_incremental_sum(spark, sf_dir):
    src, schema = _landed_lineitem(spark, sf_dir)
    mv = IncrementalAggregateView(
        spark, src, schema, ["l_suppkey"],
        {"total_price": ("sum", "l_extendedprice"), "n_lines": ("count", "l_orderkey"),
         "min_discount": ("min", "l_discount"), "avg_quantity": ("avg", "l_quantity")},
        work_dir(spark, "mv-lineitem"))
    mv.refresh()
    out = mv.read()
    return out.select("l_suppkey", F.round("total_price", 4).alias("total_price"), "n_lines",
                      F.round("min_discount", 4).alias("min_discount"),
                      F.round("avg_quantity", 6).alias("avg_quantity"))


@query("stream_history", """
SELECT row_number() OVER (ORDER BY k) AS run, operation, num_output_rows, 'Line items as they arrive' AS comment
FROM (SELECT 1 AS k, 'STREAMING UPDATE' AS operation, count(*) AS num_output_rows FROM lineitem WHERE l_returnflag = 'R'
      UNION ALL SELECT 2, 'STREAMING UPDATE', count(*) FROM lineitem WHERE l_returnflag <> 'R'
      UNION ALL SELECT 3, 'STREAMING UPDATE', 0)
""")
def stream_history(spark, sf_dir):
    """History and comment of a streaming table after three refreshes, the last without input."""
    li = table(spark, sf_dir, "lineitem")
    store, src = TableStore(spark, f"history_{uuid.uuid4().hex[:8]}"), work_dir(spark, "history-landing")
    st = StreamingTable(spark, src, work_dir(spark, "st-history"), fmt="parquet", schema=li.schema, store=store,
                        name="line_items", comment="Line items as they arrive")
    for part in ("l_returnflag = 'R'", "l_returnflag <> 'R'", None):
        if part:
            li.filter(part).write.mode("append").parquet(src)
        st.refresh()
    runs = store.history("line_items")
    return runs.select(F.row_number().over(Window.orderBy("started_at")).cast("long").alias("run"), "operation", "num_output_rows",
                       F.lit(store.comment("line_items")).alias("comment"))


@query("mv_over_stream_table", """
SELECT l_suppkey, count(l_orderkey) AS n_lines, round(sum(l_quantity), 4) AS quantity, round(max(l_tax), 4) AS max_tax
FROM lineitem GROUP BY ALL
""")
def mv_over_stream_table(spark, sf_dir):
    """A view over a streaming table, refreshed after each of its two refreshes; a second
    view and a second table are dropped again."""
    li = table(spark, sf_dir, "lineitem")
    store, src = TableStore(spark, f"stmv_{uuid.uuid4().hex[:8]}"), work_dir(spark, "stmv-landing")
    tables = [StreamingTable(spark, src, work_dir(spark, f"stmv-{n}"), fmt="parquet", schema=li.schema, store=store, name=n)
              for n in ("kept", "dropped")]
    views = []
    for part in ("l_linenumber % 2 = 0", "l_linenumber % 2 = 1"):
        li.filter(part).write.mode("append").parquet(src)
        for t in tables:
            t.refresh()
        views = views or [IncrementalAggregateView.over(t, ["l_suppkey"], {
            "n_lines": ("count", "l_orderkey"), "quantity": ("sum", "l_quantity"), "max_tax": ("max", "l_tax")},
            work_dir(spark, "stmv-view")) for t in tables]
        for v in views:
            v.refresh()
    views[1].drop()
    tables[1].drop()
    if store.exists("dropped") or store.read("kept").count() != li.count():
        raise AssertionError("the table's catalog entry doesn't follow it")
    return views[0].read().select("l_suppkey", "n_lines", F.round("quantity", 4).alias("quantity"),
                                  F.round("max_tax", 4).alias("max_tax"))


def _land_raw_travel(spark, sf_dir):
    raw = _raw_travel(travel_log(spark, sf_dir))
    return land_files(raw, work_dir(spark, "travel-raw"), "csv")


_RAW_SCHEMA = StructType([StructField(c, StringType()) for c, _ in _RAW_TRAVEL])


@query("stream_csv_ingest", f"""
{_SILVER_SQL}
SELECT ts, CAST(user_id AS VARCHAR) AS user_id, CAST(destination_id AS VARCHAR) AS destination_id,
  CAST(clicked AS VARCHAR) AS clicked FROM silver
""")
def stream_csv_ingest(spark, sf_dir):
    src = _land_raw_travel(spark, sf_dir)
    bronze = StreamingTable(spark, src, work_dir(spark, "st-travel-bronze"), fmt="csv",
                            schema=_RAW_SCHEMA, max_bytes_per_trigger=_TRIGGER_BYTES)
    bronze.refresh()
    b = bronze.read()
    return b.select(F.col("ts").try_cast("timestamp_ntz").alias("ts"), "user_id", "destination_id",
                    "clicked")


def _travel_graph(spark, sf_dir):
    src = _land_raw_travel(spark, sf_dir)
    dest_csv = land_files(destinations(spark, sf_dir), work_dir(spark, "dest-raw"), "csv",
                          header=False)
    store = TableStore(spark, f"travel_{uuid.uuid4().hex[:8]}")
    g = DatasetGraph(spark, store)
    g.streaming_table("trips_raw",
                      lambda g: spark.readStream.schema(_RAW_SCHEMA).option("header", "true")
                      .option("maxBytesPerTrigger", _TRIGGER_BYTES).csv(src),
                      comment="Trips as delivered, all text")
    g.streaming_table("trips_typed",
                      lambda g: try_cast_columns(g.read_stream("trips_raw"),
                                                 SILVER_TYPES),
                      expectations=[Expectation("has_user", "user_id IS NOT NULL")],
                      comment="Trips with typed columns", depends_on=["trips_raw"])
    g.live_table("places_raw",
                 lambda g: files.read_csv_headerless(spark, dest_csv).select(
                     F.col("_c0").alias("name"), F.col("_c1").alias("destination_id"),
                     F.col("_c2").alias("latitude"), F.col("_c3").alias("longitude")),
                 expectations=[Expectation("known_place", "try_cast(destination_id AS INT) > 0",
                                           "drop")])
    g.live_table("places_typed",
                 lambda g: try_cast_columns(g.read("places_raw"),
                                            {"destination_id": "int", "latitude": "double",
                                             "longitude": "double"}),
                 expectations=[Expectation("known_place", "destination_id > 0", "drop")],
                 depends_on=["places_raw"])

    def gold(g):
        p = g.read("trips_typed").alias("p")
        d = g.read("places_typed").alias("d")
        return p.join(d, F.col("p.destination_id") == F.col("d.destination_id"), "left").select(
            "p.ts", "p.user_id", F.col("p.destination_id").alias("destination_id"), "p.user_latitude",
            "p.user_longitude", F.col("d.latitude").alias("dest_latitude"),
            F.col("d.longitude").alias("dest_longitude"), "p.purchased", "p.booking_date", "p.price")

    g.live_table("trips_placed", gold,
                 expectations=[Expectation("known_place", "destination_id > 0"),
                               Expectation("paid", "price > 0")],
                 depends_on=["trips_typed", "places_typed"])
    return g


@query("stream_silver", f"{_SILVER_SQL} SELECT * FROM silver")
def stream_silver(spark, sf_dir):
    g = _travel_graph(spark, sf_dir)
    g.run(only=["trips_raw", "trips_typed"])
    return round_floats(g.read("trips_typed"))


@query("gold_join", f"""
{_SILVER_SQL}, {DEST_CTE}
SELECT p.ts, p.user_id, p.destination_id, p.user_latitude, p.user_longitude,
  d.latitude AS dest_latitude, d.longitude AS dest_longitude, p.purchased, p.booking_date, p.price
FROM silver p LEFT JOIN (SELECT * FROM dest WHERE destination_id > 0) d
  ON p.destination_id = d.destination_id
""")
def gold_join(spark, sf_dir):
    g = _travel_graph(spark, sf_dir)
    g.run()
    return round_floats(g.read("trips_placed"))
