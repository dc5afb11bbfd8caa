"""Keyed tables: merge by touched files, the change feed as a stream, a view over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.plans.keyed import ChangeFedView, KeyedTable
from lakeops.registry._base import query
from lakeops.session import work_dir
from lakeops.sources.testdata import table

_ROWS_PER_FILE = 500

# Stand-in changes of the orders table, three versions: prices of the lowest hundredth of
# keys rise and as many new keys come in; one priority of one status goes; statuses move.
_V0 = "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"
_U1 = """SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice * 2 AS o_totalprice, cents * 2 AS cents FROM v0
  WHERE o_orderkey <= (SELECT max(o_orderkey) // 100 FROM v0)
  UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) FROM v0) + 1, o_custkey, o_orderpriority, o_totalprice, cents FROM v0
  WHERE o_orderkey <= (SELECT max(o_orderkey) // 100 FROM v0)"""
_CTES = f"""v0 AS ({_V0}), u1 AS ({_U1}),
v1 AS (SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u1) UNION ALL SELECT * FROM u1),
v2 AS (SELECT * FROM v1 WHERE NOT (o_orderpriority = '1-URGENT' AND o_custkey % 5 = 0)),
u3 AS (SELECT o_orderkey, o_custkey, '5-LOW' AS o_orderpriority, o_totalprice, cents FROM v2 WHERE o_custkey % 7 = 0),
v3 AS (SELECT * FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u3) UNION ALL SELECT * FROM u3)"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def _created(spark, sf_dir):
    return KeyedTable(spark, work_dir(spark, "keyed-orders"), ["o_orderkey"], _ROWS_PER_FILE).create(_orders(spark, sf_dir))


def _first(t):
    rows = t.read()
    top = rows.agg(F.max("o_orderkey")).first()[0] or 0
    low = rows.filter(F.col("o_orderkey") <= top // 100)
    t.merge(low.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("cents", F.col("cents") * 2)
            .unionByName(low.withColumn("o_orderkey", F.col("o_orderkey") + top + 1)))


def _second(t):
    t.delete(t.read().filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 5 == 0)))


def _third(t):
    t.merge(t.read().filter(F.col("o_custkey") % 7 == 0).withColumn("o_orderpriority", F.lit("5-LOW")))


@query("merge_touched_files", f"""
WITH {_CTES}
SELECT o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 4) AS o_totalprice, cents FROM v1
""")
def merge_touched_files(spark, sf_dir):
    t = _created(spark, sf_dir)
    _first(t)
    return t.read().withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("merge_rewritten_share", f"""
WITH {_CTES}, n AS (SELECT (SELECT count(*) FROM v0) AS before, (SELECT count(*) FROM v1) AS after,
                           (SELECT count(*) FROM u1) AS changed)
SELECT after AS n_rows, true AS all_counted,
  -- updated rows lie in the lowest files: theirs, one more file and the new rows are written
  true AS few_rewritten FROM n
""")
def merge_rewritten_share(spark, sf_dir):
    """Rows of the version after the merge, whether its files account for all of them, and
    whether no more rows were rewritten than the changed ones and two files besides."""
    t = _created(spark, sf_dir)
    own = t.file_rows(t.read().count())
    _first(t)
    new, n_changed = F.col("added") == 1, t.changes().filter("_change_type <> 'update_preimage'").count()
    counted = t.manifest().agg(F.sum("rows").alias("n_rows"), F.sum(F.when(new, F.col("rows"))).alias("written"))
    return counted.select("n_rows", (F.col("n_rows") == F.lit(t.read().count())).alias("all_counted"),
                          (F.col("written") <= F.lit(n_changed + 2 * own)).alias("few_rewritten"))


def _feed_sql(version, old, new):
    cols = "o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 4) AS o_totalprice, cents"
    differ = "(a.o_custkey, a.o_orderpriority, a.o_totalprice, a.cents) IS DISTINCT FROM (b.o_custkey, b.o_orderpriority, b.o_totalprice, b.cents)"
    both = f"(SELECT a.o_orderkey FROM {old} a JOIN {new} b USING (o_orderkey) WHERE {differ})"
    return " UNION ALL ".join(f"SELECT {cols}, '{kind}' AS _change_type, CAST({version} AS INTEGER) AS _commit_version FROM {side} WHERE {where}"
                              for kind, side, where in (
        ("insert", new, f"o_orderkey NOT IN (SELECT o_orderkey FROM {old})"),
        ("delete", old, f"o_orderkey NOT IN (SELECT o_orderkey FROM {new})"),
        ("update_preimage", old, f"o_orderkey IN {both}"), ("update_postimage", new, f"o_orderkey IN {both}")))


@query("change_stream", f"""
WITH {_CTES} {_feed_sql(1, 'v0', 'v1')} UNION ALL {_feed_sql(2, 'v1', 'v2')} UNION ALL {_feed_sql(3, 'v2', 'v3')}
""")
def change_stream(spark, sf_dir):
    """The feed of three versions, followed by a stream that stops after the first and is
    started again after the third."""
    t, out = _created(spark, sf_dir), work_dir(spark, "change-stream")

    def follow():
        q = (t.changes_stream().writeStream.format("parquet").option("path", f"{out}/data")
             .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    _first(t)
    follow()
    _second(t)
    _third(t)
    follow()
    return spark.read.parquet(f"{out}/data").withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("mv_over_changes", f"""
WITH {_CTES}
SELECT o_orderpriority, o_custkey % 100 AS grp, CAST(sum(cents) AS BIGINT) AS cents, count(o_orderkey) AS n, avg(cents) AS avg_cents,
  round(sum(o_totalprice), 4) AS price, round(min(o_totalprice), 4) AS least, round(max(o_totalprice), 4) AS greatest
FROM v3 GROUP BY ALL
""")
def mv_over_changes(spark, sf_dir):
    rows = _orders(spark, sf_dir).withColumn("grp", F.col("o_custkey") % 100)
    t = KeyedTable(spark, work_dir(spark, "keyed-orders"), ["o_orderkey"], _ROWS_PER_FILE).create(rows)
    view = ChangeFedView(t, ["o_orderpriority", "grp"], {
        "cents": ("sum", "cents"), "n": ("count", "o_orderkey"), "avg_cents": ("avg", "cents"), "price": ("sum", "o_totalprice"),
        "least": ("min", "o_totalprice"), "greatest": ("max", "o_totalprice")}, work_dir(spark, "keyed-view")).create()
    _first(t)
    view.refresh()
    _second(t)
    _third(t)
    view.refresh()
    return view.read().select("o_orderpriority", "grp", "cents", "n", "avg_cents",
                              *[F.round(c, 4).alias(c) for c in ("price", "least", "greatest")])
