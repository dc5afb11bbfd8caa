"""Readers for the parquet test tables and the views derived from them.

The travel log is a projection of ``events`` (clicks and purchases of users
towards destinations); the destination dimension is derived from ``nation``.
Both grow with the tables they are made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Number of destinations and the stand-in coordinate moduli.
N_DESTINATIONS = 25


def travel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase/click log with the silver-layer columns of the travel demo."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id",
        (F.get_json_object("props", "$.k").cast("int") % N_DESTINATIONS).alias("destination_id"),
        (F.col("event_type") == "click").alias("clicked"),
        (F.col("event_type") == "purchase").alias("purchased"),
        F.col("value").alias("price"),
        (F.col("user_id") % 90).cast("double").alias("user_latitude"),
        (F.col("user_id") % 180).cast("double").alias("user_longitude"),
    )


TRAVEL_CTE = (
    "travel AS (SELECT event_id, ts, user_id, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS destination_id, "
    "event_type = 'click' AS clicked, event_type = 'purchase' AS purchased, "
    "value AS price, CAST(user_id % 90 AS DOUBLE) AS user_latitude, "
    "CAST(user_id % 180 AS DOUBLE) AS user_longitude FROM events)"
)


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination dimension: id, name and stand-in coordinates from nation."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("name"),
        F.col("n_nationkey").alias("destination_id"),
        (F.col("n_nationkey") * 3.5 - 40).cast("double").alias("latitude"),
        (F.col("n_regionkey") * 30.25 - 60).cast("double").alias("longitude"),
    )


DEST_CTE = (
    "dest AS (SELECT n_name AS name, n_nationkey AS destination_id, "
    "CAST(n_nationkey * 3.5 - 40 AS DOUBLE) AS latitude, "
    "CAST(n_regionkey * 30.25 - 60 AS DOUBLE) AS longitude FROM nation)"
)


# Player-like bronze table: every column is text, derived from ``part`` so that
# it grows with the data.  Each entry is (column, expression); expressions use
# the SQL both Spark and DuckDB accept, except where a pair is given.
def _player_bronze_columns():
    from lakeops.operators.players import SKILL_COLUMNS
    pos = "CASE p_partkey % 3 WHEN 0 THEN 'ST' WHEN 1 THEN 'CB' ELSE 'GK' END"
    cols = [
        ("id", "CAST(p_partkey AS STRING)"),
        ("name", "p_name"),
        ("age", "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(17 + p_partkey % 20 AS STRING) END"),
        ("nationality", "p_brand"),
        ("club", "p_type"),
        ("value", "CASE WHEN p_partkey % 7 = 0 THEN '€0' WHEN p_partkey % 2 = 0 "
                  "THEN '€' || CAST(p_size AS STRING) || 'K' "
                  "ELSE '€' || CAST(p_size AS STRING) || '.5M' END"),
        ("wage", "CASE WHEN p_partkey % 2 = 0 THEN '€' || CAST(p_size * 10 AS STRING) || 'k' "
                 "ELSE '€' || CAST(p_size AS STRING) || 'K' END"),
        ("preferred_foot", "CASE WHEN p_size % 3 = 0 THEN 'Left' ELSE 'Right' END"),
        ("international_reputation", "CAST(1 + p_partkey % 5 AS STRING)"),
        ("work_rate", "CASE p_partkey % 4 WHEN 0 THEN 'High/High' WHEN 1 THEN 'Medium/Medium' "
                      "WHEN 2 THEN 'Low/Low' ELSE 'High/ Medium' END"),
        ("position", f"'<span class=\"pos\">' || {pos} || '</span>'"),
        ("best_position", pos),
        ("loaned_from", "CASE WHEN p_partkey % 5 = 0 THEN '<a href=\"/c\">' || p_brand || '</a>' "
                        "ELSE NULL END"),
        ("joined", ("date_format(date_add(DATE'2000-01-01', CAST(p_partkey % 5000 AS INT)), 'MMM d, yyyy')",
                    "strftime(DATE '2000-01-01' + CAST(p_partkey % 5000 AS INTEGER), '%b %-d, %Y')")),
        ("contract_valid_until", "CASE p_partkey % 4 WHEN 0 THEN CAST(2020 + p_size % 8 AS STRING) "
                                 "WHEN 1 THEN '2023-06-30' WHEN 2 THEN 'Jun 30, 2023' ELSE 'abcd' END"),
        ("height", "CASE p_partkey % 3 WHEN 0 THEN CAST(150 + p_size AS STRING) || 'cm' "
                   "WHEN 1 THEN CAST(5 + p_size % 2 AS STRING) || chr(39) || CAST(p_size % 12 AS STRING) "
                   "ELSE 'unknown' END"),
        ("weight", "CASE p_partkey % 3 WHEN 0 THEN CAST(60 + p_size AS STRING) || 'kg' "
                   "WHEN 1 THEN CAST(130 + p_size AS STRING) || 'lbs' ELSE '' END"),
        ("release_clause", "CASE WHEN p_partkey % 9 = 0 THEN NULL "
                           "ELSE '€' || CAST(p_size AS STRING) || '.25M' END"),
        ("year", "CAST(2017 + p_partkey % 7 AS STRING)"),
    ]
    for i, s in enumerate(SKILL_COLUMNS + ["defensiveawareness"]):
        cols.append((s, f"CASE WHEN (p_partkey + {i}) % 17 = 0 THEN NULL "
                        f"ELSE CAST((p_partkey * {i + 3} + p_size * {i + 1}) % 99 AS STRING) END"))
    return cols


def player_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(*[F.expr(e if isinstance(e, str) else e[0]).alias(n)
                      for n, e in _player_bronze_columns()])


def player_bronze_cte() -> str:
    parts = [f"{e if isinstance(e, str) else e[1]} AS {n}" for n, e in _player_bronze_columns()]
    return f"bronze AS (SELECT {', '.join(parts)} FROM part)"
