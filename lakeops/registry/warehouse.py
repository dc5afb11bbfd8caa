"""Warehouse SQL, ranking, expectations, profiles and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import monitor, quality, ranking, security, udfs
from lakeops.registry._base import query, round_floats
from lakeops.sources.testdata import TRAVEL_CTE, table, travel_log


@query("count_all", "SELECT count(1) AS n_rows FROM lineitem")
def count_all(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sum_group_by_all", """
SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_revenue
FROM lineitem GROUP BY ALL
""")
def sum_group_by_all(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem_v")
    return spark.sql("SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) "
                     "AS net_revenue FROM lineitem_v GROUP BY ALL")


@query("filter_eq", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice >= 100000
""")
def filter_eq(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                     & (F.col("o_totalprice") >= 100000))
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@query("sample_limit", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10
""")
def sample_limit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ranking.sample_rows(o, 10, ["o_orderdate", "o_orderkey"])


_TRIALS = ("trials AS (SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' "
           "WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status, "
           "round(o_totalprice / 1000, 3) AS metric FROM orders)")


@query("best_trial", f"""
WITH {_TRIALS}
SELECT run_id, status, metric FROM trials WHERE status = 'FINISHED'
ORDER BY metric DESC NULLS LAST, run_id LIMIT 1
""")
def best_trial(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    trials = o.select(
        F.col("o_orderkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED").alias("status"),
        F.round(F.col("o_totalprice") / 1000, 3).alias("metric"))
    return ranking.best_trial(trials, "metric")


@query("top_k_with_others", """
WITH t AS (SELECT o_custkey, sum(o_totalprice) AS revenue FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, o_custkey) AS rn FROM t)
SELECT CASE WHEN rn <= 5 THEN CAST(o_custkey AS VARCHAR) ELSE 'others' END AS o_custkey,
  round(sum(revenue), 2) AS revenue FROM r GROUP BY 1
""")
def top_k_with_others(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out = ranking.top_k_with_others(o, "o_custkey", "o_totalprice", k=5)
    return out.select("o_custkey", F.round("o_totalprice", 2).alias("revenue"))


_NATION_YEAR = """nation_sales AS (
  SELECT n.n_name AS brand,
    CAST(trunc(sum(CASE WHEN year(o.o_orderdate) = 2000 THEN o.o_totalprice END)) AS BIGINT) AS us_sales,
    round(100 * (sum(CASE WHEN year(o.o_orderdate) = 2000 THEN o.o_totalprice END)
       / sum(CASE WHEN year(o.o_orderdate) = 1999 THEN o.o_totalprice END) - 1), 4)
       AS sales_change_percentage
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1)"""


def _nation_sales(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    y = F.year("o_orderdate")
    s2000 = F.sum(F.when(y == 2000, F.col("o_totalprice")))
    s1999 = F.sum(F.when(y == 1999, F.col("o_totalprice")))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("brand"))
            .agg(s2000.cast("bigint").alias("us_sales"),
                 F.round(100 * (s2000 / s1999 - 1), 4).alias("sales_change_percentage")))


@query("top1_growth", f"""
WITH {_NATION_YEAR}
SELECT brand, sales_change_percentage FROM nation_sales
ORDER BY sales_change_percentage DESC NULLS LAST, brand LIMIT 1
""")
def top1_growth(spark, sf_dir):
    s = _nation_sales(spark, sf_dir)
    return ranking.top1(s.select("brand", "sales_change_percentage"),
                        [F.col("sales_change_percentage").desc_nulls_last(), F.col("brand")])


@query("previous_sales", f"""
WITH {_NATION_YEAR}
SELECT brand, us_sales, sales_change_percentage,
  CAST(trunc(us_sales / (1 + sales_change_percentage / 100)) AS BIGINT) AS "2021_sales",
  CAST(trunc(us_sales / (1 + sales_change_percentage / 100)) AS BIGINT) AS native_2021_sales
FROM nation_sales
""")
def previous_sales(spark, sf_dir):
    udfs.register_previous_sales(spark)
    _nation_sales(spark, sf_dir).createOrReplaceTempView("car_sales_v")
    return spark.sql(
        "SELECT brand, us_sales, sales_change_percentage, "
        "previous_sales(us_sales, sales_change_percentage) AS `2021_sales` FROM car_sales_v"
    ).withColumn("native_2021_sales",
                 udfs.previous_sales_expr("us_sales", "sales_change_percentage"))


@query("enrich_left_join", """
SELECT c.c_custkey, c.c_name, c.c_acctbal, n.n_name AS nation, r.r_name AS region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def enrich_left_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # dimensions are joined without hints: the planner broadcasts them when
    # their measured size is under the broadcast threshold, else shuffles
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, n.n_regionkey == r.r_regionkey, "left")
            .select("c_custkey", "c_name", "c_acctbal", F.col("n_name").alias("nation"),
                    F.col("r_name").alias("region")))


@query("row_col_security", """
SELECT c_custkey, sha256(c_name) AS c_name, floor(c_acctbal / 1000) * 1000 AS c_acctbal,
  c_mktsegment, c_nationkey
FROM customer WHERE c_nationkey IN (1, 2, 3, 5, 8, 13) AND c_mktsegment <> 'BUILDING'
""")
def row_col_security(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal",
                                                "c_mktsegment", "c_nationkey")
    return security.secure_view(
        c, F.col("c_nationkey").isin(1, 2, 3, 5, 8, 13) & (F.col("c_mktsegment") != "BUILDING"),
        {"c_name": security.hash_mask("c_name"),
         "c_acctbal": security.round_mask("c_acctbal", 1000).cast("double")})


@query("verify_range", """
SELECT coalesce(bool_and(l_discount BETWEEN 0 AND 0.1), true) AS l_discount_in_range,
  coalesce(bool_and(l_tax BETWEEN -100 AND 100), true) AS l_tax_in_range,
  coalesce(bool_and(l_quantity BETWEEN 1 AND 10), true) AS l_quantity_in_range
FROM lineitem
""")
def verify_range(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return quality.verify_ranges(li, {"l_discount": (0, 0.1), "l_tax": (-100, 100),
                                      "l_quantity": (1, 10)})


@query("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def pk_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return quality.primary_key_violations(li, ["l_orderkey", "l_linenumber"])


@query("expect_drop", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
WHERE coalesce(o_totalprice > 50000 AND o_orderstatus <> 'P', false)
""")
def expect_drop(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    out, _ = quality.apply_expectations(o, [
        quality.Expectation("valid_order", "o_totalprice > 50000 AND o_orderstatus <> 'P'", "drop")])
    return out


@query("expect_keep_metrics", f"""
WITH {TRAVEL_CTE}
SELECT count(1) AS total_rows,
  count_if(NOT coalesce(destination_id > 0, false)) AS valid_destination_violations,
  count_if(NOT coalesce(price > 5, false)) AS valid_price_violations,
  count_if(NOT coalesce(user_id IS NOT NULL, false)) AS valid_user_violations
FROM travel
""")
def expect_keep_metrics(spark, sf_dir):
    log = travel_log(spark, sf_dir)
    exps = [quality.Expectation("valid_destination", "destination_id > 0"),
            quality.Expectation("valid_price", "price > 5"),
            quality.Expectation("valid_user", "user_id IS NOT NULL")]
    return quality.expectation_report(log, exps)


_PATTERN_SQL = ", ".join(
    f"('{c}', '{tag}', count_if(regexp_matches({c}, '{pat}')))"
    for c in ("text", "lang", "source") for tag, pat in quality.CLASSIFY_PATTERNS.items())


@query("classify_columns", f"""
WITH a AS (SELECT count(*) AS n_rows,
  [{_PATTERN_SQL}] AS m FROM documents),
u AS (SELECT n_rows, unnest(m) AS s FROM a)
SELECT s[1] AS column_name, s[2] AS tag, CAST(s[3] AS BIGINT) AS n_match, n_rows,
  round(CAST(s[3] AS DOUBLE) / n_rows, 6) AS share FROM u
""")
def classify_columns(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return quality.classify_columns(d, ["text", "lang", "source"])


def _profile_sql() -> str:
    cols = [("o_orderkey", True, False), ("o_custkey", True, False), ("o_orderstatus", False, True),
            ("o_totalprice", True, False), ("o_orderdate", False, False),
            ("o_orderpriority", False, True)]
    parts = []
    for c, num, txt in cols:
        mn = f"round(CAST(min({c}) AS DOUBLE), 6)" if num else "CAST(NULL AS DOUBLE)"
        mx = f"round(CAST(max({c}) AS DOUBLE), 6)" if num else "CAST(NULL AS DOUBLE)"
        me = f"round(avg({c}), 6)" if num else "CAST(NULL AS DOUBLE)"
        top = (f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders "
               f"WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)") if txt else "NULL"
        topn = (f"(SELECT max(n) FROM (SELECT count(*) AS n FROM orders WHERE {c} IS NOT NULL "
                f"GROUP BY {c}))") if txt else "NULL"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count_if({c} IS NULL) AS n_nulls, "
            f"count(DISTINCT {c}) AS n_distinct, {mn} AS min_value, {mx} AS max_value, "
            f"{me} AS mean_value, {top} AS top_value, CAST({topn} AS BIGINT) AS top_count FROM orders")
    return " UNION ALL ".join(parts)


@query("column_profile", _profile_sql())
def column_profile(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "orders"), exact=True)


def _tops_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS top_value, count(*) AS top_count FROM documents "
        f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 3 DESC, 2 LIMIT 1)" for c in ("text", "lang", "source"))


@query("column_top_values", _tops_sql())
def column_top_values(spark, sf_dir):
    """The most frequent value of each text column of the documents, whole texts
    included, by sketch, exact recount and, where the sketch settles nothing, all counts."""
    docs = table(spark, sf_dir, "documents")
    return quality.column_profile(docs.select("text", "lang", "source")).select("column_name", "top_value", "top_count")


_EVENTS_DAY = "e AS (SELECT *, CAST(ts AS DATE) AS day FROM events)"


@query("window_quality_metrics", """
SELECT time_bucket(INTERVAL 1 day, ts) AS window_start,
  time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end, event_type,
  count(*) AS n_rows, count_if(value IS NULL) AS n_null_value,
  round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
  round(avg(value), 6) AS mean_value, count(DISTINCT user_id) AS n_actors
FROM events GROUP BY 1, 2, 3
""")
def window_quality_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return round_floats(monitor.window_quality_metrics(e, "ts", "value", "event_type",
                                                       "1 day", actor="user_id"))


@query("drift_metrics", f"""
WITH {_EVENTS_DAY},
c AS (SELECT day, event_type, count(*) AS n FROM e GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY day) AS p FROM c),
d AS (SELECT DISTINCT day FROM c),
l AS (SELECT day, lead(day) OVER (ORDER BY day) AS nxt, lag(day) OVER (ORDER BY day) AS prv FROM d),
prev AS (SELECT l.nxt AS day, s.event_type, s.p AS q FROM s JOIN l USING (day) WHERE l.nxt IS NOT NULL),
cur AS (SELECT s.day, s.event_type, s.p FROM s JOIN l USING (day) WHERE l.prv IS NOT NULL),
b AS (SELECT coalesce(cur.day, prev.day) AS day, greatest(coalesce(p, 0), 1e-6) AS p,
        greatest(coalesce(q, 0), 1e-6) AS q
      FROM cur FULL JOIN prev ON cur.day = prev.day AND cur.event_type = prev.event_type),
psi AS (SELECT day, sum((p - q) * ln(p / q)) AS psi FROM b GROUP BY day),
st AS (SELECT day, count_if(value IS NULL) / count(*) AS null_rate, avg(value) AS mean_value
       FROM e GROUP BY day),
st2 AS (SELECT day, null_rate - lag(null_rate) OVER (ORDER BY day) AS null_rate_delta,
        mean_value - lag(mean_value) OVER (ORDER BY day) AS mean_delta FROM st)
SELECT day, round(psi, 6) AS psi, round(null_rate_delta, 6) AS null_rate_delta,
  round(mean_delta, 6) AS mean_delta FROM psi JOIN st2 USING (day)
""")
def drift_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return round_floats(monitor.category_drift(e, "day", "event_type", "value"))


@query("usage_daily", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, count(DISTINCT user_id) AS n_actors,
  round(sum(value), 4) AS total_amount FROM events GROUP BY 1
""")
def usage_daily(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = monitor.daily_usage(e, "ts", "user_id", "value")
    return out.withColumn("total_amount", F.round("total_amount", 4))


@query("audit_counts", """
SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_actors,
  min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1
""")
def audit_counts(spark, sf_dir):
    return monitor.audit_counts(table(spark, sf_dir, "events"), "event_type", "user_id", "ts")


@query("slo_error_ratio", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_requests, count_if(event_type = 'error') AS n_errors,
  round(count_if(event_type = 'error') / count(*), 6) AS error_ratio,
  (1 - count_if(event_type = 'error') / count(*)) >= 0.8 AS slo_met
FROM events GROUP BY 1
""")
def slo_error_ratio(spark, sf_dir):
    out = monitor.slo_error_ratio(table(spark, sf_dir, "events"), "ts", "event_type = 'error'", 0.8)
    return round_floats(out)


@query("usage_forecast", f"""
WITH {_EVENTS_DAY},
d AS (SELECT event_type, day, count(*) AS n FROM e GROUP BY ALL),
f AS (SELECT event_type, regr_slope(n, CAST(day - DATE '1970-01-01' AS DOUBLE)) AS slope,
        regr_intercept(n, CAST(day - DATE '1970-01-01' AS DOUBLE)) AS intercept, max(day) AS last
      FROM d GROUP BY 1),
w AS (SELECT d.event_type, isodow(d.day) - 1 AS wd,
        avg(n - (intercept + slope * CAST(d.day - DATE '1970-01-01' AS DOUBLE))) AS effect
      FROM d JOIN f USING (event_type) GROUP BY 1, 2),
h AS (SELECT *, unnest(range(1, 8)) AS h FROM f),
p AS (SELECT event_type, CAST(last + CAST(h AS INTEGER) AS DATE) AS day,
        intercept + slope * CAST((last + CAST(h AS INTEGER)) - DATE '1970-01-01' AS DOUBLE) AS trend FROM h)
SELECT p.event_type, p.day, round(trend + coalesce(w.effect, 0), 4) AS forecast
FROM p LEFT JOIN w ON p.event_type = w.event_type AND isodow(p.day) - 1 = w.wd
""")
def usage_forecast(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    daily = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = monitor.linear_forecast(daily, "event_type", "day", "n", horizon=7)
    return out.withColumn("forecast", F.round("forecast", 4))
