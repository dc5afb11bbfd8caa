"""Monitoring over time windows: quality metrics, drift, usage, SLOs, forecasts.

All operators aggregate first (partial aggregation, output sized by
windows x slices) and only then compare windows, so no task ever holds the raw
rows of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: floor for empty category shares in the stability index.
PSI_EPSILON = 1e-6


def window_quality_metrics(df: DataFrame, ts: str, value: str, slice_col: str | None = None,
                           window: str = "1 day", actor: str | None = None) -> DataFrame:
    """Row count, NULL rate, min/max/mean of ``value`` and distinct actors per
    tumbling window (and slice)."""
    keys = [F.window(F.col(ts), window).alias("w")] + ([F.col(slice_col)] if slice_col else [])
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(value).isNull()).alias("n_null_value"),
            F.min(value).alias("min_value"), F.max(value).alias("max_value"),
            F.avg(value).alias("mean_value")]
    if actor:
        aggs.append(F.count_distinct(actor).alias("n_actors"))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *([slice_col] if slice_col else []),
                      *[c for c in out.columns if c not in ("w", slice_col)])


def category_drift(df: DataFrame, period: str, category: str, value: str | None = None) -> DataFrame:
    """Population stability index of ``category`` shares between consecutive
    periods, plus change of the NULL rate and mean of ``value``.

    PSI = sum((p - q) * ln(p / q)) over categories, shares floored at 1e-6.
    """
    counts = df.groupBy(period, category).agg(F.count(F.lit(1)).alias("n"))
    shares = counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(period)))
    # the period list is tiny (one row per period), so ordering it globally is cheap
    order = Window.orderBy(period)
    link = counts.select(period).distinct().select(
        period, F.lead(period).over(order).alias("__next"), F.lag(period).over(order).alias("__prev"))
    prev = (shares.join(link.select(period, "__next"), period).filter(F.col("__next").isNotNull())
            .select(F.col("__next").alias(period), category, F.col("p").alias("q")))
    cur = (shares.join(link.select(period, "__prev"), period).filter(F.col("__prev").isNotNull())
           .select(period, category, "p"))
    # full join: a category missing on one side has share 0 there
    both = cur.join(prev, [period, category], "full")
    p = F.greatest(F.coalesce(F.col("p"), F.lit(0.0)), F.lit(PSI_EPSILON))
    q = F.greatest(F.coalesce(F.col("q"), F.lit(0.0)), F.lit(PSI_EPSILON))
    psi = both.groupBy(period).agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    if value is None:
        return psi
    stats = df.groupBy(period).agg(
        (F.count_if(F.col(value).isNull()) / F.count(F.lit(1))).alias("null_rate"),
        F.avg(value).alias("mean_value"))
    stats = stats.withColumn("null_rate_delta", F.col("null_rate") - F.lag("null_rate").over(order)) \
        .withColumn("mean_delta", F.col("mean_value") - F.lag("mean_value").over(order))
    return psi.join(stats, period).select(period, "psi", "null_rate_delta", "mean_delta")


def daily_usage(df: DataFrame, ts: str, actor: str, amount: str) -> DataFrame:
    """Per day: events, distinct actors, summed amount."""
    return (df.groupBy(F.to_date(ts).alias("day"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct(actor).alias("n_actors"),
                 F.sum(amount).alias("total_amount")))


def audit_counts(df: DataFrame, action: str, actor: str, ts: str) -> DataFrame:
    """Per action: events, distinct actors, first and last time."""
    return df.groupBy(action).agg(F.count(F.lit(1)).alias("n_events"),
                                  F.count_distinct(actor).alias("n_actors"),
                                  F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def slo_error_ratio(df: DataFrame, ts: str, is_error, objective: float = 0.99) -> DataFrame:
    """Per day: requests, errors, error ratio and whether the objective held."""
    err = F.expr(is_error) if isinstance(is_error, str) else is_error
    out = df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if(err).alias("n_errors"))
    ratio = F.col("n_errors") / F.col("n_requests")
    return out.withColumn("error_ratio", ratio).withColumn("slo_met", (1 - ratio) >= objective)


def latency_quantile(df: DataFrame, ts: str, value: str, q: float = 0.95,
                     accuracy: int = 10000) -> DataFrame:
    """Per day approximate quantile (bounded memory per group)."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.percentile_approx(value, q, accuracy).alias(f"p{int(q * 100)}"))


def linear_forecast(daily: DataFrame, key: str, day: str, value: str, horizon: int = 7,
                    weekday_effect: bool = True) -> DataFrame:
    """Per key: least-squares trend over day numbers plus, optionally, the
    mean residual of each weekday, projected ``horizon`` days past the key's
    last day.  The fit is one aggregate per key (regr_slope / regr_intercept
    merge from partials); the weekday effects one aggregate per (key, weekday)."""
    x = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("double")
    y = F.col(value).cast("double")
    fit = daily.groupBy(key).agg(F.regr_slope(y, x).alias("slope"),
                                 F.regr_intercept(y, x).alias("intercept"),
                                 F.max(day).alias("__last"))
    future = fit.select(key, "slope", "intercept", "__last",
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    fday = F.date_add(F.col("__last"), F.col("h"))
    fx = F.datediff(fday, F.lit("1970-01-01").cast("date")).cast("double")
    out = future.select(key, fday.alias(day), (F.col("intercept") + F.col("slope") * fx).alias("trend"))
    if not weekday_effect:
        return out.select(key, day, F.col("trend").alias("forecast"))
    resid = (daily.join(fit, key)
             .select(key, F.weekday(day).alias("__wd"),
                     (y - (F.col("intercept") + F.col("slope") * x)).alias("__r")))
    effect = resid.groupBy(key, "__wd").agg(F.avg("__r").alias("__e"))
    return (out.withColumn("__wd", F.weekday(day)).join(effect, [key, "__wd"], "left")
            .select(key, day, (F.col("trend") + F.coalesce(F.col("__e"), F.lit(0.0))).alias("forecast")))
