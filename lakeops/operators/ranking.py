"""Top-k style operators.

Top-k uses ``orderBy(...).limit(k)`` (TakeOrderedAndProject: a bounded heap
per task and one merge of k rows per task), never a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k_with_others(df: DataFrame, key: str, value: str, k: int = 5,
                      others_label: str = "others") -> DataFrame:
    """Sums ``value`` per ``key``; keeps the top k keys (ties broken by key) and
    folds every other key into one ``others`` row (apart from a real key of that
    name); a NULL key is a key.

    The top-k list is k rows by construction, so joining it back is a
    broadcast of a bounded side.
    """
    totals = df.groupBy(key).agg(F.sum(value).alias(value))
    top = (totals.orderBy(F.col(value).desc_nulls_last(), F.col(key).asc()).limit(k)
           .select(F.col(key).alias("__top_key"), F.lit(True).alias("__is_top")))
    labelled = (totals.join(F.broadcast(top), totals[key].eqNullSafe(top["__top_key"]), "left")
                .select(F.when(F.col("__is_top"), F.col(key).cast("string"))
                        .otherwise(F.lit(others_label)).alias(key), "__is_top", value))
    return labelled.groupBy(key, "__is_top").agg(F.sum(value).alias(value)).select(key, value)


def top1(df: DataFrame, order: list[Column]) -> DataFrame:
    """The single first row under a total order (tie-break columns included)."""
    return df.orderBy(*order).limit(1)


def best_trial(trials: DataFrame, metric: str, higher_is_better: bool = True,
               status_col: str = "status", finished: str = "FINISHED",
               run_id: str = "run_id") -> DataFrame:
    """Best finished run by metric; ties go to the smallest run id."""
    m = F.col(metric).desc_nulls_last() if higher_is_better else F.col(metric).asc_nulls_last()
    return top1(trials.filter(F.col(status_col) == finished), [m, F.col(run_id).asc()])


def sample_rows(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """First n rows; with ``order`` the sample is reproducible."""
    return (df.orderBy(*order) if order else df).limit(n)
