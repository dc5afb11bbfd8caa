"""Keyed table changes: upsert, delete, change feed between snapshots, reads
across schema versions.

Each produces a new snapshot DataFrame (written as a new table version by
``TableStore``; ``plans.keyed`` rewrites only the files that an update touches).
Joins are on the full key; both sides shuffle once on it and AQE splits skewed key
partitions.  Rows with a NULL key match nothing; a number from their values deals
them over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_differs(cols: list[str], left: str, right: str) -> Column:
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return diff


def latest_per_key(updates: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``, NULL lowest,
    ties to the greatest other columns (an aggregate, so a hot key is reduced
    map-side)."""
    others = [c for c in updates.columns if c not in keys]
    agg = updates.groupBy(*keys).agg(F.max(F.struct(F.col(order_col).alias("__o"), F.struct(*others).alias("__v"))).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.__v.`{c}`").alias(c) for c in others])


def _spread(keys: list[str], cols: list[str]) -> Column:
    """0 where all keys are given, else a number from the whole row: part of the join
    key, so that rows with a NULL key don't meet in one task."""
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(f"`{k}`").isNull()
    return F.when(empty, F.xxhash64(*[F.col(f"`{c}`") for c in cols])).otherwise(F.lit(0).cast("long"))


def _same_key(keys: list[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`") for k in keys] + [
        F.col(f"{left}.__spread") == F.col(f"{right}.__spread")]


def merge_upsert(target: DataFrame, updates: DataFrame, keys: list[str],
                 delete_condition: str | None = None) -> DataFrame:
    """``MERGE``: matched rows take the update's values, unmatched updates are
    inserted, other target rows are kept.  ``updates`` must be unique on the
    keys (see ``latest_per_key``); several for one key end the job that reads the
    result (counted on the way into the join, not in a pass of its own).  Rows of the
    update matching ``delete_condition`` delete the target row instead."""
    cols = target.columns
    t = target.withColumn("__spread", _spread(keys, cols)).alias("t")
    u = updates.select(*cols).withColumn("__spread", _spread(keys, cols))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__spread"))
    several = F.raise_error(F.lit(f"several updates for one key {keys}"))
    u = u.withColumn("__u", F.when((n > 1) & (F.col("__spread") == 0), several.cast("boolean")).otherwise(F.lit(True))).alias("u")
    j = t.join(u, _same_key(keys, "t", "u"), "full")
    has_u = F.col("u.__u").isNotNull()
    out = j.select(*[F.when(has_u, F.col(f"u.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
                     for c in cols], has_u.alias("__has_u"),
                   *([F.expr(delete_condition).alias("__del")]
                     if delete_condition else []))
    if delete_condition:
        out = out.filter(~(F.col("__has_u") & F.coalesce(F.col("__del"), F.lit(False))))
    return out.select(*cols)


def delete_by_key(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE WHERE key IN (...)`` (also erasure requests): anti join."""
    return target.join(doomed.select(*keys).distinct(), on=keys, how="left_anti")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Change feed between two snapshots, one row per change:
    ``insert``, ``delete``, and ``update_preimage`` + ``update_postimage``
    for keys whose non-key values differ (NULL-safe)."""
    cols = new.columns
    vals = [c for c in cols if c not in keys]
    o = old.select(*cols).withColumn("__spread", _spread(keys, cols)).withColumn("__o", F.lit(True)).alias("o")
    n = new.select(*cols).withColumn("__spread", _spread(keys, cols)).withColumn("__n", F.lit(True)).alias("n")
    j = o.join(n, _same_key(keys, "o", "n"), "full")
    in_o, in_n = F.col("o.__o").isNotNull(), F.col("n.__n").isNotNull()
    changed = _null_safe_differs(vals, "o", "n")
    old_row = F.struct(*[F.col(f"o.`{c}`").alias(c) for c in cols])
    new_row = F.struct(*[F.col(f"n.`{c}`").alias(c) for c in cols])
    events = F.when(in_o & ~in_n, F.array(F.struct(old_row.alias("r"), F.lit("delete").alias("t")))) \
        .when(~in_o & in_n, F.array(F.struct(new_row.alias("r"), F.lit("insert").alias("t")))) \
        .when(changed, F.array(F.struct(old_row.alias("r"), F.lit("update_preimage").alias("t")),
                               F.struct(new_row.alias("r"), F.lit("update_postimage").alias("t"))))
    return (j.select(F.explode(events).alias("e"))
            .select(*[F.col(f"e.r.`{c}`").alias(c) for c in cols], F.col("e.t").alias("_change_type")))


def union_schema_versions(frames: list[DataFrame], renames: dict[str, str] | None = None) -> DataFrame:
    """Reads across added, dropped and renamed columns: renamed columns are
    mapped to their current name, missing ones become NULL."""
    renames = renames or {}
    out = None
    for df in frames:
        for old, new in renames.items():
            if old in df.columns:
                df = df.withColumnRenamed(old, new)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
