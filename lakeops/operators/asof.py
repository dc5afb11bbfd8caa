"""Point-in-time (as-of) lookups, exact-key lookups and training sets.

As-of semantics: for each label row, the latest feature row with the same key
whose timestamp is at or before the label's timestamp (equal times match).
Labels without such a row keep NULL features.  NULL keys and NULL times match
nothing.  The feature row is carried as a struct, so a NULL feature value in
the latest row stays NULL (it is the latest *row*, not the latest value).

Of several feature rows with one key and time, the one with the greatest feature
values counts (compared in the order of the feature columns, NULL lowest).

Scale design
------------
Spark has no as-of join type.  The plain form (union both sides, then
``last(ignorenulls)`` over ``partitionBy(key).orderBy(ts)``) puts every row of
a key into one task.  Two exact forms avoid that:

**ranges** (the default).  Labels and features are dealt together by ranges of
(key, time), so every task gets about as many rows as the others, however many of
them one key holds, and each side is computed once.  Within its sorted range a task
carries the last feature row of a key forward (Arrow batches, no loop over rows).
Labels at the head of a range whose key began in an earlier one stay open; the last
feature row of each range's last key, one row a range, closes them in a join with
that small table.

**buckets** (with ``bucket_seconds``).  Rows are dealt by ``(key, time bucket)``:

1. per (key, bucket) the last feature row of the bucket and whether labels
   fall into it (one hash aggregate with map-side combine; output size
   keys x buckets, independent of row counts);
2. per (key, label bucket) the "carry-in": the last feature row of any
   earlier bucket (a window over the small summary, ordered by bucket);
3. the carry-in enters its bucket as a synthetic feature row that sorts first,
   and one window over ``(key, bucket)`` ordered by time picks the match.

This form stays in the JVM.  A hot key is split across its time buckets only; with
``max_labels_per_task`` set, a bucket that still holds more labels than that is
salted: its labels are spread over several tasks by hash and its feature and
carry-in rows are copied to each of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, MapType, StructField, StructType

from lakeops.functions.timefeat import epoch_micros
from lakeops.session import cut_lineage, written

# Suggested limit for ``max_labels_per_task`` (salting is opt-in because the
# check needs one extra pass over the inputs): buckets with more labels are
# spread over ceil(labels / limit) tasks, their feature rows copied to each.
MAX_LABELS_PER_TASK = 1_000_000
# Upper bound on hot buckets joined by broadcast (beyond it: a shuffled join).
MAX_BROADCAST_HOT_BUCKETS = 200_000


def _feature_names(right: DataFrame, keys: list[str], ts: str | None,
                   features: list[str] | None) -> list[str]:
    skip = set(keys) | ({ts} if ts else set())
    names = list(features) if features else [c for c in right.columns if c not in skip]
    missing = [c for c in names if c not in right.columns]
    if missing:
        raise ValueError(f"unknown feature columns {missing}")
    return names


def asof_join(left: DataFrame, right: DataFrame, keys: list[str],
              left_ts: str = "ts", right_ts: str = "ts",
              features: list[str] | None = None,
              right_keys: list[str] | None = None,
              bucket_seconds: int | None = None,
              max_labels_per_task: int | None = None) -> DataFrame:
    """Left rows plus the as-of matched feature columns of ``right``; by ranges, or
    with ``bucket_seconds`` (any width gives the same result) by buckets."""
    return asof_by_position(left, right, keys, epoch_micros(left, left_ts),
                            epoch_micros(right, right_ts), features=features,
                            right_keys=right_keys, exclude=[right_ts],
                            bucket_width=None if bucket_seconds is None else int(bucket_seconds) * 1_000_000,
                            max_labels_per_task=max_labels_per_task)


def asof_by_position(left: DataFrame, right: DataFrame, keys: list[str], left_pos: Column,
                     right_pos: Column, features: list[str] | None = None,
                     right_keys: list[str] | None = None, exclude: list[str] | None = None,
                     bucket_width: int | None = None,
                     max_labels_per_task: int | None = None) -> DataFrame:
    """As-of join on integral positions (times in any unit, sequence numbers):
    for each left row the right row of the same key with the greatest
    position <= the left row's position."""
    right_keys = right_keys or keys
    skip = set(right_keys) | set(exclude or [])
    names = list(features) if features else [c for c in right.columns if c not in skip]
    missing = [c for c in names if c not in right.columns]
    if missing:
        raise ValueError(f"unknown feature columns {missing}")
    clash = sorted(set(names) & set(left.columns))
    if clash:
        raise ValueError(f"feature columns already in the label frame: {clash}")
    kcols = [f"__k{i}" for i in range(len(keys))]

    lab = left.select(
        *[F.col(k).alias(c) for k, c in zip(keys, kcols)],
        left_pos.cast("long").alias("__us"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__l"),
    )
    feat = right.select(
        *[F.col(k).alias(c) for k, c in zip(right_keys, kcols)],
        right_pos.cast("long").alias("__us"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("__f"),
    )
    feat = feat.filter(F.col("__us").isNotNull())
    for c in kcols:
        feat = feat.filter(F.col(c).isNotNull())
    matched = (_by_ranges(lab, feat, kcols) if bucket_width is None else
               _by_buckets(lab, feat, kcols, int(bucket_width), max_labels_per_task))
    return matched.select(*[F.col(f"__l.`{c}`").alias(c) for c in left.columns],
                          *[F.col(f"__m.`{c}`").alias(c) for c in names])


def _ordered(t: DataType) -> bool:
    """Whether values of the type can be compared."""
    return (not isinstance(t, MapType) and all(_ordered(f.dataType) for f in getattr(t, "fields", []))
            and (not isinstance(t, ArrayType) or _ordered(t.elementType)))


def _tie(f_type: DataType) -> Column:
    """What decides between feature rows of one key and time."""
    return F.col("__f") if _ordered(f_type) else F.to_json("__f")


def _by_ranges(lab: DataFrame, feat: DataFrame, kcols: list[str]) -> DataFrame:
    """(__l, __m): every label with its feature row, by ranges of (key, time)."""
    f_type, l_type = feat.schema["__f"].dataType, lab.schema["__l"].dataType
    rows = (feat.select(*kcols, "__us", F.lit(None).cast(l_type).alias("__l"), "__f", F.lit(0).alias("__side"),
                        F.lit(0).cast("long").alias("__h"))
            .unionByName(lab.select(*kcols, "__us", "__l", F.lit(None).cast(f_type).alias("__f"), F.lit(1).alias("__side"),
                                    F.xxhash64("__l").alias("__h"))))
    # the hash lets labels of one key and time part; the tie column orders features
    order = [*kcols, "__us", "__side", _tie(f_type), "__h"]
    dealt = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .select(*kcols, "__l", "__f", F.col("__us").isNotNull().alias("__timed"), (F.col("__side") == 0).alias("__feat"),
                     F.spark_partition_id().cast("long").alias("__part")))
    schema = StructType([*[StructField(c, feat.schema[c].dataType) for c in kcols], StructField("__part", LongType()),
                         StructField("__l", l_type), StructField("__m", f_type), StructField("__open", BooleanType()),
                         StructField("__last", BooleanType())])
    arrow = to_arrow_schema(schema)
    nk = len(kcols)

    def fill(batches):
        key = last = part = None          # of the row before: its key, the key's last feature row
        head = True                       # still in the first key of the range
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, (labels, feats, timed, is_feat, parts) = batch.columns[:nk], batch.columns[nk:]
            part = parts[0]
            new = np.zeros(n, bool)
            for k in keys:
                same = pc.fill_null(pc.equal(k.slice(1), k.slice(0, n - 1)), False)
                new[1:] |= ~same.to_numpy(zero_copy_only=False)
            own = [k[0] for k in keys]
            new[0] = key is None or not all(a.is_valid and a.equals(b) for a, b in zip(own, key))
            if new[0]:
                head, last = key is None, None
            at = np.arange(n)
            feat_rows = is_feat.to_numpy(zero_copy_only=False)
            found = np.maximum.accumulate(np.where(feat_rows, at, -1))
            run = np.maximum.accumulate(np.where(new, at, -1 if not new[0] else 0))
            found = np.where(found >= np.maximum(run, 0), found, -1)      # a feature row of the same key
            first = run <= (0 if new[0] else -1)                          # rows of the batch's first key
            pool = feats if last is None else pa.concat_arrays([feats, last])
            if last is not None:
                found = np.where((found < 0) & first, n, found)
            known, asked = timed.to_numpy(zero_copy_only=False), ~feat_rows
            match = pool.take(pa.array(found, mask=(found < 0) | ~known))
            unseen = pa.array(asked & known & (found < 0) & first & head)
            pick = pa.array(asked)
            out = [c.filter(pick) for c in (*keys, parts, labels, match, unseen)]
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(out, arrow)],
                                              pa.array(np.zeros(int(asked.sum()), bool))], schema=arrow)
            key = [k[n - 1] for k in keys]
            if new[1:].any():
                head = False
            last = pool.take(pa.array([found[-1]])) if found[-1] >= 0 else None
        if last is not None:
            yield pa.RecordBatch.from_arrays([
                *[pa.array([k.as_py()], f.type) for k, f in zip(key, arrow)], pa.array([part.as_py()], arrow[nk].type),
                pa.nulls(1, arrow[nk + 1].type), last.cast(arrow[nk + 2].type), pa.array([False]), pa.array([True])], schema=arrow)

    filled = written(dealt.mapInArrow(fill, schema), "asof-ranges")
    # one row a range: the last feature row of its last key; the latest before a range's head
    # that has the head's key closes the labels left open there
    ends = (filled.filter("__last").select(*kcols, "__part", F.lit(1).alias("__side"), F.col("__m").alias("__carry"))
            .unionByName(filled.filter("__open").select(*kcols, "__part", F.lit(0).alias("__side")).distinct()
                         .withColumn("__carry", F.lit(None).cast(f_type))))
    before = Window.partitionBy(*kcols).orderBy("__part", "__side").rowsBetween(Window.unboundedPreceding, -1)
    carry = (ends.withColumn("__carry", F.last("__carry", ignorenulls=True).over(before)).filter("__side = 0")
             .select(*[F.col(c).alias(f"_{c}") for c in kcols], F.col("__part").alias("___part"), "__carry"))
    labels = filled.filter("NOT __last")
    cond = [F.col(c) == F.col(f"_{c}") for c in kcols] + [F.col("__part") == F.col("___part"), F.col("__open")]
    return (labels.join(carry, cond, "left")
            .select("__l", F.when(F.col("__open"), F.col("__carry")).otherwise(F.col("__m")).alias("__m")))


def _by_buckets(lab: DataFrame, feat: DataFrame, kcols: list[str], bucket_width: int,
                max_labels_per_task: int | None) -> DataFrame:
    """(__l, __m): every label with its feature row, by (key, time bucket)."""
    width = F.lit(bucket_width)
    lab, feat = (d.withColumn("__b", F.floor(F.col("__us") / width)) for d in (lab, feat))
    f_type = feat.schema["__f"].dataType
    l_type = lab.schema["__l"].dataType
    null_l = F.lit(None).cast(l_type)
    null_f = F.lit(None).cast(f_type)

    # 1. per (key, bucket): the bucket's last feature row, and whether labels
    #    fall into it (one aggregation over both sides; partial per task)
    summary = (feat.select(*kcols, "__b", "__us", "__f", F.lit(False).alias("__has_lab"))
               .unionByName(lab.select(*kcols, "__b", F.lit(None).cast("long").alias("__us"),
                                       F.lit(None).cast(f_type).alias("__f"),
                                       F.lit(True).alias("__has_lab")))
               .groupBy(*kcols, "__b")
               .agg(F.max_by("__f", F.struct("__us", _tie(f_type))).alias("__f"), F.max("__has_lab").alias("__has_lab"),
                    F.count_if("__has_lab").alias("__n_lab")))
    salts = None
    if max_labels_per_task:
        # the summary is small (keys x buckets): materialise it once, read the
        # number of hot buckets, and salt only those
        summary = cut_lineage(summary)
        hot = (summary.filter(F.col("__n_lab") > max_labels_per_task)
               .select(*kcols, "__b", F.ceil(F.col("__n_lab") / F.lit(max_labels_per_task))
                       .cast("int").alias("__salts")))
        n_hot = hot.count()
        if n_hot:
            salts = F.broadcast(hot) if n_hot <= MAX_BROADCAST_HOT_BUCKETS else hot
    # 2. carry-in for buckets holding labels: the last feature of any earlier
    #    bucket (a window over the keys x buckets summary)
    w_carry = (Window.partitionBy(*kcols).orderBy("__b")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.withColumn("__carry", F.last("__f", ignorenulls=True).over(w_carry))
             .filter(F.col("__has_lab") & F.col("__carry").isNotNull())
             .select(*kcols, "__b", F.col("__carry").alias("__f")))

    # 3. one window per (key, bucket): carry row first, features before labels
    feat_rows = feat.select(*kcols, "__b", "__us", F.lit(0).alias("__side"), null_l.alias("__l"), "__f")
    lab_rows = lab.select(*kcols, "__b", "__us", F.lit(1).alias("__side"), "__l", null_f.alias("__f"))
    carry_rows = carry.select(*kcols, "__b", F.lit(None).cast("long").alias("__us"),
                              F.lit(-1).alias("__side"), null_l.alias("__l"), "__f")
    if salts is None:
        feat_rows, lab_rows, carry_rows = (d.withColumn("__salt", F.lit(0))
                                           for d in (feat_rows, lab_rows, carry_rows))
    else:
        def salted(d, copy):
            j = d.join(salts, on=kcols + ["__b"], how="left")
            n = F.coalesce(F.col("__salts"), F.lit(1))
            if copy:     # feature and carry rows go to every salt of their bucket
                return j.withColumn("__salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("__salts")
            return j.withColumn("__salt", F.pmod(F.xxhash64("__l"), n).cast("int")).drop("__salts")
        feat_rows, lab_rows, carry_rows = salted(feat_rows, True), salted(lab_rows, False), \
            salted(carry_rows, True)
    rows = feat_rows.unionByName(lab_rows).unionByName(carry_rows)
    w = (Window.partitionBy(*kcols, "__b", "__salt")
         .orderBy(F.col("__us").asc_nulls_first(), F.col("__side"), _tie(f_type))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("__m", F.last("__f", ignorenulls=True).over(w)).filter(F.col("__side") == 1)


def asof_join_plain(left: DataFrame, right: DataFrame, keys: list[str], ts: str = "ts",
                    features: list[str] | None = None) -> DataFrame:
    """Unbucketed reference form, used by tests as a brute-force check."""
    names = _feature_names(right, keys, ts, features)
    l_ = left.select(*left.columns, F.lit(1).alias("__side"),
                     F.lit(None).cast(right.select(F.struct(*names)).schema[0].dataType).alias("__f"))
    r_ = right.filter(F.col(ts).isNotNull()).select(
        *[F.col(k) for k in keys], F.col(ts), F.lit(0).alias("__side"),
        F.struct(*names).alias("__f"))
    for c in left.columns:
        if c not in r_.columns:
            r_ = r_.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    u = l_.unionByName(r_.select(*l_.columns))
    w = (Window.partitionBy(*keys).orderBy(F.col(ts), "__side")
         .rowsBetween(Window.unboundedPreceding, 0))
    out = u.withColumn("__m", F.last("__f", ignorenulls=True).over(w)).filter("__side = 1")
    return out.select(*left.columns, *[F.col(f"__m.`{c}`").alias(c) for c in names])


def exact_lookup(left: DataFrame, right: DataFrame, keys: list[str],
                 features: list[str] | None = None) -> DataFrame:
    """Left join on the full primary key.  ``right`` must be unique on ``keys``
    (feature tables check this when written, and ``FeatureStore.lookup`` refuses
    a table with a time key that gets none)."""
    names = _feature_names(right, keys, None, features)
    clash = sorted(set(names) & set(left.columns))
    if clash:
        raise ValueError(f"feature columns already in the label frame: {clash}")
    return left.join(right.select(*keys, *names), on=keys, how="left")


@dataclass
class FeatureLookup:
    """One lookup of a training set (table, key columns, optional time key)."""

    table: DataFrame
    lookup_key: list[str] | str
    timestamp_lookup_key: str | None = None
    feature_names: list[str] | None = None
    table_keys: list[str] | None = None
    table_timestamp_key: str = "ts"
    bucket_seconds: int | None = None
    rename: dict = field(default_factory=dict)
    max_labels_per_task: int | None = None


def create_training_set(labels: DataFrame, lookups: list[FeatureLookup],
                        exclude_columns: list[str] | None = None,
                        label: str | None = None) -> DataFrame:
    """Chains the lookups on one label frame, then drops excluded columns.

    The label column is kept last, the way training code expects it.
    """
    df = labels
    for lk in lookups:
        keys = [lk.lookup_key] if isinstance(lk.lookup_key, str) else list(lk.lookup_key)
        table = lk.table
        for old, new in lk.rename.items():
            table = table.withColumnRenamed(old, new)
        if lk.timestamp_lookup_key:
            df = asof_join(df, table, keys, left_ts=lk.timestamp_lookup_key,
                           right_ts=lk.table_timestamp_key, features=lk.feature_names,
                           right_keys=lk.table_keys, bucket_seconds=lk.bucket_seconds,
                           max_labels_per_task=lk.max_labels_per_task)
        else:
            t = table
            if lk.table_keys:
                t = t.select(*[F.col(a).alias(b) for a, b in zip(lk.table_keys, keys)],
                             *[c for c in t.columns if c not in lk.table_keys])
            df = exact_lookup(df, t, keys, lk.feature_names)
    drop = set(exclude_columns or [])
    cols = [c for c in df.columns if c not in drop and c != label]
    if label:
        cols.append(label)
    return df.select(*cols)


def time_split(df: DataFrame, cutoff: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Train ``ts < cutoff`` and test ``ts >= cutoff``; rows with NULL ts are in neither."""
    c = F.lit(cutoff).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) < c), df.filter(F.col(ts) >= c)
